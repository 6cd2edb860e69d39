"""Queries of the corpus operators, one for each, over whole tables; and those of their parts that SQL can say, with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common, counterparts, quality, secrets
from dosegrid.llm.attribution import op10_token_counts
from dosegrid.llm.chosen_path import op6_chosen_path_join
from dosegrid.llm.codes import op13_vector_codes
from dosegrid.llm.lm import op3_attention_scores, word_counts
from dosegrid.llm.manifest import op12_merkle_manifest
from dosegrid.llm.media import op9_media_columns
from dosegrid.llm.mixing import op1_soft_mixing
from dosegrid.llm.packing import op5_min_slack_packing
from dosegrid.llm.quality import op7_quality_rules
from dosegrid.llm.repeats import op8_suffix_dedup
from dosegrid.llm.reputation import op11_url_reputation
from dosegrid.llm.secrets import op2_secret_scan
from dosegrid.llm.toxicity import op4_toxic_segments


def secret_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base kinds that the secret scan finds in each text."""
    found = secrets.find_secrets(common.documents(spark, sf_dir).select("doc_id", "text"), rules=secrets.BASE_RULES)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES))


def quality_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base statistics of the quality rules."""
    return quality.with_statistics(common.documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", *quality.STATISTICS)


def corpus_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all words, A-Z in lower case, and of text ends (the empty word), as language-model scoring gathers them."""
    counts = word_counts(common.documents(spark, sf_dir).select("text"))
    return counts.select(F.decode("word", "UTF-8").alias("word"), "c")


QUERIES = {
    "op2_secret_scan": op2_secret_scan,
    "op5_min_slack_packing": op5_min_slack_packing,
    "op9_media_columns": op9_media_columns,
    "op10_token_counts": op10_token_counts,
    "op7_quality_rules": op7_quality_rules,
    "op4_toxic_segments": op4_toxic_segments,
    "op3_attention_scores": op3_attention_scores,
    "op6_chosen_path_join": op6_chosen_path_join,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op1_soft_mixing": op1_soft_mixing,
    "op11_url_reputation": op11_url_reputation,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_vector_codes": op13_vector_codes,
    "secret_counts": secret_counts,
    "quality_statistics": quality_statistics,
    "corpus_word_counts": corpus_word_counts,
}

_SPACE = r"[\x20\x09-\x0D]+"
_COUNT = "len(list_filter(regexp_extract_all(t, '{pattern}', {group}), lambda x: length(x) >= {least}))"
_LOWER = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "list_filter(string_split_regex({t}, '" + _SPACE + "'), lambda x: x <> '')"
ORACLE_SQL: dict[str, str] = {
    "secret_counts": "select doc_id, "
    + ", ".join(f"""{_COUNT.format(pattern=("(?i)" if r.either_case else "") + r.pattern.replace("'", "''"), group=r.group, least=r.least)} as n_{r.kind}""" for r in secrets.BASE_RULES)
    + " from (select doc_id, coalesce(text, '') as t from documents)",
    "quality_statistics": f"""with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, {_WORDS.format(t="t")} as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from d),
win as (select r, p, array_to_string(w[p : p + 4], ' ') as g from (select r, w, unnest(range(1, len(w) - 3)) as p from w)),
twice as (select r, unnest(range(p, p + 5)) as k from (select r, p, count(*) over (partition by r, g) as n from win) where n > 1),
cover as (select r, count(distinct k) as n from twice group by 1)
select doc_id, len(w) as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words from d join w using (r) left join cover using (r)""",
    "corpus_word_counts": f"with d as (select coalesce(text, '') as t from documents), l as (select {_LOWER} as t from d) select word, count(*) as c from (select unnest({_WORDS.format(t='t')}) as word from l union all select '' from l) group by 1",
    "op11_url_reputation": counterparts.reputation_sql(),
    "op12_merkle_manifest": counterparts.manifest_sql(),
    "op13_vector_codes": counterparts.codes_sql(),
}
