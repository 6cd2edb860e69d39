"""Secret scans: every rule in one pass of one automaton over the bytes of each text.

Nulls and empty texts have no spans. Rows are never merged or dropped, so repeated
rows give repeated results; other columns pass through, and a column of the input
named like the new one is replaced. Texts are cut into lanes that run side
by side, so a very long text takes no longer than many short ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosegrid.llm import common
from dosegrid.llm.automaton import Automaton, Rule

#: The kinds of the contract, in its order. Runs of hex digits are maximal, so the count in the pattern drops just the short ones.
#: Other lengths are looked at after a match: counting inside the automaton would multiply its states.
BASE_RULES = (
    Rule("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", True, 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]+", least=40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("pem", r"-----BEGIN (RSA |EC |OPENSSH )?PRIVATE KEY-----"),
)
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
#: Bytes scanned together: enough lanes for one numpy step, a few dozen MB of memory.
SCAN_BYTES = 4 << 20


@lru_cache(4)
def automaton(rules: tuple[Rule, ...]) -> Automaton:
    return Automaton(rules)


def find_secrets(df: DataFrame, text: str = "text", rules: Sequence[Rule] = BASE_RULES + MORE_RULES, into: str = "spans") -> DataFrame:
    """df with a column of (kind, start, end) in code points, end exclusive, by start and then rule order."""
    rules = tuple(rules)
    df = df.drop(into)
    schema = T.StructType([*df.schema.fields, T.StructField(into, SPANS)])
    place = df.columns.index(text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(rules)
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for row, _, data, offsets in common.steps(batch.column(place), SCAN_BYTES):
                for r, start, end, k in machine.spans(data, offsets):
                    found[row + r].append({"kind": rules[k].kind, "start": start, "end": end})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=[*batch.schema.names, into])

    return common.in_arrow(df, scan, schema)


def redact(df: DataFrame, text: str = "text", rules: Sequence[Rule] = BASE_RULES + MORE_RULES) -> DataFrame:
    """df with every span replaced by its kind in brackets; overlapping spans become one, named for the first. Null texts stay null."""
    mark = common.fresh(df, "spans")
    place = df.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for i, found in enumerate(spans):
                if found:
                    out, at = [], 0
                    for s in found:
                        if s["start"] >= at:
                            out += [texts[i][at : s["start"]], f"[{s['kind']}]"]
                        at = max(at, s["end"])
                    texts[i] = "".join([*out, texts[i][at:]])
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return common.in_arrow(find_secrets(df, text, rules, mark), cut, df.schema)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(common.documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    names = [r.kind for r in BASE_RULES]
    joined = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    base = F.filter("spans", lambda s: s["kind"].isin(names))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in names), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
