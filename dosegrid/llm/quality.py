"""Quality rules: an ordered list of threshold conjunctions learned from labelled statistics, as one Spark expression.

All work is DataFrame and SQL functions. Sequential covering: a rule grows on two
thirds of the labelled rows by the condition with the best information gain, is
pruned on the other third, and is kept if it is precise there; rows that it
covers are set aside and the next rule is grown. Only counts by feature and bin,
whose number is fixed, reach the driver.

Null texts have no words and fail the base rule; texts of any length are handled
as whole arrays of words. Null or repeated labels: null ones are left out, repeated
ones count each. Without labelled rows, or without a precise rule, the list is
empty and keeps all. Rows pass through one by one; columns of the input named like
a statistic are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("f_words", "f_word_length", "f_symbols", "f_upper", "f_marks", "f_digits", "f_repeats", "f_dup_lines", "f_short", "f_bars")
#: Quantiles of each class; the thresholds of a feature lie halfway between neighbours among them.
QUANTILES = (0.001, 0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)
#: A rule has MAX_CONDITIONS at most and, on rows that it has not grown on, rejects rows of which this share at least is bad.
MAX_CONDITIONS, MAX_RULES, PRECISION, LEAST_COVERED = 3, 12, 0.9, 5


def _let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words in WINDOW-word windows that occur twice or more, by 64-bit hashes of the windows."""

    def windows(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.struct(F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))).alias("h"), i.alias("p")))
        return F.when(F.size(w) >= WINDOW, F.sort_array(every)).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))

    def twice(s: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"]))

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda at, i: F.least(F.coalesce(F.get(p, i + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)).cast("long"))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, b: a + b)

    return _let(_let(windows(words), twice), covered)


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """df with STATISTICS and FEATURES of the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    without = lambda chars: F.length(F.translate(body, chars, ""))
    letters = "".join(map(chr, range(65, 91)))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    base = df.drop(*STATISTICS, *FEATURES)
    columns = [f"`{c}`" for c in base.columns]
    name = {c: common.fresh(base, f"_{c}") for c in ("w", "lines", "upper", "marks", "digits", "bars")}
    part = lambda c: F.col(name[c])
    length = F.length(body)
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, "\t\x0b\x0c\r ", "")) > 0)

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeats"), F.size(F.filter(w, lambda x: F.length(x) <= 3)).alias("short"))

    counted = base.select(
        *columns,
        _let(words_of(F.col(text)), of_words).alias(name["w"]),
        _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        F.size(lines).alias(name["lines"]),
        without(" \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (length - without("#*$%&|<>")).cast("long").alias("n_symbols"),
        (length - without(letters)).alias(name["upper"]),
        (length - without("!?")).alias(name["marks"]),
        (length - without("0123456789")).alias(name["digits"]),
        (length - without("|")).alias(name["bars"]),
    )
    n, chars = part("w")["n"], F.col("word_chars")
    return counted.select(
        *columns,
        n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", part("w")["repeats"].alias("n_repeat_words"),
        n.cast("double").alias("f_words"), ratio(chars, n).alias("f_word_length"), ratio(F.col("n_symbols"), chars).alias("f_symbols"), ratio(part("upper"), chars).alias("f_upper"),
        ratio(part("marks"), n).alias("f_marks"), ratio(part("digits"), chars).alias("f_digits"), ratio(part("w")["repeats"], n).alias("f_repeats"),
        ratio(F.col("n_dup_lines"), part("lines")).alias("f_dup_lines"), ratio(part("w")["short"], n).alias("f_short"), ratio(part("bars"), n).alias("f_bars"),
    )


@dataclass(frozen=True)
class Condition:
    """feature > threshold, or <= if not above; bin: how many thresholds of the feature lie below those values."""

    feature: str
    above: bool
    threshold: float
    bin: int

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules in order; a row that meets one is rejected by the first it meets."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rule(self) -> Column:
        """Number of the rule that rejects a row, from 1; 0: none."""
        out = None
        for k, conditions in enumerate(self.rules, 1):
            met = F.lit(True)
            for c in conditions:
                met = met & c.column()
            out = F.when(met, k) if out is None else out.when(met, k)
        return (F.lit(0) if out is None else out.otherwise(0)).cast("long")

    def verdict(self) -> Column:
        return self.rule() == 0

    def __str__(self) -> str:
        return "\n".join("reject if " + " and ".join(map(str, r)) for r in self.rules) or "keep all"


def _gain(bad: float, good: float, bad_before: float, good_before: float) -> float:
    """Information gained about the bad rows that stay covered."""
    if not bad:
        return -1.0
    bits = lambda b, g: math.log2(b / (b + g))
    return bad * (bits(bad, good) - bits(bad_before, good_before))


def learn(labelled: DataFrame, label: str, key: str, features: tuple[str, ...] = FEATURES) -> DecisionList:
    """Rules that find rows with label 0 among rows with label 0 or 1; key decides on which rows a rule is pruned."""
    known = labelled.where(F.col(label).isin(0, 1))
    cuts = known.groupBy(label).agg(*(F.percentile_approx(f, F.array(*map(F.lit, QUANTILES)), 2000).alias(f) for f in features)).collect()
    if len(cuts) < 2:
        return DecisionList()
    values = {f: sorted({v for row in cuts for v in row[f]}) for f in features}
    thresholds = {f: [(a + b) / 2 for a, b in zip(v, v[1:], strict=False)] or [v[0]] for f, v in values.items()}
    bin_of = lambda f: F.size(F.filter(F.array(*map(F.lit, thresholds[f])), lambda t: t < F.col(f)))
    bins = F.array(*map(bin_of, features))
    rows = common.kept(known.select(bins.alias("bins"), (F.col(label) == 0).alias("bad"), (common.crc_mod(F.col(key), 3) == 0).alias("prune")), "labelled_bins")
    place = {f: k for k, f in enumerate(features)}

    def meets(conditions: list[Condition]) -> Column:
        out = F.lit(True)
        for c in conditions:
            value = F.get("bins", F.lit(place[c.feature]))
            out = out & (value >= c.bin if c.above else value < c.bin)
        return out

    def totals(df: DataFrame) -> tuple[int, int]:
        bad, every = df.agg(F.count_if("bad"), F.count("bad")).first()
        return bad, every - bad

    found = DecisionList()
    while len(found.rules) < MAX_RULES:
        left = rows
        for rule in found.rules:
            left = left.where(~meets(rule))
        grow, prune = left.where(~F.col("prune")), left.where("prune")
        rule: list[Condition] = []
        bad, good = totals(grow)
        while len(rule) < MAX_CONDITIONS and bad and good:
            counts = grow.where(meets(rule)).select("bad", F.posexplode("bins").alias("feature", "bin")).groupBy("feature", "bin").agg(F.count_if("bad").alias("bad"), F.count("bad").alias("every")).collect()
            best = (0.0, None, 0, 0)
            for f in features:
                mine = sorted((r["bin"], r["bad"], r["every"] - r["bad"]) for r in counts if r["feature"] == place[f])
                for k in range(1, len(thresholds[f]) + 1):
                    below = [sum(r[i] for r in mine if r[0] < k) for i in (1, 2)]
                    for above, (b, g) in ((False, below), (True, [bad - below[0], good - below[1]])):
                        if (gain := _gain(b, g, bad, good)) > best[0] + 1e-9:
                            best = (gain, Condition(f, above, thresholds[f][k - 1], k), b, g)
            if best[1] is None:
                break
            rule.append(best[1])
            bad, good = best[2:]
        if not rule:
            break
        parts = [rule[:n] for n in range(1, len(rule) + 1)]
        row = prune.agg(*(F.count_if(meets(p) & F.col("bad")).alias(f"b{k}") for k, p in enumerate(parts)), *(F.count_if(meets(p) & ~F.col("bad")).alias(f"g{k}") for k, p in enumerate(parts))).first()
        worth, short, b, g = max(((row[f"b{k}"] + 1) / (row[f"b{k}"] + row[f"g{k}"] + 2) if row[f"b{k}"] >= LEAST_COVERED else 0.0, -len(p), row[f"b{k}"], row[f"g{k}"]) for k, p in enumerate(parts))
        if b < LEAST_COVERED or b / (b + g) < PRECISION:
            break
        found.rules.append(rule[:-short])
    return found


def judged(featured: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """A table with statistics, with base_failed, rule (of the learned list, 0 for none) and kept in place of FEATURES."""
    answers = labels.select(F.col(key).alias("_key"), F.col("quality").alias("_quality"))
    rules = learn(featured.select(key, *FEATURES).join(answers, F.col(key) == F.col("_key")), "_quality", key)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return featured.withColumns({"base_failed": failed, "rule": rules.rule(), "kept": ~failed & rules.verdict()}).drop(*FEATURES)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    featured = common.kept(with_statistics(docs).drop("text"), "quality")
    return judged(featured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
