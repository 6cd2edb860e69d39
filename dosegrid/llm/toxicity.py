"""Toxicity: every maximal-scoring segment of token log-odds, weighed as an extreme value.

Learning. From labelled documents (exact copies with one label count once) come the
numbers of toxic and clean documents by word and by word front of 3 to 6 letters. A
unit's toxic share has a Dirichlet prior of weight PRIOR centred on the share of the
next shorter front, the shortest one's on the overall share; a word's score is its
share's log-odds over the overall log-odds. Units enter the model if their evidence (G
squared) is over EVIDENCE and their log-odds over LEAST_ODDS; words with clean uses
under such a front enter as exceptions. All such units are the model, a table. Up to
UNITS of them it is broadcast; a larger one is joined: the scores of all words that it
knows are joined to the distinct words of each text. Both ways give equal results.

Scoring. Each token scores its log-odds, or -DRIFT if it is in no unit. A linear scan
finds all maximal-scoring segments. A segment of score S in a text of n tokens has
E = n exp(-l S) chance equals, l solving sum p(s) exp(l s) = 1 over the clean tokens.
Segments with E under SIGNIFICANT are toxic passages. -ln of the smallest E and the
number of passages, both rounded (see `rounded`), are mapped to a probability by a logistic
fit on the training documents, which come as a table of these two numbers.

Null and empty texts have no tokens and no passages; their score is that of such
texts. Texts of any length are scanned whole. Null labels and ids are left out of
training; of repeated labels of an id the largest counts. Training rows with one text and
one label, under one id or several, count once, so that a large group of copies is one
witness; texts that share an id count each. Rows are never merged in scoring.
Without both classes every score is the share of toxic labels, or 0. Columns named
like a result are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from dosegrid.llm import common

FRONTS = (3, 4, 5, 6)
PRIOR, EVIDENCE, LEAST_ODDS = 2.0, 10.0, 1.0
#: Units that are broadcast; a larger model is joined.
UNITS = 100_000
DRIFT, SIGNIFICANT, WHOLE = 0.1, 0.05, 100
#: Entries of a worker's tables of words before they are written out or forgotten.
HELD = 300_000
_WORD = re.compile(r"[^\W_]+")
SEGMENT = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("e_value", T.DoubleType())])


def units_of(word: str) -> list[str]:
    """Fronts of a word, shortest first, each marked by a star, then the word itself."""
    return [word[:n] + "*" for n in FRONTS if n < len(word)] + [word]


def maximal_segments(places: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first place, last place, score), in linear time. Tokens between the given places score -drift."""
    found: list[list] = []  # first, last, total before, total after
    # Of each candidate also the nearest candidate before it with a smaller total before, so that none is looked at twice.
    before: list[int] = []
    total, last = 0.0, -1
    for place, score in zip(places, scores, strict=True):
        total -= drift * (place - last - 1)
        last = place
        low = total
        total += score
        if score <= 0:
            continue
        new = [place, place, low, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = before[j]
            if j < 0 or found[j][3] >= new[3]:
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:], before[j:]
        found.append(new)
        before.append(j)
    return [(a, b, high - low) for a, b, low, high in found]


def rounded(x: float) -> float:
    """A whole number, and over WHOLE one of steps of some 2 %: so many values that a table of them is small, but no cut."""
    return float(round(x)) if x <= WHOLE else math.exp(round(math.log(x) * 50) / 50)


def log_odds(counts: list[tuple[int, int] | None], share: float) -> float | None:
    """Of a word, by the toxic and clean documents of its units in the model, shortest first (None: not in it). The clean share has a sum of its own: as one minus the toxic share it is lost in rounding where all units have thousands of toxic documents and no clean one."""
    theta, rest, known = share, 1 - share, False
    for toxic, clean in filter(None, counts):
        theta, rest, known = (toxic + PRIOR * theta) / (toxic + clean + PRIOR), (clean + PRIOR * rest) / (toxic + clean + PRIOR), True
    return math.log(theta / rest * (1 - share) / share) if known else None


@dataclass
class Model:
    """units: table of (unit, toxic, clean); counts: the same if they are few enough, else None; shape: weights of (1, -ln E, passages) in the logistic fit."""

    units: DataFrame | None
    counts: dict[str, tuple[int, int]] | None
    share: float
    rate: float = 1.0
    shape: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def scorer(self) -> Scorer:
        return Scorer(self.counts or {}, self.share, self.rate, self.shape)


@dataclass
class Scorer:
    """What a task needs of a model. memo: scores of words; those of a joined model are put there."""

    counts: dict[str, tuple[int, int]]
    share: float
    rate: float
    shape: tuple[float, float, float]
    memo: dict[str, float | None] = field(default_factory=dict)

    def score(self, word: str) -> float | None:
        if word not in self.memo:
            if len(self.memo) >= HELD:
                self.memo.clear()
            self.memo[word] = log_odds([self.counts.get(u) for u in units_of(word)], self.share)
        return self.memo[word]

    def segments(self, text: str) -> tuple[list[tuple[int, int, float, float]], float]:
        """Toxic passages of a text (start, end, score, E) in code points, and -ln of the smallest E of any segment (0 without one)."""
        words = _WORD.findall(text.lower())
        get = self.memo.get
        scores = [get(w, 0) if w in self.memo else self.score(w) for w in words]
        places = [i for i, s in enumerate(scores) if s is not None]
        if not places:
            return [], 0.0
        best, passages = 0.0, []
        for a, b, s in maximal_segments(places, [scores[i] for i in places], DRIFT):
            best = max(best, self.rate * s - math.log(len(words)))
            e = len(words) * math.exp(-self.rate * s)
            if e < SIGNIFICANT:
                passages.append((a, b, s, e))
        if passages:
            lowered = text.lower()
            spans = [m.span() for m in _WORD.finditer(text if len(lowered) == len(text) else lowered)]
            if len(spans) == len(words):
                passages = [(spans[a][0], spans[b][1], s, e) for a, b, s, e in passages]
        return passages, best

    def probability(self, evidence: float, passages: int) -> float:
        """Of a text with these; like the fit, it sees rounded values."""
        z = self.shape[0] + self.shape[1] * rounded(evidence) + self.shape[2] * math.log1p(rounded(passages))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _chances(units: DataFrame, tokens: int, share: float) -> list[tuple[float, float]]:
    """(score, share of the clean tokens) of the model's units that stand under no other, summed by scores rounded to thousandths: a bounded table."""
    fronts = F.array_compact(F.array(*(F.when(F.length(F.rtrim("unit", F.lit("*"))) > k, F.concat(F.substring("unit", 1, k), F.lit("*"))) for k in FRONTS)))
    above = units.select("unit", F.explode(fronts).alias("front")).join(units.select(F.col("unit").alias("front")), "front").select("unit").distinct()
    first = units.join(above, "unit", "left_anti")
    theta = (F.col("toxic") + PRIOR * share) / (F.col("toxic") + F.col("clean") + PRIOR)
    score = F.round(F.log(theta / (1 - theta) * ((1 - share) / share)), 3)
    return [tuple(r) for r in first.groupBy(score.alias("s")).agg((F.sum(F.col("clean") + 0.5) / max(tokens, 1)).alias("p")).collect()]


def _rate(chances: list[tuple[float, float]]) -> float:
    """l of the clean tokens. A unit that clean documents lack counts as half a token."""
    positive = [(s, p) for s, p in chances if s > 0]
    if not positive:
        return 1.0
    rest = 1 - sum(p for _, p in positive)
    excess = lambda x: rest * math.exp(-DRIFT * x) + sum(p * math.exp(min(x * s, 700.0)) for s, p in positive) - 1
    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return max(low, 0.2)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """The model of labelled documents; docs and labels hold the training rows only."""
    answers = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    training = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text")).withColumn("_copy", F.sha2("_text", 256))
    # keys and digests are matched first; of the texts only the chosen ones move
    chosen = training.select("_key", "_copy").distinct().join(answers, "_key").groupBy("_copy", "_label").agg(F.min("_key").alias("_key"))
    training = common.kept(training.join(chosen, ["_key", "_copy"]).groupBy("_key", "_copy").agg(F.first("_text").alias("_text"), F.first("_label").alias("_label")).select("_text", "_label"), "toxic_training")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        totals = [0, 0, 0]  # toxic documents, clean documents, clean tokens

        def out() -> pa.RecordBatch:
            rows = [(u, *n, 0) for u, n in seen.items()]
            seen.clear()
            return pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate((("unit", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64()), ("tokens", pa.int64())))})

        for batch in batches:
            for body, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = _WORD.findall((body or "").lower())
                totals[1 - y] += 1
                totals[2] += len(words) * (1 - y)
                for u in {u for w in set(words) for u in units_of(w)}:
                    seen.setdefault(u, [0, 0])[1 - y] += 1
            if len(seen) >= HELD:
                yield out()
        yield out()
        yield pa.RecordBatch.from_pydict({"unit": pa.array([""]), "toxic": pa.array([totals[0]]), "clean": pa.array([totals[1]]), "tokens": pa.array([totals[2]])})

    units = common.kept(common.in_arrow(training, count, "unit string, toxic bigint, clean bigint, tokens bigint").groupBy("unit").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "tokens"))), "toxic_units")
    total = units.where("unit = ''").first()
    n1, n0 = (total["toxic"] or 0, total["clean"] or 0) if total else (0, 0)
    if not n1 or not n0:
        return Model(None, {}, min(max(n1 / max(1, n1 + n0), 1e-9), 1 - 1e-9), shape=(-50.0 if not n1 else 50.0, 0.0, 0.0))
    share = n1 / (n1 + n0)
    n = F.col("toxic") + F.col("clean")
    part = lambda k, of: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (n * of))).otherwise(0.0)
    odds = F.log((F.col("toxic") + PRIOR * share) / (F.col("clean") + PRIOR * (1 - share)) * (1 - share) / share)
    evidence = 2 * (part("toxic", share) + part("clean", 1 - share))
    strong = units.where("unit <> ''").withColumn("evidence", evidence).where((F.col("evidence") > EVIDENCE) & (odds > LEAST_ODDS))
    strong = common.kept(strong, "toxic_strong")
    fronts = F.filter(F.array(*(F.when(F.length("unit") > k, F.concat(F.substring("unit", 1, k), F.lit("*"))) for k in FRONTS)), lambda u: u.isNotNull())
    words = units.where("clean > 0 and unit <> '' and unit not like '%*'")
    under = words.select(F.col("unit").alias("word"), "toxic", "clean", F.explode(fronts).alias("unit")).join(strong.where("unit like '%*'").select("unit"), "unit", "left_semi")
    exceptions = under.select(F.col("word").alias("unit"), "toxic", "clean").distinct()
    known = common.kept(strong.select("unit", "toxic", "clean").union(exceptions).distinct(), "toxic_model")
    counts = {r["unit"]: (r["toxic"], r["clean"]) for r in known.collect()} if known.count() <= UNITS else None
    model = Model(known, counts, share)
    model.rate = _rate(_chances(known, total["tokens"], share))
    model.shape = _fit(training, model)
    return model


def word_scores(df: DataFrame, model: Model, text: str) -> DataFrame:
    """(word, score) of all words in df's texts that the model knows, by joins."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            for body in batch.column(0).to_pylist():
                seen.update(_WORD.findall((body or "").lower()))
            if len(seen) >= HELD:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], names=["word"])
                seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], names=["word"])

    fronts = F.array(*(F.when(F.length("word") > k, F.concat(F.substring("word", 1, k), F.lit("*"))) for k in FRONTS), F.col("word"))
    chain = common.in_arrow(df.select(text), words, "word string").distinct().select("word", F.posexplode(fronts).alias("place", "unit")).where("unit is not null")
    found = chain.join(model.units, "unit").groupBy("word").agg(F.sort_array(F.collect_list(F.struct("place", "toxic", "clean"))).alias("chain"))
    shares = lambda theta, rest: F.struct(theta.alias("theta"), rest.alias("rest"))
    step = lambda s, u: shares((u["toxic"] + PRIOR * s["theta"]) / (u["toxic"] + u["clean"] + PRIOR), (u["clean"] + PRIOR * s["rest"]) / (u["toxic"] + u["clean"] + PRIOR))
    last = F.aggregate("chain", shares(F.lit(model.share), F.lit(1 - model.share)), step)
    return found.select("word", last.alias("s")).select("word", F.log(F.col("s.theta") / F.col("s.rest") * (1 - model.share) / model.share).alias("score"))


def looked_at(df: DataFrame, model: Model, text: str, into: T.StructType, look: Callable[[Scorer, list[str | None]], list[list]]) -> DataFrame:
    """df with the columns `into`, which look(scorer, texts) gives for texts."""
    scorer, names = df.sparkSession.sparkContext.broadcast(model.scorer()), [f.name for f in into]
    fields, kinds, place = df.schema.fields, [to_arrow_type(f.dataType) for f in into], df.columns.index(text)
    width, joined = len(fields), model.counts is None
    if joined:
        row, scores = common.fresh(df, "_row"), common.fresh(df, "_scores")
        df = common.kept(df.withColumn(row, F.monotonically_increasing_id()), "toxic_rows")

        def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [list(set(_WORD.findall((b or "").lower()))) for b in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["row", "words"])

        each = common.in_arrow(df.select(row, text), distinct, "row bigint, words array<string>").select("row", F.explode("words").alias("word"))
        found = each.join(word_scores(df, model, text), "word").groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("word", "score")).alias(scores))
        df = df.join(found, row, "left").select(*(f"`{f.name}`" for f in fields), scores)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = scorer.value
        for batch in batches:
            texts = batch.column(place).to_pylist()
            if joined:
                out: list[list] = [[] for _ in names]
                for body, known in zip(texts, batch.column(width).to_pylist(), strict=True):
                    s.memo = dict.fromkeys(_WORD.findall((body or "").lower())) | {k["word"]: k["score"] for k in known or []}
                    for column, values in zip(out, look(s, [body]), strict=True):
                        column += values
            else:
                out = look(s, texts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *(pa.array(v, t) for v, t in zip(out, kinds, strict=True))], names=[*batch.schema.names[:width], *names])

    return common.in_arrow(df, task, T.StructType([*fields, *into.fields]))


def _fit(training: DataFrame, model: Model) -> tuple[float, float, float]:
    """Logistic fit of labels on evidence and passages; both are rounded, so the driver gets a small table."""

    def look(scorer: Scorer, texts: list[str | None]) -> list[list]:
        found = [scorer.segments(b or "") for b in texts]
        return [[rounded(e) for _, e in found], [rounded(len(p)) for p, _ in found]]

    into = T.StructType([T.StructField("e", T.DoubleType()), T.StructField("p", T.DoubleType())])
    bins = looked_at(training, model, "_text", into, look).groupBy("e", "p", F.col("_label").alias("y")).count().collect()
    x = np.array([[1.0, r["e"] / 10, math.log1p(r["p"])] for r in bins])
    y, n = np.array([r["y"] for r in bins], float), np.array([r["count"] for r in bins], float)
    w, ridge = np.zeros(3), np.diag([1e-6, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x.T * (n * np.maximum(p * (1 - p), 1e-9))) @ x + ridge, x.T @ (n * (y - p)) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1] / 10), float(w[2])


def scored(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """df with toxicity (0 to 1) and passages (start, end, score, e_value; code points of the text, end exclusive)."""

    def look(scorer: Scorer, texts: list[str | None]) -> list[list]:
        found = [scorer.segments(b or "") for b in texts]
        return [[scorer.probability(e, len(p)) for p, e in found], [[dict(zip(("start", "end", "score", "e_value"), x, strict=True)) for x in p] for p, _ in found]]

    into = T.StructType([T.StructField("toxicity", T.DoubleType()), T.StructField("passages", T.ArrayType(SEGMENT))])
    return looked_at(df.drop("toxicity", "passages"), model, text, into, look)


def op4_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held = common.crc_mod(F.col("doc_id"), 4) == 2
    model = learn(docs.where(~held), labels.where(~held))
    out = scored(docs, model)
    return out.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.3).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))
