"""Mixing to target weights with soft membership.

Domains are the combinations of the labels' columns. A classifier gives every document
a posterior over domains: naive Bayes evidence of its words (by BUCKETS hash buckets)
and a few shape statistics go into a softmax regression. Both are fitted on the
labelled rows that come first in an order by hash, SAMPLE at most.

Each document's rate is a nonnegative number; domain k's expected tokens are the sum of
tokens x posterior x rate. Rates minimise the squared misses of the domains' targets and,
with a weight of RIDGE only, what they are away from one, by projected gradient steps with
lazy projection: a document's rate is one minus its posterior x the sum of all steps so far,
cut to zero. So a rate follows from the document's own posterior and DOMAINS numbers: no
state is kept between steps. The gradient, and the matrix of rates above zero by which it
is scaled, are aggregates over all documents; each pass tries several lengths of the step
and the best one is taken, so the objective only falls; where none gains, the step is damped.
Steps end when every domain is within CLOSE of its target, as a share of all tokens, or when
damped steps gain no more; the fit says what is still missed. Rates have no upper limit unless `most` gives one.

Targets are shares of the mixture. The domain with the largest target keeps its
expected tokens and sets the total. Others go up or down to their targets: a rate over
one means that a document is to be repeated. A target of a domain that no document can
belong to cannot be met and stays a miss; the others are met as well as can be.

Null texts are empty and have no tokens. Null ids, labels out of range and unlabelled
rows are fine; of repeated labels the largest counts, and of rows with one id the
classifier reads each different text once. Without labelled rows all posteriors are
equal, and only equal targets can be met. Rows are never merged.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common

DOMAINS = ("poor", "poor_toxic", "good", "good_toxic")  # 2 x quality + toxic
TARGETS = (0.05, 0.005, 0.93, 0.015)
BUCKETS, SAMPLE = 1 << 16, 20_000
#: Weight of the rates' distance from one against that of the misses; misses that end the steps, as shares of all tokens; steps after which a fit that still gains is given up.
RIDGE, CLOSE, STEPS = 1e-9, 1e-4, 200
#: Lengths of a step that are tried in one pass, and what a step has to gain, as a share.
LENGTHS, GAIN = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01), 1e-9
#: How much more a step is damped when no length of it gains, until that is more than all rates' curvature.
DAMPED = 100.0
_UPPER, _SYMBOL = np.zeros(256, bool), np.isin(np.arange(256), list(b"#*$%&|<>!"))
_UPPER[65:91] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


@dataclass
class Scan:
    """Of some rows: number of words, distinct word buckets with their rows, and shape statistics."""

    n_words: np.ndarray
    row: np.ndarray
    bucket: np.ndarray
    shape: np.ndarray


def scan(data: np.ndarray, offsets: np.ndarray) -> Scan:
    lowered = _LOWERED[data]
    starts, ends, counts = common.word_spans(lowered, offsets)
    words = common.span_hashes(lowered, starts, ends)
    rows = np.repeat(np.arange(len(counts)), counts)
    pair = np.unique(rows * BUCKETS + (words % np.uint64(BUCKETS)).astype(np.int64))
    shingles, sizes = common.shingle_hashes(words, counts, 5)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((shingles, owner))
    again = np.zeros(len(shingles), bool)
    again[1:] = (shingles[order][1:] == shingles[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    repeated = np.bincount(owner[order][again], minlength=len(sizes)) / np.maximum(1, sizes)
    size = np.maximum(1, np.diff(offsets))
    total = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    shape = np.stack([np.ones(len(size)), np.log1p(counts) / 5, total(_SYMBOL[data]) / size * 10, total(_UPPER[data]) / size * 5, repeated * 3], 1)
    return Scan(counts, pair // BUCKETS, pair % BUCKETS, shape)


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(quality.isin(0, 1) & toxic.isin(0, 1), 2 * quality + toxic).cast("int")


def labelled_rows(docs: DataFrame, labels: DataFrame, text: str, key: str) -> DataFrame:
    """(text, domain) of SAMPLE rows at most: those first by hash of id and text among the different texts of labelled ids. Only keys and hashes are shuffled, and only the SAMPLE chosen are broadcast."""
    domains = labels.select(F.col(key).alias("_key"), domain_of(F.col("quality"), F.col("toxic")).alias("domain")).where("domain is not null").groupBy("_key").agg(F.max("domain").alias("domain"))
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_hash"))
    chosen = rows.select("_key", "_hash").distinct().join(domains, "_key").orderBy(F.xxhash64("_key"), "_key", "_hash").limit(SAMPLE)
    return rows.join(F.broadcast(chosen), ["_key", "_hash"]).dropDuplicates(["_key", "_hash"]).select("_text", "domain")


def _evidence(labelled: DataFrame) -> np.ndarray:
    """Naive Bayes weights of buckets for each domain; little evidence and weak leanings count nothing."""
    k = len(DOMAINS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS + 1, k), np.int64)
        for batch in batches:
            domain = batch.column(1).to_numpy()
            for row, end, data, offsets in common.steps(batch.column(0)):
                s, mine = scan(data, offsets), domain[row:end]
                np.add.at(total, (s.bucket, mine[s.row]), 1)
                np.add.at(total, (BUCKETS, mine), 1)
        b, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(d), pa.array(total[b, d])], names=["bucket", "domain", "n"])

    rows = common.in_arrow(labelled, count, "bucket bigint, domain bigint, n bigint").groupBy("bucket", "domain").agg(F.sum("n").alias("n")).collect()
    n = np.zeros((BUCKETS + 1, k))
    for r in rows:
        n[r["bucket"], r["domain"]] = r["n"]
    size, n = n[-1], n[:-1]
    if not size.sum():
        return np.zeros((BUCKETS, k), np.float32)
    share = (size + 0.5) / (size.sum() + 0.5 * k)
    total = n.sum(1, keepdims=True)
    expected = total * share
    with np.errstate(divide="ignore", invalid="ignore"):
        strength = 2 * np.where(n > 0, n * np.log(n / expected), 0).sum(1)
    ratio = np.log((n + 2 * share) / (expected + 2 * share))
    return np.where((strength[:, None] > 30) & (abs(ratio) > 1), np.clip(ratio, -3, 3), 0).astype(np.float32)


def _softmax_fit(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Weights of a softmax regression with a small ridge, by gradient steps with momentum."""
    w, speed = np.zeros((x.shape[1], k)), np.zeros((x.shape[1], k))
    target = np.eye(k)[y]
    rate = 1.0 / max(1.0, (x**2).sum(1).mean())
    for _ in range(600):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - rate * (x.T @ (p - target) / len(x) + 1e-4 * w)
        w += speed
    return w


def posteriors(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_key, n_tokens, posterior) of every row; tokens are words here."""
    k, context = len(DOMAINS), docs.sparkSession.sparkContext
    evidence = context.broadcast(_evidence(labelled := labelled_rows(docs, labels, text, key)))

    def values(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = scan(data, offsets)
        found = np.stack([np.bincount(s.row, evidence.value[s.bucket, d], len(offsets) - 1) for d in range(k)], 1)
        return s.n_words, np.concatenate([s.shape, np.arcsinh(found)], 1)

    def lists(x: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in common.steps(batch.column(0)):
                yield pa.RecordBatch.from_arrays([lists(values(data, offsets)[1]), batch.column(1).slice(row, end - row)], names=["x", "domain"])

    sample = common.in_arrow(labelled, known, "x array<double>, domain int").collect()
    if sample:
        w = _softmax_fit(np.array([r["x"] for r in sample]), np.array([r["domain"] for r in sample]), k)
    else:
        w = np.zeros((5 + k, k))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in common.steps(batch.column(1)):
                n, x = values(data, offsets)
                p = np.exp((z := x @ w) - z.max(1, keepdims=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(n), lists(p / p.sum(1, keepdims=True))], names=["_key", "n_tokens", "posterior"])

    return common.in_arrow(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), look, f"_key {docs.schema[key].dataType.simpleString()}, n_tokens bigint, posterior array<double>")


def rates_of(posterior: np.ndarray, steps: np.ndarray, most: float | None = None) -> np.ndarray:
    """Rates of documents (rows of posterior) after steps of that sum."""
    return np.clip(1 - posterior @ steps, 0, most)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(DOMAINS))


@dataclass
class Fitted:
    """steps: the sum of all steps, from which rates follow; of each domain the tokens wanted and those expected at the fitted rates."""

    steps: np.ndarray
    wanted: np.ndarray
    expected: np.ndarray

    def missed(self) -> float:
        """The largest miss of a domain, as a share of all tokens wanted."""
        return float(abs(self.expected - self.wanted).max() / max(self.wanted.sum(), 1e-9))


def fitted(scored: DataFrame, targets: Sequence[float], most: float | None = None, ridge: float = RIDGE) -> Fitted:
    """Projected gradient over (n_tokens, posterior) rows. ridge: what rates away from one weigh."""
    k = len(targets)

    def sums(tried: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """For each sum of steps: the rates' part of the objective, expected tokens of the domains, and tokens x posterior x posterior of rates that are not cut."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(tried), 1 + k + k * k))
            for batch in batches:
                p, n = matrix(batch.column(1)), batch.column(0).to_numpy().astype(float)
                for row, steps in zip(total, tried, strict=True):
                    free = 1 - p @ steps
                    rate = rates_of(p, steps, most)
                    row[0] += (n * rate * (free - rate / 2)).sum()
                    row[1 : 1 + k] += (n * rate) @ p
                    row[1 + k :] += ((p * (n * (rate == free))[:, None]).T @ p).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["i", "x"])

        rows = common.in_arrow(scored.select("n_tokens", "posterior"), add, "i bigint, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
        out = np.zeros(len(tried) * (1 + k + k * k))
        for r in rows:
            out[r["i"]] = r["x"]
        return [(float(row[0]), row[1 : 1 + k], row[1 + k :].reshape(k, k)) for row in out.reshape(len(tried), -1)]

    share = np.array(targets, float) / sum(targets)
    at, (base, have, curve) = np.zeros(k), sums([np.zeros(k)])[0]
    main = int(share.argmax())
    out = Fitted(at, share * have[main] / share[main], have)
    ridge *= max(out.wanted.sum(), 1e-9)
    objective = lambda part, steps: part + out.wanted @ steps + ridge / 2 * steps @ steps
    best = objective(base, at)
    damping, scale = 0.0, max(np.trace(curve), 1e-9)
    for _ in range(STEPS):
        if out.missed() <= CLOSE or damping > scale:
            break
        gradient = have - out.wanted - ridge * at
        step = np.linalg.solve(curve + (ridge + damping) * np.eye(k), gradient)
        tried = [at + length * step for length in LENGTHS]
        found = sums(tried)
        values = [objective(f[0], steps) for f, steps in zip(found, tried, strict=True)]
        i = int(np.argmin(values))
        if best - values[i] <= GAIN * abs(best):  # too far for where the cuts lie: shorter and more along the gradient
            damping = max(damping * DAMPED, scale * 1e-6)
            continue
        damping /= DAMPED
        best, at, (_, have, curve) = values[i], tried[i], found[i]
        out = Fitted(at, out.wanted, have)
    return out


def mixed(docs: DataFrame, labels: DataFrame, targets: Sequence[float] = TARGETS, text: str = "text", key: str = "doc_id", most: float | None = None, ridge: float = RIDGE) -> tuple[DataFrame, Fitted]:
    """(key, n_tokens, posterior, rate) of every row, and the fit. most: the largest rate allowed; ridge: what rates away from one weigh, more for a mixture that should stay near the corpus where targets are hard to reach."""
    scored = common.kept(posteriors(docs, labels, text, key), "mixing_posteriors")
    fit = fitted(scored, targets, most, ridge)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates_of(matrix(batch.column(2)), fit.steps, most))], names=[*batch.schema.names, "rate"])

    schema = f"_key {docs.schema[key].dataType.simpleString()}, n_tokens bigint, posterior array<double>, rate double"
    return common.in_arrow(scored, rate, schema).withColumnRenamed("_key", key), fit


def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document; missed: the largest miss of a target, as a share of all tokens."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out, fit = mixed(common.documents(spark, sf_dir).select("doc_id", "text"), labels)
    return out.select("doc_id", "n_tokens", *(F.get("posterior", F.lit(k)).alias(f"p_{d}") for k, d in enumerate(DOMAINS)), "rate", F.lit(fit.missed()).alias("missed"))
