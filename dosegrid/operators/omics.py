"""Alignment and scaling of omics matrices in long form (sample_id, feature, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosegrid.functions.columns import clean_compact


def aligned(matrix: DataFrame, canonical: DataFrame, null_policy: str = "keep") -> DataFrame:
    """(sample_id, pos, feature, value) of every sample and canonical feature: absent features are 0; null cells stay null ('keep') or are 0 ('zero'). The canonical list (pos, feature) has some thousand rows."""
    samples = matrix.select("sample_id").distinct()
    full = samples.crossJoin(canonical)
    cells = matrix.select("sample_id", "feature", "value", F.lit(True).alias("present"))
    value = F.when(F.col("present"), F.col("value")).otherwise(0.0)
    return full.join(cells, ["sample_id", "feature"], "left").select("sample_id", "pos", "feature", (F.coalesce(value, F.lit(0.0)) if null_policy == "zero" else value).alias("value"))


def aligned_by_clean_name(matrix: DataFrame, canonical: DataFrame, null_policy: str = "keep") -> DataFrame:
    """As aligned, by names cleaned to letters and digits; of inputs with one cleaned name the last column (pos) wins."""
    cells = matrix.groupBy("sample_id", clean_compact(F.col("feature")).alias("feature")).agg(F.max_by("value", "pos").alias("value"))
    names = canonical.select("pos", clean_compact(F.col("feature")).alias("feature"), F.col("feature").alias("name"))
    return aligned(cells, names.select("pos", "feature"), null_policy)


def packed(cells: DataFrame) -> DataFrame:
    """(sample_id, features): values in canonical order."""
    return cells.groupBy("sample_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("features"))


def alignment_report(matrix: DataFrame, canonical: DataFrame) -> DataFrame:
    names = matrix.select("feature").distinct()
    both = canonical.join(names.withColumn("there", F.lit(1)), "feature", "left")
    extra = names.join(canonical, "feature", "left_anti")
    return both.agg(F.count("there").alias("found"), F.count_if(F.col("there").isNull()).alias("missing")).crossJoin(extra.agg(F.count("feature").alias("extra")))


def quality_gate(cells: DataFrame, most: int = 10) -> DataFrame:
    """Features with null, NaN or infinite cells, the first ones by position."""
    bad = F.col("value").isNull() | F.isnan("value") | (F.abs("value") == float("inf"))
    return cells.groupBy("pos", "feature").agg(F.count_if(bad).alias("bad")).where("bad > 0").orderBy("pos").limit(most)


def mutation_multi_hot(matrix: DataFrame, index: DataFrame) -> DataFrame:
    """(sample_id, idx) where a mutation is set: value neither null nor 0; a name without a suffix is a `_mut` one; unknown names are left out."""
    key = F.when(F.col("feature").contains("_"), F.col("feature")).otherwise(F.concat("feature", F.lit("_mut")))
    return matrix.where("value is not null and value <> 0").select("sample_id", key.alias("feature")).join(index, "feature").select("sample_id", "idx").distinct()


def top_features(matrix: DataFrame, k: int = 256) -> DataFrame:
    """The k largest values of each sample, ties by position."""
    w = Window.partitionBy("sample_id").orderBy(F.col("value").desc(), F.col("pos").asc())
    return matrix.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mean_embedding(top: DataFrame, samples: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """(sample_id, vec): mean vector (key, vec) of the top features that have one; zeros if none has."""
    parts = top.join(vectors, top["feature"] == vectors["key"]).select("sample_id", F.posexplode("vec").alias("d", "x"))
    means = parts.groupBy("sample_id", "d").agg(F.avg("x").alias("x")).groupBy("sample_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda s: s["x"]).alias("vec"))
    return samples.join(means, "sample_id", "left").withColumn("vec", F.coalesce("vec", F.array_repeat(F.lit(0.0), dim)))


def assembled(expression: DataFrame, mutation: DataFrame, copies: DataFrame) -> DataFrame:
    """The three packed blocks of the samples that all have."""
    block = lambda df, name: df.select("sample_id", F.col("features").alias(name))
    return block(expression, "expression").join(block(mutation, "mutation"), "sample_id").join(block(copies, "copies"), "sample_id")
