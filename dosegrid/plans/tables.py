"""The driver's tables in the roles of the library's inputs, and the same roles in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METHODS = [f"M{k}" for k in range(1, 8)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def predictions(spark: SparkSession, sf_dir: str, label: Column | None = None) -> DataFrame:
    """Prediction rows as a method's file has them: padded keys, missing values; and a label beside them."""
    value = F.when(F.col("l_tax") != 0, F.col("l_quantity"))
    return table(spark, sf_dir, "lineitem").select(F.concat(F.lit(" D"), "l_partkey").alias("drug"), F.concat(F.lit("C"), "l_suppkey", F.lit(" ")).alias("cell"), value.alias("value"), F.concat(F.lit("M"), "l_linenumber").alias("method"), *([] if label is None else [label.alias("label")]))


PREDICTIONS_SQL = "norm as (select 'D' || l_partkey as drug_name, 'C' || l_suppkey as cell_line, l_quantity as prediction, 'M' || l_linenumber as method from lineitem where l_tax <> 0)"
PIVOT_SQL = PREDICTIONS_SQL + ", wide as (select cell_line, drug_name, " + ", ".join(f"avg(prediction) filter (where method = '{m}') as {m}" for m in METHODS) + " from norm group by 1, 2)"
IMPUTE_SQL = PIVOT_SQL + ", med as (select " + ", ".join(f"median({m}) as med_{m}" for m in METHODS) + " from wide), filled as (select cell_line, drug_name, " + ", ".join(f"coalesce({m}, med_{m}, 0.0) as {m}" for m in METHODS) + " from wide, med)"


def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, cell, y, f): labels and predictions."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("grp"), F.col("l_suppkey").alias("cell"), F.col("l_quantity").alias("y"), (F.col("l_extendedprice") / 2000).alias("f"))


EVALUATION_SQL = "ev as (select l_returnflag as grp, l_suppkey as cell, l_quantity as y, l_extendedprice / 2000 as f from lineitem)"


def omics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, feature, pos, value): 64 features of each sample, some cells null."""
    cells = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample_id"), F.posexplode("embedding").alias("pos", "x"))
    value = F.when((F.col("sample_id") + F.col("pos")) % 11 != 0, F.col("x").cast("double"))
    return cells.select("sample_id", F.concat(F.lit("Gene-"), "pos").alias("feature"), "pos", value.alias("value"))


OMICS_SQL = "om as (select vec_id as sample_id, 'Gene-' || pos as feature, pos, case when (vec_id + pos) % 11 <> 0 then embedding[pos + 1]::double end as value from embeddings, (select unnest(range(64))::int as pos))"


def canonical(spark: SparkSession) -> DataFrame:
    """Every second feature backwards, and five that no sample has."""
    return spark.range(37).select(F.col("id").cast("int").alias("pos"), F.when(F.col("id") < 32, F.concat(F.lit("Gene-"), (62 - 2 * F.col("id")).cast("string"))).otherwise(F.concat(F.lit("Absent-"), F.col("id").cast("string"))).alias("feature"))


CANONICAL_SQL = "ca as (select id::int as pos, case when id < 32 then 'Gene-' || (62 - 2 * id) else 'Absent-' || id end as feature from (select unnest(range(37)) as id))"
