"""Connected components of a table of links, by smallest ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosegrid.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every id in edges (a, b); root: the smallest id of its component. Each round takes the smallest root among neighbours and then the root's root; every round is written out."""
    spark = edges.sparkSession
    with common.Scratch(spark, "components") as scratch:
        both = scratch.kept(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
        roots = scratch.kept(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select("id", F.least("id", "b").alias("root")), "roots")
        while True:
            near = both.join(roots.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("root").alias("near"))
            lower = roots.join(near, "id", "left").select("id", F.col("root").alias("old"), F.least("root", F.coalesce("near", "root")).alias("root"))
            lower = scratch.kept(lower, "roots")
            jump = lower.select(F.col("id").alias("root"), F.col("root").alias("top"))
            new = scratch.kept(lower.join(jump, "root", "left").select("id", "old", F.least("root", F.coalesce("top", "root")).alias("root")), "roots")
            roots = new.select("id", "root")
            if not new.where("old <> root").limit(1).count():
                return common.kept(roots, "roots")
