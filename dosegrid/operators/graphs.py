"""Molecular graphs as tables of edges (graph_id, src, dst)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosegrid.operators.pairs import scanned

#: Categories of a self-loop's edge.
LOOP = (0, 5, 8, 10, 12)


def directed(edges: DataFrame) -> DataFrame:
    """Each bond both ways, once."""
    return edges.select("graph_id", "src", "dst").union(edges.select("graph_id", F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()


def with_self_loops(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an attribute array, and one loop for each node (graph_id, node)."""
    return edges.unionByName(nodes.select("graph_id", F.col("node").alias("src"), F.col("node").alias("dst"), F.array(*map(F.lit, LOOP)).alias("attr")))


def batch_offsets(graphs: DataFrame, batch: str = "batch_id") -> DataFrame:
    """First node of each graph (graph_id, num_nodes) in its batch, by a scan that no batch's size holds up."""
    placed = scanned(graphs, [batch], ["graph_id"], sums={"upto_": F.col("num_nodes")})
    return placed.select(*graphs.columns, (F.col("upto_") - F.coalesce("num_nodes", F.lit(0))).alias("offset"))


def category_ids(values: Sequence[str], sizes: Sequence[int]) -> list[Column]:
    """Columns of categories moved to ranges that do not overlap."""
    return [F.col(v) + sum(sizes[:k]) for k, v in enumerate(values)]
