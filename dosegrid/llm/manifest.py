"""Merkle manifest of a dataset: digests of rows, trees by group, proofs, and their verification.

A leaf is the digest of a row. Leaves of a group are ranked by id; every `FANOUT`
consecutive nodes become one, level by level, until one is left, the group's subroot;
subroots, ranked by group, become the root in the same way. A node is labelled by the
interval [lo, hi) of leaf ranks that it covers, so nesting of intervals is ancestry: the
nodes of a level are bucketed by its width, a node finds its parent in its bucket by
containment, and its siblings are what is left of the parent's interval without its own.

Ranks come from a segmented scan (no task holds a group), levels are tables in the shared
folder, each an eighth of the one before, and proofs are handed down from the root, so that
what all leaves under a node share travels once for that node and not for each leaf.

Null ids rank first; rows with one id rank by digest; equal rows are equal leaves beside
each other. A null group is a group of its own, the first. Null and empty texts differ
(`-` and `0:`). Texts of any length are one digest each. An empty table gives no rows.
Other columns of the input are ignored, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common
from dosegrid.operators.pairs import scanned

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*values: Column) -> Column:
    """Lowercase hex sha256 of texts end to end."""
    return F.sha2(F.concat(*values).cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for a null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(columns: dict[str, Column]) -> Column:
    return digest(*(field(c) for c in columns.values()))


def lowered(text: Column) -> Column:
    """A-Z in lower case, other characters as they are."""
    return F.translate(text, _UPPER, _LOWER)


@dataclass
class Tree:
    """Trees of all groups: tables (grp, leaves, lo, hi, digest, children) by level from 1; leaves: (grp, leaves, lo, hi, digest, carried); subroots: (grp, leaves, digest)."""

    leaves: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame


def leaves_of(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows (grp, digest, carried, ...) with their intervals in the group's order."""
    placed = scanned(rows, ["grp"], order, "lo", total="leaves")
    return placed.select("grp", "leaves", "lo", (F.col("lo") + 1).alias("hi"), "digest", "carried")


def tree_of(scratch: common.Scratch, leaves: DataFrame, name: str) -> Tree:
    """Level after level, each a table, until every group has one node. carried: what a leaf takes along, in its parent's children."""
    most = leaves.agg(F.max("leaves")).first()[0] or 0
    levels, width, below = [], 1, leaves
    single = leaves.where("leaves = 1").select("grp", "leaves", "digest")
    tops = [single]
    while width < most:
        width *= FANOUT
        child = F.struct("lo", "hi", "digest", *(["carried"] if not levels else []))
        groups = below.where(F.col("leaves") > width // FANOUT).groupBy("grp", "leaves", F.expr(f"lo div {width}").alias("bucket")).agg(F.array_sort(F.collect_list(child)).alias("children"))
        nodes = groups.select("grp", "leaves", F.col("children")[0]["lo"].alias("lo"), F.array_max("children.hi").alias("hi"), digest(F.array_join("children.digest", "")).alias("digest"), "children")
        below = scratch.kept(nodes, f"{name}-{width}")
        levels.append(below)
        tops.append(below.where(F.col("leaves") <= width).select("grp", "leaves", "digest"))
    subroots = tops[0]
    for t in tops[1:]:
        subroots = subroots.union(t)
    return Tree(leaves, levels, scratch.kept(subroots, f"{name}-subroots"))


def _beside(children: Column, lo: Column, hi: Column) -> Column:
    """A parent's interval without [lo, hi): digests before it and after it."""
    text = lambda part: F.array_join(F.transform(part, lambda c: c["digest"]), "")
    return F.struct(text(F.filter(children, lambda c: c["hi"] <= lo)).alias("left"), text(F.filter(children, lambda c: c["lo"] >= hi)).alias("right"))


def proofs(scratch: common.Scratch, tree: Tree, above: DataFrame, name: str) -> DataFrame:
    """(grp, lo, digest, carried, path, and the columns of above) of every leaf: path has the siblings of each level, from the leaf up.

    above: (grp, path, ...) of each group's subroot: the levels over it, up to the root.
    """
    extra = [c for c in above.columns if c not in ("grp", "path")]
    handed = None  # (grp, lo, hi, path, ...) of nodes of the level below
    out = tree.leaves.where("leaves = 1").join(above, "grp").select("grp", "lo", "digest", "carried", "path", *extra)
    for k in reversed(range(len(tree.levels))):
        nodes, width = tree.levels[k], FANOUT ** (k + 1)
        tops = nodes.where(F.col("leaves") <= width).join(above, "grp").select("grp", "lo", "children", "path", *extra)
        if handed is not None:  # nodes in the buckets of this level's width, by containment
            mine = nodes.where(F.col("leaves") > width).select("grp", "lo", "hi", "children", F.expr(f"lo div {width}").alias("bucket"))
            over = handed.withColumnsRenamed({"lo": "over_lo", "hi": "over_hi"}).withColumn("bucket", F.expr(f"over_lo div {width}"))
            tops = tops.union(mine.join(over, ["grp", "bucket"]).where("over_lo <= lo and hi <= over_hi").select("grp", "lo", "children", "path", *extra))
        spread = tops.select("grp", "children", "path", *extra, F.explode("children").alias("c"))
        path = F.concat(F.array(_beside(F.col("children"), F.col("c.lo"), F.col("c.hi"))), F.col("path")).alias("path")
        if k:
            handed = scratch.kept(spread.select("grp", F.col("c.lo").alias("lo"), F.col("c.hi").alias("hi"), path, *extra), f"{name}-{width}")
        else:
            out = out.union(spread.select("grp", F.col("c.lo").alias("lo"), F.col("c.digest").alias("digest"), F.col("c.carried").alias("carried"), path, *extra))
    return out


def proof(path: Column) -> Column:
    """Digest of the siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give. A level without siblings is a node of one child."""
    return F.aggregate(path, leaf, lambda at, s: digest(s["left"], at, s["right"]))


def manifest(rows: DataFrame, leaf: Column, group: Column, key: Column, carried: Column, scratch: common.Scratch) -> DataFrame:
    """(lo, leaf, carried, subroot, root, path) of every row; group and key: columns that group and rank the leaves."""
    named = F.when(group.isNull(), "").otherwise(F.concat(F.lit("+"), group.cast("string")))
    made = scratch.kept(rows.select(named.alias("grp"), key.alias("key"), leaf.alias("digest"), carried.alias("carried")), "rows")  # texts are read once
    trees = tree_of(scratch, leaves_of(made, ["key", "digest"]), "tree")
    tops = trees.subroots.select(F.lit("").alias("grp"), "digest", F.col("grp").alias("carried"))
    root_tree = tree_of(scratch, scratch.kept(leaves_of(tops, ["carried"]), "tops"), "root")
    start = root_tree.subroots.select("grp", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("digest").alias("root"))
    above = proofs(scratch, root_tree, start, "over").select(F.col("carried").alias("grp"), "path", F.col("digest").alias("subroot"), "root")
    return proofs(scratch, trees, scratch.kept(above, "above"), "path").select("lo", F.col("digest").alias("leaf"), "carried", "subroot", "root", "path")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, subroots, root and proofs of all documents, and whether each still folds to the root when some have been tampered with."""
    docs = common.documents(spark, sf_dir)
    columns = {c: F.col(c) for c in FIELDS}
    tampered = F.when(common.crc_mod(F.col("doc_id"), 3) == 0, leaf_of(columns | {"text": lowered(F.col("text"))}))
    with common.Scratch(spark, "manifest") as scratch:
        found = manifest(docs, leaf_of(columns), F.col("lang"), F.col("doc_id"), F.struct("doc_id", tampered.alias("seen")), scratch)
        given = F.coalesce("carried.seen", "leaf")
        out = found.select("carried.doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded(given, F.col("path")).alias("folded_root"))
        return common.kept(out.withColumn("verified", F.col("folded_root") == F.col("root")), "manifest_rows")
