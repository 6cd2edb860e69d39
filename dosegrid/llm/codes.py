"""Compression of vectors to short codes: a codebook for each part position, fitted by dual-tree Lloyd rounds on integers.

Vectors are cut into PARTS equal parts of whole numbers, floor(SCALE * x). Blocks of
vectors are laid out once, for each part position, in the order of a tree of medians and
kept as a table. Each round sends the codebooks (of fixed size) to all blocks: a tree over
a block's parts and a tree over the entries are gone down together, and a pair of nodes is
dropped when the least distance between their boxes exceeds the largest distance of the
part node's box to another entry node. A part node that has one entry left is assigned as
a whole, by its cached sum and count; parts of uncertain leaves are compared in integers.
Bounds are integers too, and only larger distances are dropped, so assignments, ties by
the lower index included, equal those of an exhaustive search. Sums of a block are one row
for each (part, entry), added by Spark; only PARTS x ENTRIES of them reach the driver.

Vectors that are null or hold a null or a number that is not finite are left out, and so
are those that cannot be cut into PARTS (empty ones, too) or whose length is not that of the
kept vector with the smallest id. Seeds are taken by id, null ids last and equal ids
by vector; fewer kept vectors than ENTRIES give fewer entries, and an empty table no rows
at all. Null ids and null labels are kept; rows with one id are all coded. Numbers whose
squared distances would not fit 64 bits are refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Parts of a tree's leaf.
LEAF = 32
_SUMS = "part int, entry int, n long, sums array<long>"
_BIG = np.iinfo(np.int64).max


def quantised(vector: Column) -> Column:
    """Whole numbers of a vector; null if it holds a null or a number that is not finite."""
    x = vector.cast("array<double>")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * SCALE)))


def tree_order(points: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """An order of points in which every run of `leaf`, and every pair of neighbouring runs up to the whole, is a node: halves by the median of the widest side."""
    order = np.arange(len(points))
    size = leaf
    while size < len(points):
        size *= 2
    while size > leaf:
        for start in range(0, len(points), size):
            run = order[start : start + size]
            if len(run) > size // 2:
                side = np.ptp(points[run], axis=0).argmax()
                order[start : start + size] = run[np.argsort(points[run, side], kind="stable")]
        size //= 2
    return order


class Tree:
    """Boxes, sums and counts of the nodes over points in tree order, level by level from the root."""

    def __init__(self, points: np.ndarray, leaf: int):
        starts = np.arange(0, len(points), leaf)
        low, high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
        total, count = np.add.reduceat(points, starts), np.diff(np.append(starts, len(points)))
        self.levels = [(low, high, total, count)]
        while len(low) > 1:
            pairs = np.arange(0, len(low), 2)
            low, high = np.minimum.reduceat(low, pairs), np.maximum.reduceat(high, pairs)
            total, count = np.add.reduceat(total, pairs), np.add.reduceat(count, pairs)
            self.levels.append((low, high, total, count))
        self.levels.reverse()


def _bounds(a: tuple, p: np.ndarray, b: tuple, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest squared distance between boxes p of a and e of b."""
    al, ah, bl, bh = a[0][p], a[1][p], b[0][e], b[1][e]
    gap = np.maximum(np.maximum(al - bh, bl - ah), 0)
    far = np.maximum(np.abs(ah - bl), np.abs(bh - al))
    return (gap * gap).sum(1), (far * far).sum(1)


def assign(points: np.ndarray, tree: Tree, entries: np.ndarray, leaf: int = LEAF, labels: bool = False):
    """Counts and sums of the points that are nearest to each entry, ties to the lower; with labels, also each point's entry."""
    order = tree_order(entries, 1)
    other = Tree(entries[order], 1)
    counts, sums = np.zeros(len(entries), np.int64), np.zeros(entries.shape, np.int64)
    chosen = np.zeros(len(points), np.int64) if labels else None
    p, e, below = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    for depth, nodes in enumerate(tree.levels):
        gone = False
        while True:  # entries go down a level with each level of the points, and with the last to their leaves
            least, most = _bounds(nodes, p, other.levels[below], e)
            reach = np.full(len(nodes[3]), _BIG)
            np.minimum.at(reach, p, most)
            keep = least <= reach[p]
            p, e = p[keep], e[keep]
            if below + 1 == len(other.levels) or (gone and depth + 1 < len(tree.levels)):
                break
            below, gone = below + 1, True
            wide = len(other.levels[below][3])
            p, e = np.repeat(p, 2), (2 * e[:, None] + [0, 1]).ravel()
            p, e = p[e < wide], e[e < wide]
        left = np.bincount(p, minlength=len(nodes[3]))
        sure = (left[p] == 1) & (below + 1 == len(other.levels))
        if sure.any():
            whole, to = p[sure], order[e[sure]]
            np.add.at(counts, to, nodes[3][whole])
            np.add.at(sums, to, nodes[2][whole])
            if labels:
                span = leaf << (len(tree.levels) - 1 - depth)
                for node, entry in zip(whole.tolist(), to.tolist(), strict=True):
                    chosen[node * span : (node + 1) * span] = entry
            p, e = p[~sure], e[~sure]
        if not len(p):
            break
        if depth + 1 < len(tree.levels):
            wide = len(tree.levels[depth + 1][3])
            e, p = np.repeat(e, 2), (2 * p[:, None] + [0, 1]).ravel()
            p, e = p[p < wide], e[p < wide]
    if len(p):  # leaves with more than one entry left
        nodes = np.unique(p)
        open_to = np.zeros((len(nodes), len(entries)), bool)
        open_to[np.searchsorted(nodes, p), order[e]] = True
        at = (nodes[:, None] * leaf + np.arange(leaf)).ravel()
        owner = np.repeat(np.arange(len(nodes)), leaf)[at < len(points)]
        at = at[at < len(points)]
        gap = points[at][:, None, :] - entries[None]
        far = np.where(open_to[owner], (gap * gap).sum(2), _BIG)
        to = far.argmin(1)
        np.add.at(counts, to, 1)
        np.add.at(sums, to, points[at])
        if labels:
            chosen[at] = to
    return (counts, sums, chosen) if labels else (counts, sums)


def _laid_out(parts: int):
    """A block of each batch: keys, labels, and for each part the tree order of the vectors and the parts in it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            vectors = np.asarray(batch.column("whole").flatten()).reshape(n, parts, -1)
            orders = [tree_order(vectors[:, k]) for k in range(parts)]
            data = np.stack([vectors[o, k] for k, o in enumerate(orders)])
            listed = lambda c: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), c)
            columns = [listed(batch.column("key")), listed(batch.column("label")), pa.array([np.stack(orders).astype("<i4").tobytes()]), pa.array([data.astype("<i4").tobytes()])]
            yield pa.RecordBatch.from_arrays(columns, names=["keys", "labels", "orders", "vectors"])

    return work


def _each_block(batches: Iterator[pa.RecordBatch], parts: int, dim: int):
    """(batch, row, orders, points of each part) of every block."""
    for batch in batches:
        for k in range(batch.num_rows):
            orders = np.frombuffer(batch.column("orders")[k].as_buffer(), "<i4").reshape(parts, -1)
            yield batch, k, orders, np.frombuffer(batch.column("vectors")[k].as_buffer(), "<i4").reshape(parts, -1, dim).astype(np.int64)


def _summed(books: list[np.ndarray], dim: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [np.zeros(len(b), np.int64) for b in books], [np.zeros(b.shape, np.int64) for b in books]
        for _, _, _, blocks in _each_block(batches, len(books), dim):
            for k, points in enumerate(blocks):
                n, s = assign(points, Tree(points, LEAF), books[k])
                counts[k] += n
                sums[k] += s
        rows = [(k, e, int(n), sums[k][e].tolist()) for k in range(len(books)) for e, n in enumerate(counts[k]) if n]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["part", "entry", "n", "sums"])

    return work


def _coded(books: list[np.ndarray], dim: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, orders, blocks in _each_block(batches, len(books), dim):
            n = blocks.shape[1]
            entries, error = np.zeros((n, len(books)), np.int32), np.zeros(n, np.int64)
            for k, points in enumerate(blocks):
                chosen = assign(points, Tree(points, LEAF), books[k], labels=True)[2]
                gap = points - books[k][chosen]
                entries[orders[k], k] = chosen
                error[orders[k]] += (gap * gap).sum(1)
            one = batch.slice(row, 1)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(books)), pa.array(entries.ravel()))
            yield pa.RecordBatch.from_arrays([one.column("keys").flatten(), one.column("labels").flatten(), listed, pa.array(error)], names=["key", "label", "entries", "error"])

    return work


def vectors_of(df: DataFrame, key: str, vector: str, label: str | None, parts: int = PARTS) -> DataFrame:
    """(key, label, whole) of the vectors that are kept."""
    fine = df.select(F.col(key).alias("key"), (F.col(label) if label else F.lit(None).cast("int")).alias("label"), quantised(F.col(vector)).alias("whole"))
    fine = fine.where("whole is not null").where((F.size("whole") > 0) & (F.size("whole") % parts == 0))
    first = fine.orderBy(F.col("key").asc_nulls_last(), "whole").select(F.size("whole").alias("n"), "whole").first()
    return fine.where(F.size("whole") == (first["n"] if first else 0))


def fitted(kept: DataFrame, blocks: DataFrame, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """The codebook of each part position, of entries rows at most."""
    seeds = [r["whole"] for r in kept.orderBy(F.col("key").asc_nulls_last(), "whole").limit(entries).select("whole").collect()]
    start = np.array(seeds, np.int64).reshape(len(seeds), parts, -1)
    books = [start[:, k].copy() for k in range(parts)]
    for _ in range(rounds):
        sums = common.in_arrow(blocks, _summed(books, start.shape[2]), _SUMS).groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[k]) for k in range(start.shape[2]))).alias("sums"))
        for r in sums.collect():  # parts x entries rows
            books[r["part"]][r["entry"]] = np.array(r["sums"], np.int64) // r["n"]
    return books


def coded(df: DataFrame, scratch: common.Scratch, key: str = "vec_id", vector: str = "embedding", label: str | None = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(key, label, entries, error) of every kept vector, and the codebook of each part position."""
    kept = scratch.kept(vectors_of(df, key, vector, label, parts), "vectors")
    types = {c: kept.schema[c].dataType.simpleString() for c in ("key", "label")}
    coded_as = f"key {types['key']}, label {types['label']}, entries array<int>, error long"
    top, dim = kept.agg(F.max(F.array_max(F.transform("whole", lambda v: F.abs(v.cast("double"))))), F.max(F.size("whole"))).first()
    if top is None:
        return df.sparkSession.createDataFrame([], coded_as), [np.zeros((0, 0), np.int64)] * parts
    if 4 * top * top * dim >= 1 << 62 or top >= 1 << 31:
        raise ValueError(f"squared distances of components up to {top / SCALE:g} do not fit")
    blocks = scratch.kept(common.in_arrow(kept, _laid_out(parts), f"keys array<{types['key']}>, labels array<{types['label']}>, orders binary, vectors binary"), "blocks")
    books = fitted(kept, blocks, parts, entries, rounds)
    return common.in_arrow(blocks, _coded(books, dim // parts), coded_as), books


def books_sha256(books: list[np.ndarray]) -> str:
    """Digest of all entries' components in decimal, by part, entry and place, with commas between."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of each vector, its error, the error of its label's vectors and the digest of the codebooks."""
    with common.Scratch(spark, "codes") as scratch:
        found, books = coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), scratch)
        code = F.array_join(F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
        rows = common.kept(found.select(F.col("key").alias("vec_id"), "label", code.alias("code"), "error"), "coded")
    sums = common.kept(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")), "label_errors")
    with_sums = common.joined_to_groups(rows, sums, "label", "rows")
    return with_sums.select("vec_id", "code", "error", "label_error", F.lit(books_sha256(books)).alias("codebooks_sha256"))
