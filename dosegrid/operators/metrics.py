"""Statistics and evaluation by group, with labels y and predictions f."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosegrid.functions.special import correlation_p
from dosegrid.operators.pairs import numbered, scanned
from dosegrid.sources.shared import kept

#: Rows of a block in the count of concordant pairs, and of a group that is counted whole.
BLOCK = 1 << 16
#: Rows of whole groups that are counted together, and rows of a task.
HELD, TASK_ROWS = 1 << 17, 1 << 20
#: Rows of a group whose pairs are all formed.
PAIRED = 20_000


def pearson(y: Column, f: Column) -> Column:
    """r in [-1, 1]; null for a constant or fewer than two pairs."""
    r = F.covar_pop(y, f) / F.nullif(F.stddev_pop(y) * F.stddev_pop(f), F.lit(0.0))
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def _correlation() -> Column:
    """r in [-1, 1] from sums n, sa, sb, saa, sbb and sab; null if what is left of a spread is rounding only."""
    left = lambda s, ss: F.col("n") * F.col(ss) - F.col(s) * F.col(s)
    spread = lambda s, ss: F.when(left(s, ss) > 1e-12 * F.col("n") * F.col(ss), left(s, ss))
    r = (F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")) / F.sqrt(spread("sa", "saa") * spread("sb", "sbb"))
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def r_squared(y: Column, f: Column) -> Column:
    return 1 - F.sum((y - f) * (y - f)) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))


def errors(df: DataFrame, by: Sequence[str], y: str = "y", f: str = "f") -> DataFrame:
    a, b = F.col(y), F.col(f)
    mse = F.avg((a - b) * (a - b))
    return df.where(a.isNotNull() & b.isNotNull()).groupBy(*by).agg(F.count(a).alias("n"), mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(a - b)).alias("mae"), r_squared(a, b).alias("r2"), pearson(a, b).alias("pearson"))


def average_places(counts: DataFrame, by: Sequence[str], value: str, into: str) -> DataFrame:
    """(by, value, into): the mean place, from 0, of the rows with a value in their group, from the values' counts (by, value, n). Ties are one row however many there are, and no task sees a whole group."""
    placed = scanned(counts, by, [value], sums={"upto_": F.col("n")})
    return placed.select(*by, value, (F.col("upto_") - F.col("n") + (F.col("n") - 1) / 2).alias(into))


def spearman(df: DataFrame, by: Sequence[str], y: str = "y", f: str = "f") -> DataFrame:
    """Correlation of average ranks; null for a constant or fewer than two pairs."""
    rows = df.where(F.col(y).isNotNull() & F.col(f).isNotNull()).groupBy(*by, F.col(y).alias("y"), F.col(f).alias("f")).agg(F.count("*").alias("n"))
    cells = kept(rows, "value_pairs")
    ranked = cells
    for value in ("y", "f"):
        places = average_places(cells.groupBy(*by, value).agg(F.sum("n").alias("n")), by, value, f"r{value}")
        names = {k: f"_k{i}" for i, k in enumerate((*by, value))}
        places = places.withColumnsRenamed(names)
        ranked = ranked.join(places, reduce(Column.__and__, (ranked[k].eqNullSafe(places[v]) for k, v in names.items()))).drop(*names.values())
    n, a, b = F.col("n"), F.col("ry"), F.col("rf")
    sums = ranked.groupBy(*by).agg(F.sum(n).cast("double").alias("n"), *(F.sum(n * x).alias(name) for name, x in (("sa", a), ("sb", b), ("saa", a * a), ("sbb", b * b), ("sab", a * b))))
    return sums.select(*by, _correlation().alias("spearman"))


def rising_pairs(first: np.ndarray, second: np.ndarray) -> int:
    """Pairs of rows that rise in both; rows that are equal in one do not rise. Rows are merged by ever larger blocks, all blocks of a size at once."""
    order = np.lexsort((-second, first))  # of equal firsts the larger second comes first, so that they are not counted
    rank = np.unique(second, return_inverse=True)[1][order]
    place, found, size = np.arange(len(rank)), 0, 1
    while size < len(rank):
        block, left = place // (2 * size), place // size % 2 == 0
        by = np.lexsort((left, rank, block))  # of equal seconds the right half comes first
        low = left[by]
        before = np.cumsum(low)
        start = np.concatenate([[0], before])[np.searchsorted(block[by], block[by])]
        found += int((before - start)[~low].sum())
        size *= 2
    return found


def _apart(cells: DataFrame) -> DataFrame:
    """(g, n): pairs of rows whose blocks rise in both, from counts by pairs of blocks (g, by, bf, count).

    Two rising block numbers first differ at one bit of either. So for each pair of bits the
    cells are counted by what stands before them: those with both bits 0 pair with those with
    both bits 1. Blocks are numbered from a group's first, and groups within one block of
    either, nearly all if they are small, have nothing to count.
    """
    spans = cells.groupBy("g").agg(F.min("by").alias("y0"), F.min("bf").alias("f0"), (F.max("by") - F.min("by")).alias("dy"), (F.max("bf") - F.min("bf")).alias("df")).where("dy > 0 and df > 0")
    wide = cells.join(spans, "g").select("g", (F.col("by") - F.col("y0")).alias("a"), (F.col("bf") - F.col("f0")).alias("b"), "count", F.length(F.bin("dy")).alias("bits_y"), F.length(F.bin("df")).alias("bits_f"))
    bits = lambda n, name: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)
    up = wide.select("*", bits("bits_y", "k")).groupBy("g", "k", F.expr("shiftright(a, k)").alias("a"), "b", "bits_f").agg(F.sum("count").alias("count"))
    low, high = F.expr("a & 1 = 0 and shiftright(b, m) & 1 = 0"), F.expr("a & 1 = 1 and shiftright(b, m) & 1 = 1")
    quarters = up.select("*", bits("bits_f", "m")).where(low | high).groupBy("g", "k", "m", F.expr("shiftright(a, 1)").alias("up_a"), F.expr("shiftright(b, m + 1)").alias("up_b"))
    halves = quarters.agg(F.sum(F.when(low, F.col("count"))).alias("low"), F.sum(F.when(high, F.col("count"))).alias("high"))
    return halves.groupBy("g").agg(F.coalesce(F.sum(F.col("low") * F.col("high")), F.lit(0)).alias("n"))


def concordances(group: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
    """`concordance` of each of the groups, which are numbered from 0 and stand together; NaN for none. Blocks of all groups are merged at once, as in `rising_pairs`."""
    ranks = [np.unique(x, return_inverse=True) for x in (y, f)]
    (_, a), (values, b) = ranks
    width = len(values)
    firsts = group * np.int64(len(ranks[0][0])) + a
    key = firsts * width + (width - 1 - b)  # of equal firsts the larger second comes first
    order = np.argsort(key)
    key, firsts, g, b = key[order], firsts[order], group[order], b[order]
    sizes = np.bincount(g)
    n, many = len(g), len(sizes)

    def pairs(ordered: np.ndarray) -> np.ndarray:
        """Pairs of rows with equal keys, by group, from keys that ascend with the groups."""
        start = np.flatnonzero(np.diff(ordered, prepend=ordered[0] - 1))
        count = np.diff(start, append=n)
        return np.bincount(g[start], count * (count - 1) / 2, many)

    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rising, size, by = np.zeros(many), 1, np.arange(n)
    while size < sizes.max():
        block = g * (int(sizes.max()) // (2 * size) + 1) + place // (2 * size)
        left = place // size % 2 == 0
        level = (block * width + b) * 2 + left  # of equal seconds the right half comes first
        by = by[np.argsort(level[by], kind="stable")]
        low, own = left[by], block[by]
        before = np.cumsum(low)
        start = np.flatnonzero(np.diff(own, prepend=-1))
        base = np.repeat((before - low)[start], np.diff(start, append=n))
        rising += np.bincount(g[by], np.where(low, 0, before - base), many)
        size *= 2
    share = rising + 0.5 * (pairs(np.sort(g * np.int64(width) + b)) - pairs(key))
    of = sizes * (sizes - 1) / 2 - pairs(firsts)
    return np.divide(share, of, out=np.full(many, np.nan), where=of > 0)


def concordance(df: DataFrame, by: str, y: str = "y", f: str = "f") -> DataFrame:
    """(by, ci): share of pairs with y_i > y_j that have f_i > f_j, ties in f counting half; null without such pairs.

    Rows are dealt by group once, and groups of BLOCK rows at most are counted whole, many
    together; larger ones are counted in blocks by many tasks.
    """
    rows = df.where(F.col(y).isNotNull() & F.col(f).isNotNull()).select(F.col(by).alias("g"), F.col(y).cast("double").alias("y"), F.col(f).cast("double").alias("f"))
    if df.schema[by].dataType.typeName() in ("float", "double"):
        rows = rows.withColumn("g", F.col("g") + F.lit(0).cast(df.schema[by].dataType))  # -0 is 0
    sizes = rows.groupBy("g").agg(F.count("*").alias("n"))
    total, largest = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    schema = f"g {df.schema[by].dataType.simpleString()}, ci double"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0

        def counted(last: bool) -> Iterator[pa.RecordBatch]:
            """Shares of the groups that wait, but for the last one if more of it may come."""
            table = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            keys = table.column(0).combine_chunks()
            codes = (keys if isinstance(keys, pa.Array) else keys.chunk(0)).dictionary_encode(null_encoding="encode")
            group = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            end = len(group) if last else int(np.searchsorted(group, group[-1]))
            if end < len(group):
                waiting.extend(table.slice(end).to_batches())
            if end:
                found = concordances(group[:end], *(table.column(k).to_numpy()[:end] for k in (1, 2)))
                yield pa.RecordBatch.from_arrays([codes.dictionary.slice(0, len(found)), pa.array(found, from_pandas=True)], names=["g", "ci"])

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n > HELD:
                yield from counted(False)
                n = sum(b.num_rows for b in waiting)
        if waiting:
            yield from counted(True)

    small, others = rows, None
    if largest > BLOCK:
        large = sizes.where(F.col("n") > BLOCK).select(F.col("g").alias("_large"))
        same = F.col("g").eqNullSafe(F.col("_large"))
        small, others = rows.join(F.broadcast(large), same, "left_anti"), rows.join(F.broadcast(large), same, "left_semi")  # fewer than one in BLOCK rows
    tasks = max(-(-total // TASK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = small.repartition(tasks, "g").sortWithinPartitions("g").mapInArrow(count, schema)
    if others is not None:
        found = found.union(concordance_in_blocks(others, "g"))
    return found.select(F.col("g").alias(by), "ci")


def concordance_in_blocks(df: DataFrame, by: str, y: str = "y", f: str = "f") -> DataFrame:
    """As `concordance`, for groups of any size.

    Each row has its place by y and its place by f, ties in either falling in the other, so
    that concordant pairs are those that rise in both places. Places are cut into blocks of
    BLOCK. Pairs of one block by y, and of one block by f, are counted block by block; all
    others rise if their blocks do, which counts by pairs of blocks tell, bit by bit. So no
    task holds a whole group, nor all blocks of one.
    """
    rows = df.where(F.col(y).isNotNull() & F.col(f).isNotNull()).select(F.col(by).alias("g"), F.col(y).cast("double").alias("y"), F.col(f).cast("double").alias("f")).withColumns({"falling_y": -F.col("y"), "falling_f": -F.col("f")})
    by_y = numbered(rows, ["g", "y", "falling_f"], "py").withColumn("back", -F.col("py"))
    placed = kept(numbered(by_y, ["g", "f", "falling_y", "back"], "pf").select("g", "y", "f", "py", "pf", F.expr(f"py div {BLOCK}").alias("by"), F.expr(f"pf div {BLOCK}").alias("bf")), "placed")
    schema = f"g {df.schema[by].dataType.simpleString()}, n long"

    def inside(first: str, second: str):
        return lambda key, rows: pd.DataFrame({"g": [key[0]], "n": [rising_pairs(rows[first].to_numpy(), rows[second].to_numpy())]})

    found = placed.select("g", "by", "py", "pf").groupBy("g", "by").applyInPandas(inside("py", "pf"), schema)
    most = placed.agg(F.max(F.greatest("by", "bf"))).first()[0]
    if most:  # more than one block
        found = found.union(placed.select("g", "by", "bf", "pf").groupBy("g", "bf").applyInPandas(inside("by", "pf"), schema))
        found = found.union(_apart(kept(placed.groupBy("g", "by", "bf").count(), "cells")))
    found = found.groupBy("g").agg(F.sum("n").alias("rising"))
    # pairs of equal rows: counts of (y, f) are summed up to y, to f and to the group
    both = kept(placed.groupBy("g", "y", "f").count(), "equal_rows")
    pairs = lambda *keys: both.groupBy("g", *keys).agg(F.sum("count").alias("c")).groupBy("g").agg(F.sum(F.expr("c * (c - 1) div 2")).alias("_".join(("n", *keys))))
    every = reduce(lambda a, b: a.join(b, "g"), [pairs(), pairs("y"), pairs("f"), pairs("y", "f"), found])
    share = (F.col("rising") + 0.5 * (F.col("n_f") - F.col("n_y_f"))) / F.nullif(F.col("n") - F.col("n_y"), F.lit(0))
    return every.select(F.col("g").alias(by), share.alias("ci"))


def concordance_by_pairs(df: DataFrame, by: str, y: str = "y", f: str = "f") -> DataFrame:
    """The same from all pairs of each group of PAIRED rows at most, and from counts for larger ones."""
    rows = df.select(by, F.col(y).alias("y"), F.col(f).alias("f")).where("y is not null and f is not null")
    sizes = rows.groupBy(by).agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > PAIRED).select(by)
    small = rows.join(large, rows[by].eqNullSafe(large[by]), "left_anti")
    a, b = small.toDF("g", "y1", "f1"), small.toDF("h", "y2", "f2")
    pairs = a.join(b, F.col("g").eqNullSafe(F.col("h")) & (F.col("y1") > F.col("y2")))
    found = pairs.groupBy(F.col("g").alias(by)).agg(F.avg(F.when(F.col("f1") > F.col("f2"), 1.0).when(F.col("f1") == F.col("f2"), 0.5).otherwise(0.0)).alias("ci"))
    if large.limit(1).count():
        many = rows.join(large, rows[by].eqNullSafe(large[by]), "left_semi")
        found = found.union(concordance(many, by).where("ci is not null"))
    return found


def p_values(df: DataFrame, r: str, n: str, into: str = "p_value") -> DataFrame:
    """df of one row for each group, with the two-sided p-value of its correlation."""
    return df.withColumn(into, correlation_p(F.col(r), F.col(n)))


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(by, groups, smallest, largest, mean_size) for each key, in one pass."""
    which = F.expr("case " + " ".join(f"when grouping({k}) = 0 then '{k}'" for k in keys) + " end")
    counts = df.groupingSets([[F.col(k)] for k in keys], *map(F.col, keys)).agg(F.count("*").alias("n"), which.alias("by"))
    return counts.groupBy("by").agg(F.count("n").alias("groups"), F.min("n").alias("smallest"), F.max("n").alias("largest"), F.avg("n").alias("mean_size"))


def column_profile(df: DataFrame) -> DataFrame:
    """(column, present, distinct_values) of every column."""
    row = df.agg(*(F.struct(F.lit(c).alias("column"), F.count(c).alias("present"), F.countDistinct(c).alias("distinct_values")).alias(f"c{k}") for k, c in enumerate(df.columns)))
    return row.select(F.explode(F.array(*row.columns)).alias("r")).select("r.*")


def shares(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("total"))
    return counts.join(F.broadcast(total)).select(column, "n", (F.col("n") / F.col("total")).alias("share"))


def confidence(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Mean of repeated predictions, and 1 - deviation / 0.5, also cut at 0."""
    level = 1 - F.coalesce(F.stddev_samp(value), F.lit(0.0)) / 0.5
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), level.alias("confidence"), F.greatest(F.lit(0.0), level).alias("confidence_cut"))


def best_epoch(df: DataFrame, run: str, epoch: str, loss: str) -> DataFrame:
    """The row of each run with the lowest loss, the first of equals."""
    return df.groupBy(run).agg(F.min_by(F.struct(epoch, loss), F.struct(loss, epoch)).alias("r")).select(run, "r.*")


def newest_checkpoint(df: DataFrame, run: str, name: str) -> DataFrame:
    return df.groupBy(run).agg(F.max_by(name, F.regexp_extract(name, r"_epoch(\d+)", 1).try_cast("int")).alias(name))


def running_best(df: DataFrame, run: str, epoch: str, loss: str) -> DataFrame:
    """Whether a row's loss is under those of all rows of its run before it; the first row's is."""
    placed = scanned(df, [run], [epoch], lows={"before_": F.col(loss)})
    return placed.select(*df.columns, F.coalesce(F.col(loss) < F.col("before_"), F.lit(True)).alias("is_best"))


def running_correlation(df: DataFrame, by: str, order: str, y: str, f: str, every: int) -> DataFrame:
    """Correlation of all rows so far, at every so many rows of each group, from running sums of what is left of the overall means."""
    means = df.agg(F.avg(y).alias("mean_y"), F.avg(f).alias("mean_f"))  # one row
    rows = df.join(F.broadcast(means)).select(by, F.col(order).alias("at_"), (F.col(y) - F.col("mean_y")).alias("a"), (F.col(f) - F.col("mean_f")).alias("b"))
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    of = lambda c: F.when(both, c)
    a, b = F.col("a"), F.col("b")
    sums = scanned(rows, [by], ["at_"], "idx", {"n": of(F.lit(1)), "sa": of(a), "sb": of(b), "saa": of(a * a), "sbb": of(b * b), "sab": of(a * b)})
    sums = sums.where((F.col("idx") % every == 0) & (F.col("idx") > 0))
    return sums.select(by, "idx", _correlation().alias("r"))


def dense_index(df: DataFrame, column: str) -> DataFrame:
    """(column, idx) of the distinct ids in order."""
    return numbered(df.select(column).distinct(), [column], "idx").select(column, "idx")
