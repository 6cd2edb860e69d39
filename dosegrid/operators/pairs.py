"""Joins of drugs and cell lines: grids, missing pairs, lookups, chunks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosegrid.sources.shared import kept

#: Rows up to which the cell lines of a grid are broadcast; beyond that Spark picks its own plan.
BROADCAST_ROWS = 100_000
#: Keys of a block of either side of a grid, and pairs that a task makes at most if it has several blocks.
DRUG_BLOCK, CELL_BLOCK, TASK_PAIRS = 256, 4096, 1 << 24
#: Measured rows that a task gathers by drug and block, on average.
TASK_ROWS = 1 << 16


def blocked(df: DataFrame, size: int, into: str) -> tuple[DataFrame, int]:
    """(block, into): rows in arrays of so many at most, kept as a table; and how many rows there are. A single column is an array of its values, several are one of structs."""
    rows = numbered(df, df.columns, "_no")
    value = F.col(df.columns[0]) if len(df.columns) == 1 else F.struct(*df.columns)
    one = F.collect_list(F.struct(F.col("_no"), value.alias("v")))  # a null stays a row
    blocks = rows.groupBy(F.expr(f"_no div {size}").alias("block")).agg(F.transform(F.array_sort(one), lambda x: x["v"]).alias(into))
    blocks = kept(blocks, into)
    return blocks, blocks.agg(F.coalesce(F.sum(F.size(into)), F.lit(0))).first()[0]


def unhurried(df: DataFrame, tasks: int) -> DataFrame:
    """df, in so many partitions or as many as it has, with a step after it that only hands rows on. A compiled stage makes all rows of an input row before it gives one away, so a stage that went through two blocks would hold their whole product; with the step between it holds one block's."""
    return df.coalesce(tasks)


def grid(drugs: DataFrame, cells: DataFrame) -> DataFrame:
    """All pairs of two frames of keys; attributes are joined later.

    Both sides are cut into blocks, so that pairs of blocks are what travels and the pairs of
    rows are made within tasks. A task goes through a block of cell lines for one drug after
    the other, so that its output repeats within a short reach and packs well.
    """
    (left, n), (right, m) = blocked(drugs, DRUG_BLOCK, "drug_block"), blocked(cells, CELL_BLOCK, "cell_block")
    ids = right.select(F.col("block").alias("cell_no"))
    tasks = max(1, min(-(-n // DRUG_BLOCK) * -(-m // CELL_BLOCK), -(-n * m // TASK_PAIRS)))
    both = left.crossJoin(F.broadcast(ids)).repartition(tasks, "block", "cell_no")  # an id for each block of cell lines
    if m <= BROADCAST_ROWS:
        each = unhurried(both.select("cell_no", F.explode("drug_block").alias("_d")), tasks)
        each = each.join(F.broadcast(right), each["cell_no"] == right["block"])
    else:
        each = both.join(right, both["cell_no"] == right["block"])
        each = unhurried(each.select("cell_block", F.explode("drug_block").alias("_d")), tasks)
    rows = each.select("_d", F.explode("cell_block").alias("_c"))
    field = lambda df, c: [F.col(c).alias(df.columns[0])] if len(df.columns) == 1 else [F.col(c)[k].alias(k) for k in df.columns]
    return rows.select(*field(drugs, "_d"), *field(cells, "_c"))


def missing_pairs(measured: DataFrame, drug: str, cell: str) -> DataFrame:
    """Pairs of a drug and a cell line of the table that have no row in it.

    Rows are dealt once, by drug and block of cell lines. Measured cell lines are taken off
    the blocks in which a drug has any; its other blocks are whole, and only their numbers are
    kept, as what a drug has. So neither the grid nor its pairs of drugs and blocks ever travel.
    """
    keys = measured.select(F.col(drug).alias("_d"), F.col(cell).alias("_c"))
    cells, m = blocked(keys.select("_c").distinct(), CELL_BLOCK, "cell_block")
    few = F.broadcast if m <= BROADCAST_ROWS else lambda df: df
    placed = keys.join(few(cells.select("block", F.explode("cell_block").alias("_c"))), "_c", "left")
    placed = placed.select("_d", F.when(F.col("_d").isNotNull(), F.col("block")).alias("block"), "_c")  # a pair with a null counts as missing
    own = kept(placed.repartition(max(1, -(-keys.count() // TASK_ROWS)), "_d", "block").groupBy("_d", "block").agg(F.collect_set("_c").alias("own")), "own")
    drugs = kept(own.groupBy("_d").agg(F.collect_set("block").alias("have")), "drugs")
    n, blocks = drugs.count(), -(-m // CELL_BLOCK)
    tasks = max(1, min(n * blocks, -(-n * m // TASK_PAIRS)))
    whole = F.array_except(F.sequence(F.lit(0).cast("long"), F.lit(max(0, blocks - 1)).cast("long")), "have")
    whole = unhurried(drugs.repartition(tasks, "_d").select("_d", F.explode(whole).alias("block")), tasks).join(few(cells), "block").select("_d", F.explode("cell_block").alias("_c"))
    cut = own.where("block is not null").join(few(cells), "block").select("_d", F.explode(F.array_except("cell_block", "own")).alias("_c"))
    return whole.unionByName(cut).toDF(drug, cell)


def without_held_out(train: DataFrame, *held: DataFrame, on: Sequence[str]) -> DataFrame:
    """Training rows whose keys are in no held-out frame."""
    return train.join(reduce(DataFrame.unionByName, (h.select(*on) for h in held)), list(on), "left_anti")


def common_samples(*tables: DataFrame, key: str) -> DataFrame:
    return reduce(DataFrame.intersect, (t.select(key).distinct() for t in tables))


def cell_subset(cells: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Cells in a list (key, pos), with their place; all cells if none is in it."""
    found = cells.join(wanted, key)
    return found if found.limit(1).count() else cells.withColumn("pos", F.lit(None).cast("int"))


def encode_distinct(df: DataFrame, column: str, encode) -> DataFrame:
    """Each distinct value encoded once and joined back; encode makes columns from a frame of distinct values."""
    return df.join(encode(df.select(column).where(F.col(column).isNotNull()).distinct()), column)


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    columns = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*columns), F.col(order)).alias("r")).select(key, "r.*")


def numbered(df: DataFrame, order: Sequence[str], into: str = "row_no") -> DataFrame:
    """Rows numbered from 0 in the order of columns: sorted in ranges, kept as a table, counted by range, offset by the counts before. No task sees all rows."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = kept(ranged.withColumn("_part", F.shiftright("_at", 33)), "numbered")  # ranges are drawn anew by each run, so they are written once
    sizes = ranged.groupBy("_part").count()  # one row for each partition
    offsets = sizes.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(into, F.col("_before") + F.expr("_at - shiftleft(_part, 33)")).drop("_at", "_part", "_before")


def scanned(df: DataFrame, by: Sequence[str], order: Sequence[str], into: str = "row_no", sums: dict[str, Column] | None = None, lows: dict[str, Column] | None = None, total: str = "group_rows") -> DataFrame:
    """Rows with their place in their group, from 0 in the given order, the group's rows, running sums of columns up to and with the row, and least values of columns before it.

    A segmented scan: the rows are sorted in ranges that may cut a group anywhere, even
    between equal rows, and kept as a table; places and sums are taken within a range, and a
    table of one row for each group of each range brings what the ranges before hold. So a
    group with most rows is many tasks' work.
    """
    sums, lows, keys = sums or {}, lows or {}, ["_part", *by]
    sort = [*by, *order, "_tie"]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id())
    ranged = kept(ranged.withColumn("_part", F.shiftright("_at", 33)).drop("_tie"), "scanned")  # ranges are drawn anew by each run, so they are written once
    inside, group = Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*by)
    before, above = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (group.orderBy("_part"), Window.partitionBy(*keys).orderBy("_at")))

    parts = ranged.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.sum(c).alias(f"_sum_{k}") for k, c in sums.items()), *(F.min(c).alias(f"_low_{k}") for k, c in lows.items()))
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    parts = parts.select(*keys, earlier("_n").alias("_before"), F.sum("_n").over(group).alias(total), *(earlier(f"_sum_{k}").alias(f"_sum_{k}") for k in sums), *(F.min(f"_low_{k}").over(before).alias(f"_low_{k}") for k in lows))
    rows = ranged.withColumn("_row", F.row_number().over(inside)).withColumns({k: F.sum(c).over(inside) for k, c in sums.items()} | {k: F.min(c).over(above) for k, c in lows.items()})
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    other = parts.withColumnsRenamed(names)
    rows = rows.join(other, reduce(Column.__and__, (rows[k].eqNullSafe(other[v]) for k, v in names.items())))
    out = {into: F.col("_before") + F.col("_row") - 1} | {k: F.coalesce(k, F.lit(0)) + F.col(f"_sum_{k}") for k in sums} | {k: F.least(F.col(k), F.col(f"_low_{k}")) for k in lows}
    return rows.withColumns(out).select(*df.columns, *out, total)


def shards(df: DataFrame, order: Sequence[str], n: int, into: str = "shard") -> DataFrame:
    """Rows dealt in order to n shards of equal size; the last one takes the rest. Fewer rows than shards: one shard each."""
    rows = numbered(df, order, into)
    size = max(1, df.count() // n)
    return rows.withColumn(into, F.least(F.expr(f"{into} div {size}"), F.lit(n - 1)))


def with_unscored(scored: DataFrame, drugs: DataFrame, cells: DataFrame, keys: Sequence[str], keep: bool = True) -> DataFrame:
    """scored, and if keep is set a row without values for each cell and each drug that has no score at all; keys: names of the drug and cell columns."""
    drug, cell = keys
    if not keep:
        return scored
    left = drugs.select(drug).distinct().join(scored.select(drug).distinct(), drug, "left_anti")
    return scored.unionByName(grid(left, cells.select(cell).distinct()), allowMissingColumns=True)


def positional(df: DataFrame, order: Sequence[str], master: DataFrame, master_order: Sequence[str], ids: str) -> DataFrame:
    """The master's ids by row number."""
    return numbered(df, order).join(numbered(master.select(ids, *[c for c in master_order if c != ids]), master_order).select("row_no", ids), "row_no")


def chunk_plan(n_drugs: int, n_cells: int, budget: int, parallel: int = 1) -> tuple[int, int]:
    """(drugs in a chunk, chunks) for so many pairs at once."""
    size = min(max(budget // parallel // max(1, n_cells), 1), max(1, n_drugs))
    return size, -(-n_drugs // size)


def synonyms(drugs: DataFrame, key: str, name: str, synonym: str) -> DataFrame:
    """(name, drug id): names and their ', ' separated synonyms. Later rows win; primary names of rows with synonyms win over all."""
    has = F.col(synonym).isNotNull()
    every = drugs.select(key, F.lit(0).alias("turn"), F.posexplode(F.when(has, F.concat(F.array(name), F.split(synonym, ", "))).otherwise(F.array(name))).alias("pos", "name"))
    again = drugs.where(has).select(key, F.lit(1).alias("turn"), F.lit(0).alias("pos"), F.col(name).alias("name"))
    return every.unionByName(again).groupBy("name").agg(F.max_by(key, F.struct("turn", key, "pos")).alias(key))
