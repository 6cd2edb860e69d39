"""Reproducible splits: rows are ordered by a hash of a seed and their key, so that any engine and partitioning gives the same split."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosegrid.functions.columns import split_order
from dosegrid.operators.pairs import numbered
from dosegrid.sources.shared import kept

#: Rows of one hash prefix that are looked at one by one.
FEW = 1000


def _keys(df: DataFrame, order: Column, key: Column, *others: str) -> DataFrame:
    """(o, k, others): the order and the key's text of all rows, kept, since a cut reads them several times."""
    return kept(df.select(order.alias("o"), key.cast("string").alias("k"), *others), "split_keys")


def _cut(keys: DataFrame, order: Column, key: Column, k: int) -> Column:
    """Whether a row is among the first k by (order, key) of the keys (o, k). The cut is found from counts by hash prefix, of which there are 65,536 at a time, and then within one prefix."""
    if k <= 0:
        return F.lit(False)
    prefix, before, n = "", 0, None
    while n is None or n > FEW and len(prefix) < 32:
        counts = keys.where(F.col("o").startswith(prefix)).groupBy(F.substring("o", 1, len(prefix) + 4).alias("p")).count().orderBy("p").collect()
        for r in counts:
            if before + r["count"] >= k:
                prefix, n = r["p"], r["count"]
                break
            before += r["count"]
        else:
            return F.lit(True)
    last = keys.where(F.col("o").startswith(prefix)).orderBy("o", "k").limit(k - before).collect()[-1]
    return (order < last["o"]) | ((order == last["o"]) & (key.cast("string") <= last["k"]))


def random_split(df: DataFrame, key: str, ratio: float, seed: str) -> DataFrame:
    """Column split: 'test' for ceil(ratio x n) rows, else 'train'; key is unique."""
    order = split_order(F.col(key), seed)
    keys = _keys(df, order, F.col(key))
    return df.withColumn("split", F.when(_cut(keys, order, F.col(key), math.ceil(round(ratio * keys.count(), 9))), "test").otherwise("train"))


def split_by_key(df: DataFrame, column: str, ratio: float, seed: str) -> DataFrame:
    """All rows of a value of the column go to one side."""
    keys = random_split(df.select(column).distinct(), column, ratio, seed)
    return df.join(keys, column)


def three_way(df: DataFrame, column: str, seed: str) -> DataFrame:
    """80/10/10 by distinct values of the column."""
    keys = df.select(column).distinct()
    held = random_split(keys, column, 0.2, seed).withColumnRenamed("split", "first")
    rest = random_split(held.where("first = 'test'").select(column), column, 0.5, f"{seed}-2")
    named = held.join(rest, column, "left").select(column, F.when(F.col("first") == "train", "train").when(F.col("split") == "test", "test").otherwise("validation").alias("split"))
    return df.join(named, column)


def leave_out(df: DataFrame, column: str, folds: int = 5) -> DataFrame:
    """Fold of each row by its value's place among the sorted distinct values: fold f holds places int(n/folds*f) up to the next fold's."""
    place = numbered(df.select(column).distinct(), [column], "place")
    n = place.count()
    bounds = [int(n / folds * f) for f in range(folds)]
    fold = sum(((F.col("place") >= b).cast("int") for b in bounds[1:]), F.lit(0))
    return df.join(place.select(column, fold.alias("fold")), column)


def stratified(df: DataFrame, key: str, label: str, ratio: float, seed: str) -> DataFrame:
    """A random split in each class; classes are few, each is cut by its own hash bound."""
    order, split = split_order(F.col(key), seed), F.lit("train")
    keys = _keys(df, order, F.col(key), label)
    for value, n in {r[label]: r["count"] for r in keys.groupBy(label).count().collect()}.items():
        mine = F.col(label).eqNullSafe(F.lit(value))
        split = F.when(mine & _cut(keys.where(mine), order, F.col(key), math.ceil(round(ratio * n, 9))), "test").otherwise(split)
    return df.withColumn("split", split)


def balanced(df: DataFrame, key: str, label: str, ratio: float, seed: str) -> DataFrame:
    """Classes 0 and 1 cut down to the smaller one's size, then split in each class; empty if a class is."""
    order = split_order(F.col(key), f"{seed}-balance")
    keys = _keys(df.where(F.col(label).isin(0, 1)), order, F.col(key), label)
    counts = {r[label]: r["count"] for r in keys.groupBy(label).count().collect()}
    least = min(counts.get(0, 0), counts.get(1, 0))
    chosen = F.lit(False)
    for value in (0, 1):
        mine = F.col(label) == value
        chosen = chosen | (mine & _cut(keys.where(mine), order, F.col(key), least))
    return stratified(df.where(chosen), key, label, ratio, seed)
