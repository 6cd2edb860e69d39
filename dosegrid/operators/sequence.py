"""Tokens of SMILES-like strings: tokenising, sub-word merges, windows, mean vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bracket atoms, two-letter atoms, two-digit rings, single characters.
TOKEN = r"\[[^\]]+\]|Br|Cl|%\d\d|."


def tokenised(text: Column, pattern: str = TOKEN) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def token_ids(tokens: Column, vocabulary: dict[str, int]) -> Column:
    """Ids by a vocabulary; unknown tokens are null."""
    table = F.create_map(*(F.lit(x) for pair in vocabulary.items() for x in pair))
    return F.transform(tokens, lambda t: F.try_element_at(table, t))


def token_counts(df: DataFrame, tokens: str) -> DataFrame:
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def fingerprint(ids: Column) -> Column:
    """Sorted distinct known ids."""
    return F.array_sort(F.array_distinct(F.filter(ids, lambda x: x.isNotNull())))


def merged(word: Column, merges: Sequence[tuple[str, str]], end: str = "</w>") -> Column:
    """A word's parts after all merges, lowest rank first, every place of a pair at once: a fold that takes the best pair left in each step."""
    found: dict[str, int] = {}
    for rank, pair in enumerate(merges):
        found.setdefault("\x00".join(pair), rank)
    ranks = F.create_map(*(F.lit(x) for pair in found.items() for x in pair)) if found else None
    n = F.length(word)
    letters = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(word, i, F.lit(1)), F.when(i == n, end).otherwise("")))
    letters = F.when(n > 0, letters).otherwise(F.array().cast("array<string>"))
    if ranks is None:
        return letters
    pairs = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in merges))

    def joined(parts: Column, pair: Column) -> Column:
        def put(done: Column, x: Column) -> Column:
            hit = F.coalesce((F.try_element_at(done, F.lit(-1)) == pair["a"]) & (x == pair["b"]), F.lit(False))
            return F.when(hit, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.concat(pair["a"], pair["b"])))).otherwise(F.concat(done, F.array(x)))

        return F.aggregate(parts, F.array().cast("array<string>"), put)

    def step(parts: Column, _: Column) -> Column:
        known = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x, i: F.try_element_at(ranks, F.concat(F.get(parts, i), F.lit("\x00"), x)))
        return F.transform(F.array(F.array_min(known)), lambda best: F.when(best.isNull(), parts).otherwise(joined(parts, F.get(pairs, best))))[0]

    # a word of n letters has at most n - 1 merges
    return F.aggregate(F.slice(letters, 2, F.greatest(n - 1, F.lit(0))), letters, step)


def subword_encoded(df: DataFrame, column: str, merges: Sequence[tuple[str, str]], into: str = "parts") -> DataFrame:
    """Each distinct string's sub-words, joined back; the merge list is of fixed size."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return df.join(distinct.withColumn(into, merged(F.col(column), merges)), column, "left")


def lingos(text: Column, width: int = 8, elements: Sequence[str] = (), letters: str = "") -> Column:
    """Windows of a string in which an element of several letters counts as one, with the elements written out again.

    A string shorter than width is padded first. The elements that it has get the letters
    in order, as far as these go. If it is shorter than width then, it is one window.
    Null and empty strings are padding only.
    """
    full = F.rpad(F.coalesce(text, F.lit("")), F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(width)), F.lit("_"))
    known = [e for e in elements if e]
    none = F.array().cast("array<struct<element:string,letter:string>>")
    start = F.struct(full.alias("text"), none.alias("used"))

    def replaced(at: Column, element: Column) -> Column:
        letter = F.substring(F.lit(letters), F.size(at["used"]) + 1, F.lit(1))
        hit = at["text"].contains(element) & (F.size(at["used"]) < len(letters))
        new = F.struct(F.replace(at["text"], element, letter).alias("text"), F.concat(at["used"], F.array(F.struct(element.alias("element"), letter.alias("letter")))).alias("used"))
        return F.when(hit, new).otherwise(at)

    def written_out(window: Column, used: Column) -> Column:
        return F.aggregate(used, window, lambda w, u: F.replace(w, u["letter"], u["element"]))

    def cut(at: Column) -> Column:
        n = F.length(at["text"])
        parts = F.when(n >= width, F.transform(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), lambda i: F.substring(at["text"], i + 1, F.lit(width)))).otherwise(F.array(at["text"]))
        return F.transform(parts, lambda w: written_out(w, at["used"]))

    done = F.aggregate(F.array(*map(F.lit, known)), start, replaced) if known else start
    return F.get(F.transform(F.array(done), cut), F.lit(0))


def lingo_mean(df: DataFrame, key: str, parts: str, vectors: DataFrame, dim: int) -> DataFrame:
    """(key, vec): sum of the parts' vectors over the number of all parts; parts without a vector count as zeros."""
    rows = df.select(key, F.size(parts).alias("total"), F.explode(parts).alias("key_"))
    known = rows.join(vectors.withColumnRenamed("key", "key_"), "key_").select(key, "total", F.posexplode("vec").alias("d", "x"))
    sums = known.groupBy(key, "total", "d").agg(F.sum("x").alias("x"))
    means = sums.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", (F.col("x") / F.col("total")).alias("x")))), lambda s: s["x"]).alias("vec"))
    return df.select(key).distinct().join(means, key, "left").withColumn("vec", F.coalesce("vec", F.array_repeat(F.lit(0.0), dim)))
