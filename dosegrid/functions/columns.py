"""Column functions: names, keys, encodings, rescaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")


def number(c: Column) -> Column:
    """Double; bad text, NaN and nulls are null."""
    d = c.try_cast("double")
    return F.when(~F.isnan(d), d)


def rounded(c: Column, digits: int = 6) -> Column:
    """A double to so many digits, halves away from zero; what rounds to zero keeps its sign, as in SQL engines that round in binary."""
    found = F.round(c, digits)
    return F.when(found == 0, c * 0.0).otherwise(found)


def clean_compact(c: Column) -> Column:
    """Lower case, letters a-z and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def clean_brackets(c: Column) -> Column:
    """Without anything from the first to the last bracket, stripped, lower case."""
    return F.lower(strip(F.regexp_replace(c, r"\(.*\)", "")))


def clean_plain(c: Column) -> Column:
    return F.lower(strip(c))


def base_names(c: Column) -> Column:
    """Genes of a composite feature name: suffix dropped, lower case, split at dashes."""
    return F.split(F.lower(F.regexp_replace(c, "_(mut|cnv|fusion)$", "")), "-")


def corrected(c: Column, corrections: dict[str, str]) -> Column:
    """Literal corrections; other names stay."""
    table = F.create_map(*(F.lit(x) for pair in corrections.items() for x in pair))
    return F.coalesce(F.try_element_at(table, c), c) if corrections else c


def unsquash(p: Column, epsilon: float = 1e-9) -> Column:
    """Inverse of a logistic squash, clipped by epsilon; null stays null."""
    y = F.least(F.greatest(p, F.lit(epsilon)), F.lit(1 - epsilon))
    return F.when(p.isNotNull(), -10 * F.log((1 - y) / y))


def denormalise(p: Column, low: Column, high: Column) -> Column:
    """Inverse min-max; p itself if the bounds are missing or closer than 1e-7."""
    return F.when((high - low) >= 1e-7, p * (high - low) + low).otherwise(p)


def finite(p: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(~F.isnan(p) & (F.abs(p) != float("inf")), p)


def standardised(x: Column, mean: Column, std: Column) -> Column:
    std = F.coalesce(std, F.lit(1.0))
    return (x - F.coalesce(mean, F.lit(0.0))) / F.when(F.abs(std) < 1e-7, 1e-7).otherwise(std)


def min_max(x: Column, low: Column, high: Column) -> Column:
    low, high = F.coalesce(low, F.lit(0.0)), F.coalesce(high, F.lit(1.0))
    return (x - low) / F.when(high - low < 1e-7, 1e-7).otherwise(high - low)


def clipped_scale(x: Column, low: Column, top: float = 12.0) -> Column:
    """(x - low) / (top - low) with x cut to top, in [0, 1]; zeros if the range is empty."""
    scaled = (F.least(x, F.lit(top)) - low) / F.nullif(F.lit(top) - low, F.lit(0.0))
    return F.when(x.isNotNull(), F.when(F.lit(top) == low, 0.0).otherwise(F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))))


def row_normalised(v: Column) -> Column:
    """A vector divided by its sum, unless that is zero."""
    total = F.aggregate(v, F.lit(0.0), lambda a, b: a + b)
    return F.when(total == 0, v).otherwise(F.transform(v, lambda x: x / F.nullif(total, F.lit(0.0))))


def one_hot(x: Column, allowed: Sequence, unknown: str = "last") -> Column:
    """0/1 floats over allowed values. unknown: 'last' puts other values there, 'error' raises, 'clamp' moves numbers to the range's ends."""
    values = F.array(*map(F.lit, allowed))
    if unknown == "clamp":
        y = F.least(F.greatest(x, F.lit(min(allowed))), F.lit(max(allowed)))
    else:
        other = F.lit(allowed[-1]) if unknown == "last" else F.raise_error(F.concat(F.lit("value not allowed: "), x.cast("string")))
        y = F.when(F.array_contains(values, x), x).otherwise(other)
    return F.transform(values, lambda v: (v == y).cast("float"))


def padded(ids: Column, width: int, start: int | None = None, stop: int | None = None, before: bool = False) -> Column:
    """Ids with zeros after (or before) them, cut to width; a sequence with an unknown (null) id becomes one zero. start and stop: ids that are put around the sequence first, and that a cut may take."""
    known = F.when(F.exists(ids, lambda x: x.isNull()), F.array(F.lit(0))).otherwise(ids)
    ends = [F.array(F.lit(x).cast("int")) if x is not None else F.array().cast("array<int>") for x in (start, stop)]
    whole = F.slice(F.concat(ends[0], known, ends[1]), 1, width)
    zeros = F.array_repeat(F.lit(0), F.lit(width) - F.size(whole))
    return F.concat(zeros, whole) if before else F.concat(whole, zeros)


def pad_mask(ids: Column, width: int, ends: int = 0) -> Column:
    """Ones for the ids of `padded`, with so many start and stop ids."""
    known = F.when(F.exists(ids, lambda x: x.isNull()), F.lit(1)).otherwise(F.size(ids)) + ends
    return F.transform(F.sequence(F.lit(1), F.lit(width)), lambda k: (k <= known).cast("int"))


def split_order(key: Column, seed: str) -> Column:
    """A text that orders keys at random, alike on every engine and partitioning."""
    return F.md5(F.concat_ws("|", F.lit(seed), key.cast("string")).cast("binary"))
