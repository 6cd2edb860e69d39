"""Removal of repeated passages: every byte in a LENGTH-byte string that also starts in a document with a smaller id.

A periodic difference cover takes two thirds of all suffixes through a shuffle at each
level, several times the text itself. The cover used here is drawn from the content:
of each LENGTH-byte string, the place whose GRAM bytes have the smallest hash. Equal
strings have the same place, so two equal strings always meet at sampled places, as
under a difference cover, but only one place in sixteen is sampled.

1. Each task finds the sampled places of its documents; each stands for a run of
   strings and has a name (the hash of its GRAM bytes) and a context (all bytes of its
   strings). Of equal contexts in a task, all but those of the smallest id are repeats.
2. The others are dealt by name and sorted. Where all contexts of a name are equal, they
   are repeats of the smallest id. Elsewhere the smallest id of each context stays open.
3. Each string of an open place is named by its hash. Equal strings have places of one
   name, so they are dealt by that name once more; the smallest id is kept and the
   others are repeats. The strings of a name with more than SHARE open places are dealt
   to several tasks by their hashes, and of equal strings that one step of a task finds
   only those of the smallest id are dealt so, so a passage in many texts is no hot key.

Names and contexts are 64-bit hashes. Nothing is sampled away or capped. Null texts are
empty. Rows with one id never repeat each other; a null id counts as the largest. Rows
of any kind give one row each; texts shorter than LENGTH lose nothing. Columns of the
input may have any names; those named like a result are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common
from dosegrid.llm.chosen_path import grouped

LENGTH, GRAM = 50, 20
REACH = LENGTH - GRAM + 1  # places of a string
NO_ID = (1 << 63) - 1
#: Places that a task holds before it writes them out: 36 bytes each.
HELD = 1_000_000
#: Buckets for each shuffle partition, and open places of a name that one task takes.
FINER, SHARE = 2, 512
#: Share of strings that are known to be repeats.
DONE = -1
#: Rows of a batch that goes back to Spark.
RECORDS = 50_000
_PLACE = np.dtype([("name", "<u8"), ("context", "<u8"), ("id", "<i8"), ("tag", "<u4"), ("first", "<i4"), ("last", "<i4")])


def sampled_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all rows as records (id is the row, first and last by row), and rows' numbers."""
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, _PLACE), np.zeros(0, np.int64)
    grams = common.span_hashes(data, np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    low = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while width * 2 <= REACH:  # smallest of `width` places from each on
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < REACH:
        low = np.minimum(low[: len(low) - (REACH - width)], low[REACH - width :])
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - LENGTH + 1, 0)  # strings of each row
    row = np.repeat(np.arange(len(sizes)), counts)
    start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[row]
    place = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(row), bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row)) - 1
    out = np.zeros(len(begin), _PLACE)
    first, last, at = start[begin], start[end], place[begin] if len(begin) else begin
    out["name"] = grams[at]
    out["context"] = common.mix(common.span_hashes(data, first, last + LENGTH) + (at - first).astype(np.uint64))
    out["id"] = row[begin]
    out["first"], out["last"] = first - offsets[row[begin]], last - offsets[row[begin]]
    return out, row[begin]


def settle(places: np.ndarray, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """(repeats, others) of places. whole: all places of each name are here; then others are the open ones only."""
    places = places[np.lexsort((places["id"], places["context"], places["name"]))]
    if not len(places):
        return places, places
    name, context, key = places["name"], places["context"], places["id"]
    new = np.ones(len(places), bool)
    new[1:] = (name[1:] != name[:-1]) | (context[1:] != context[:-1])
    group = np.cumsum(new) - 1
    repeat = key > key[np.flatnonzero(new)][group]
    if not whole:
        return places[repeat], places[~repeat]
    lead = np.ones(len(places), bool)
    lead[1:] = name[1:] != name[:-1]
    family = np.cumsum(lead) - 1
    contexts = np.bincount(family, new)
    low = np.minimum.reduceat(key, np.flatnonzero(lead))
    high = np.maximum.reduceat(key, np.flatnonzero(lead))
    is_open = ~repeat & (contexts[family] > 1) & (low < high)[family]
    return places[repeat], places[is_open]


def packed(places: np.ndarray) -> bytes:
    """Places as columns of few bytes: texts as numbers into a table, names cut to 48 bits, ends as lengths."""
    texts, number = np.unique(places[["id", "tag"]], return_inverse=True)
    head = np.array([len(places), len(texts)], "<i8")
    name = places["name"]
    columns = (texts["id"], texts["tag"], number.astype("<u2" if len(texts) <= 1 << 16 else "<u4"), name.astype("<u4"), (name >> np.uint64(32)).astype("<u2"), places["context"], places["first"], (places["last"] - places["first"]).astype("u1"))
    return b"".join([head.tobytes(), *(c.tobytes() for c in columns)])


def unpacked(body: bytes) -> np.ndarray:
    n, k = np.frombuffer(body, "<i8", 2).tolist()
    at = 16

    def take(kind: str, m: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, m, at)
        at += out.nbytes
        return out

    ids, tags = take("<i8", k), take("<u4", k)
    number = take("<u2" if k <= 1 << 16 else "<u4", n)
    out = np.zeros(n, _PLACE)
    out["id"], out["tag"] = ids[number], tags[number]
    low, high = take("<u4", n), take("<u2", n)
    out["name"] = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
    out["context"], out["first"] = take("<u8", n), take("<i4", n)
    out["last"] = out["first"] + take("u1", n)
    return out


def repeats(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_id, _tag, ranges) of all texts with repeats: ranges (first, last) of starts of repeated strings; _id: key, _tag: crc32 of the text."""
    buckets = FINER * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            done, rest = settle(np.concatenate(held), False)
            held.clear()
            rows, bodies, kinds = [], [], []
            for part, kind in ((done, 1), (rest, 0)):
                if not len(part):
                    continue
                where = (part["name"] % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((part["first"], part["tag"], part["id"], where))
                part, where = part[order], where[order]
                found, first = np.unique(where, return_index=True)
                for b, a, z in zip(found.tolist(), first.tolist(), np.append(first[1:], len(where)).tolist(), strict=True):
                    rows.append(b)
                    kinds.append(kind)
                    bodies.append(packed(part[a:z]))
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(kinds, pa.int64()), pa.array(bodies, pa.binary())], names=["bucket", "kind", "body"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, _, data, offsets in common.steps(batch.column(1)):
                places, owner = sampled_places(data, offsets)
                tags = np.array([zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.uint32)
                places["id"], places["tag"] = ids[row + owner], tags[owner]
                places["name"] &= np.uint64((1 << 48) - 1)
                held.append(places)
                if sum(map(len, held)) >= HELD:
                    yield out()
        if held:
            yield out()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kind, bodies in grouped(batches, 1):
            some = lambda want: np.concatenate([np.zeros(0, _PLACE), *(unpacked(b) for b, k in zip(bodies, kind, strict=True) if k == want)])  # noqa: E731, B023
            more, left = settle(some(0), True)
            out = np.concatenate([some(1), more, left])
            state = np.arange(len(out)) >= len(out) - len(left)
            name = pa.array(out["name"].astype(np.int64), mask=~state)
            _, which, count = np.unique(left["name"], return_inverse=True, return_counts=True)
            parts = np.ones(len(out), np.int32)
            parts[state] = (-(-count // SHARE))[which]
            for low in range(0, max(1, len(out)), RECORDS):
                some = slice(low, low + RECORDS)
                yield pa.RecordBatch.from_arrays([pa.array(out["id"][some]), pa.array(out["tag"][some].astype(np.int64)), pa.array(out["first"][some]), pa.array(out["last"][some]), name[some], pa.array(parts[some])], names=["_id", "_tag", "first", "last", "name", "parts"])

    sampled = common.in_arrow(docs, sample, "bucket bigint, kind bigint, body binary")
    found = common.kept(common.in_arrow(sampled.repartition(buckets, "bucket").sortWithinPartitions("bucket"), resolve, "_id bigint, _tag bigint, first int, last int, name bigint, parts int"), "places")
    tagged = docs.withColumn("_tag", F.crc32(F.col("_text").cast("binary")))

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in common.steps(batch.column(2)):
                part = batch.slice(row, end - row)
                spans = part.column(3)
                owner = np.repeat(np.arange(end - row), pc.list_value_length(spans).to_numpy(zero_copy_only=False).astype(np.int64))
                flat = spans.flatten()
                first, last = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                n = last - first + 1
                at = np.repeat(first + offsets[owner], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hashes = common.span_hashes(data, at, at + LENGTH)
                place = np.repeat(np.arange(len(n)), n)
                offset = np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)  # of the string in its place
                share = (hashes % np.repeat(flat.field(3).to_numpy(), n).astype(np.uint64)).astype(np.int32)
                key = part.column(0).to_numpy()[owner[place]]
                by = np.lexsort((key, hashes))
                lead = np.ones(len(by), bool)
                lead[1:] = hashes[by][1:] != hashes[by][:-1]
                least = key[by][np.flatnonzero(lead)][np.cumsum(lead) - 1] if len(by) else key
                share[by[key[by] > least]] = DONE  # repeats of a text of this very step
                order = np.lexsort((offset, share, place))
                place, share = place[order], share[order]
                cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (share[1:] != share[:-1])])) if len(place) else place
                sizes = np.diff(np.append(cut, len(place)))
                which = pa.array(place[cut])
                lists = lambda x: pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes * x.itemsize)]).astype(np.int32)), pa.py_buffer(x)])  # noqa: E731, B023
                rows = pa.array(owner[place[cut]])
                yield pa.RecordBatch.from_arrays([flat.field(2).take(which), pa.array(share[cut]), part.column(0).take(rows), part.column(1).take(rows), flat.field(0).take(which), lists(offset[order].astype(np.uint8)), lists(hashes[order])], names=["name", "share", "_id", "_tag", "first", "offsets", "strings"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, share, ids, tags, first, offsets, bodies in grouped(batches, 1):
            hashes = np.frombuffer(b"".join(bodies), np.uint64)
            n = np.array([len(b) // 8 for b in bodies])
            row = np.repeat(np.arange(len(n)), n)
            start = first.astype(np.int64)[row] + np.frombuffer(b"".join(offsets), np.uint8)
            order = np.lexsort((ids[row], hashes))
            lead = np.ones(len(order), bool)
            lead[1:] = hashes[order][1:] != hashes[order][:-1]
            low = ids[row[order]][np.flatnonzero(lead)][np.cumsum(lead) - 1]
            again = np.sort(order[(ids[row[order]] > low) | (share[row[order]] == DONE)])
            row, start = row[again], start[again]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(row)) - 1
            yield pa.RecordBatch.from_arrays([pa.array(ids[row[begin]]), pa.array(tags[row[begin]]), pa.array(start[begin].astype(np.int32)), pa.array(start[end].astype(np.int32))] if len(begin) else [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())], names=["_id", "_tag", "first", "last"])

    pending = found.where("name is not null").groupBy("_id", "_tag").agg(F.sort_array(F.collect_list(F.struct("first", "last", "name", "parts"))).alias("ranges"))
    strings = common.in_arrow(tagged.join(pending.hint("merge"), ["_id", "_tag"]).select("_id", "_tag", "_text", "ranges"), names, "name bigint, share int, _id bigint, _tag bigint, first int, offsets binary, strings binary")
    by = F.when(F.col("share") == DONE, F.xxhash64("_id", "first")).otherwise(F.xxhash64("name", "share"))
    dealt = strings.select(F.pmod(by, F.lit(buckets)).alias("bucket"), "name", "share", "_id", "_tag", "first", "offsets", "strings").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    more = common.kept(common.in_arrow(dealt, compare, "_id bigint, _tag bigint, first int, last int"), "strings")
    return found.where("name is null").select("_id", "_tag", "first", "last").union(more).groupBy("_id", "_tag").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


def without_repeats(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """df with kept_bytes (the text's bytes without the repeated ones), n_bytes, n_removed and n_spans."""
    new = ("kept_bytes", "n_bytes", "n_removed", "n_spans")
    df = df.drop(*new)
    others = df.columns
    place = others.index(text)
    by_id, tag, found = (common.fresh(df, n) for n in ("_id", "_tag", "_ranges"))
    keyed = df.withColumns({by_id: F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)), tag: F.crc32(F.coalesce(text, F.lit("")).cast("binary"))})
    ranges = repeats(df, text, key).toDF(by_id, tag, found)
    joined = keyed.join(ranges.hint("merge"), [by_id, tag], "left").select(*(f"`{c}`" for c in others), found)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, counts = [], []
            data, offsets = common.text_buffer(batch.column(place))
            spans = batch.column(batch.num_columns - 1)
            for k in range(batch.num_rows):
                body = data[offsets[k] : offsets[k + 1]]
                removed = runs = 0
                if spans[k].is_valid:
                    flat = spans[k].values
                    step = np.zeros(len(body) + 1, np.int64)
                    np.add.at(step, flat.field(0).to_numpy(), 1)
                    np.add.at(step, flat.field(1).to_numpy() + LENGTH, -1)
                    gone = np.cumsum(step[:-1]) > 0
                    removed, runs = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    body = body[~gone]
                bodies.append(body.tobytes())
                counts.append((int(offsets[k + 1] - offsets[k]), removed, runs))
            numbers = np.array(counts, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bodies, pa.binary()), *map(pa.array, numbers)], names=[*others, *new])

    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return common.in_arrow(joined, cut, f"{schema}, kept_bytes binary, n_bytes bigint, n_removed bigint, n_spans bigint")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = without_repeats(common.documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))
