"""Packing of documents into sequences by minimum bin slack.

Each document's ids, with its end id, are cut into full windows and a rest; the
rests are packed by lengths only. A window starts with the longest length that
is left and is filled by a subset-sum search over the multiset of remaining
lengths: a bitset says which fills can be reached after each length, the fill
nearest to capacity is taken and traced back to counts of lengths. The same
counts are used again for as many windows as the remaining lengths allow, so the
work follows the number of distinct lengths, not the number of windows.

Every task packs what it has encoded, so texts and ids are never shuffled. A window
that would stay more than a sixteenth empty is filled with the front of another
piece. So only the last window of a task's load can be emptier than that; those
are packed again, without cuts, in groups of GROUP tasks.

Null and empty texts have their end id only. Repeated rows and repeated or null
ids are packed as rows of their own. Other columns are dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common, tokens

WINDOW, END_ID = 2048, 1
#: Ids that a task holds before it packs them: 4 bytes each.
HELD = 4_000_000
#: Tasks whose unfilled windows are packed together.
GROUP = 256
PIECE = "doc_id {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def fill(counts: np.ndarray, room: int) -> dict[int, int]:
    """Counts of lengths whose total comes closest to room from below; counts[l] of length l are left."""
    reach, trail = 1, []
    goal = 1 << room
    whole = (goal << 1) - 1
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, take = int(counts[length]), 1
        left = min(left, room // length)
        while left and not reach & goal:  # 1, 2, 4, ... of it at once
            take = min(take, left)
            grown = (reach | reach << take * length) & whole
            if grown != reach:
                trail.append((length, take, reach))
            reach, left, take = grown, left - take, take * 2
        if reach & goal:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(trail):
        if not before >> at & 1:
            at -= take * length
            used[length] = used.get(length, 0) + take
    return used


def place(lengths: np.ndarray, window: int = WINDOW, slack: int | None = None) -> np.ndarray:
    """Rows of (piece, start in the piece, length, sequence from 0, offset).

    slack: a window whose best filling leaves more room than this is filled with
    the front of the longest piece that is left; None: pieces are not cut here.
    """
    counts = np.bincount(lengths, minlength=window + 1)
    stacks: dict[int, list[tuple[int, int]]] = {}
    for piece, length in enumerate(lengths.tolist()):
        stacks.setdefault(length, []).append((piece, 0))
    out, number = [], 0
    while (rest := np.flatnonzero(counts)).size:
        longest = int(rest[-1])
        counts[longest] -= 1
        used = fill(counts, window - longest)
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        need, room, cut = dict(used), window - sum(length * n for length, n in used.items()), 0
        if slack is not None and room > slack:
            for length, n in used.items():
                counts[length] -= n
            if (left := np.flatnonzero(counts)).size:  # all are longer than the room, or they would be in
                cut = int(left[-1])
                need[cut] = need.get(cut, 0) + 1
            for length, n in used.items():
                counts[length] += n
        times = min(int(counts[length]) // n for length, n in need.items())
        for length, n in need.items():
            counts[length] -= n * times
        for _ in range(times):
            at = 0
            for length, n in used.items():
                for _ in range(n):
                    out.append((*stacks[length].pop(), length, number, at))
                    at += length
            if cut:
                piece, start = stacks[cut].pop()
                out.append((piece, start, room, number, at))
                stacks.setdefault(cut - room, []).append((piece, start + room))
                counts[cut - room] += 1
            number += 1
    return np.array(out, np.int64).reshape(-1, 5)


def pack(df: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """A row for each piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset. `tokenizer` is the vocabulary file's path."""
    key_type = df.schema[key].dataType.simpleString()
    schema = PIECE.format(key=key_type)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = tokens.byte_bpe(tokenizer), TaskContext.get().partitionId()
        keys: list = []
        held: list[np.ndarray] = []
        first = ids_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, held, first, ids_held
            pieces = [(doc, at, min(window, len(ids) - at)) for doc, ids in enumerate(held) for at in range(0, len(ids), window)]
            placed = place(np.array([x[2] for x in pieces]), window, window // 16)
            doc, start = np.array([x[:2] for x in pieces]).T[:, placed[:, 0]]
            start = start + placed[:, 1]
            length = placed[:, 2]
            crc = [zlib.crc32(held[d][s : s + n].tobytes()) for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)]
            total = np.array([len(x) for x in held])[doc]
            sequence = placed[:, 3] + (task << 40) + first
            first += int(placed[:, 3].max()) + 1
            out = pa.RecordBatch.from_arrays([pa.array(keys, key_arrow).take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total, sequence, placed[:, 4]))], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
            keys, held, ids_held = [], [], 0
            return out

        key_arrow = None
        for batch in batches:
            key_arrow = batch.column(0).type
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys.append(k)
                held.append(np.append(bpe.ids(t or ""), np.uint32(END_ID)).astype("<u4"))
                ids_held += len(held[-1])
                if ids_held >= HELD:
                    yield flush()
        if held:
            yield flush()

    packed = common.kept(common.in_arrow(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), encode, schema, tokenizers=True), "packed")
    short = packed.groupBy("sequence_id").agg(F.sum("length").alias("filled")).where(F.col("filled") < window - window // 16).select("sequence_id")

    def again(group: tuple, rest: pd.DataFrame) -> pd.DataFrame:
        rest = rest.sort_values(["sequence_id", "offset"], kind="stable").drop(columns="task_group")
        placed = place(rest["length"].to_numpy(), window)
        return rest.iloc[placed[:, 0]].assign(sequence_id=-1 - (int(group[0]) << 40) - placed[:, 3], offset=placed[:, 4])

    rest = packed.join(short, "sequence_id", "left_semi").select(*packed.columns, F.expr(f"shiftright(sequence_id, 40) div {GROUP}").alias("task_group"))
    whole = packed.join(short, "sequence_id", "left_anti").select(packed.columns)
    return whole.unionByName(rest.groupBy("task_group").applyInPandas(again, schema).select(packed.columns))


def op5_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir), tokens.default_path())
