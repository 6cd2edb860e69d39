"""Shared parts: input tables, tables kept in the shared folder, vectorised text scans."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.sources.shared import noted

#: ASCII white space, the only separators of words here.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.isin(np.arange(256), list(SPACES))
#: Bytes of text that one vectorised step handles at most (a longer text is a step of its own), and bytes that are hashed together.
STEP_BYTES = HASH_BYTES = 1 << 18
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows and bytes of the batches that go to Python: whole texts, so few of them.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
#: A group with a larger share of the rows than one in so many is hot.
HOT_SHARE = 512
_own_folder: list[str] = []


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only where that is unset and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own_folder:
            _own_folder.append(tempfile.mkdtemp(prefix="dosegrid-"))
        found = _own_folder[0]
    return found.rstrip("/")


def kept(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write df as a table in the shared folder, or a folder of it, and read it back: lineage ends here, and lost executors lose nothing. Without a folder it stays until `shared.clear`."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if folder is None:
        noted(path)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")  # shuffle files go as soon as the table is there
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """A folder in the shared one for tables that a job needs while it runs. It goes when the job is over."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.path)

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        return kept(df, name, self.path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, through Spark's file systems."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name in df.columns:
        name += "_"
    return name


def released(tokenizers: bool = False) -> None:
    """Give memory that a task has freed back to the system, for Spark uses its workers again. Tokenizers go too, unless the task has used them."""
    if not tokenizers and (loaded := sys.modules.get("dosegrid.llm.tokens")):
        loaded.byte_bpe.cache_clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def memory_kept() -> None:
    """Let the process keep up to 256 MiB that it frees, for a task that takes and frees the same arrays in each step: pages that go back to the system are cleared when they come again. `released` still gives all back."""
    if mallopt := getattr(ctypes.CDLL(None), "mallopt", None):
        mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
        mallopt(-1, 256 << 20)  # M_TRIM_THRESHOLD


def in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, tokenizers: bool = False) -> DataFrame:
    """df.mapInArrow in batches of bounded size, by workers that keep no memory. tokenizers: whether work uses them."""
    for k, v in BATCHES.items():
        df.sparkSession.conf.set(k, v)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            released(tokenizers)

    return df.mapInArrow(task, schema)


def joined_to_groups(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """Rows with the columns of their group; groups has one row for each key, null too, and in count the number of rows with it.

    Groups of more than 1 / HOT_SHARE of all rows are broadcast, for there cannot be more
    than HOT_SHARE of them; the others have so few rows each that a shuffle deals them well.
    Both tables are read twice, so they should be kept ones.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    named = groups.withColumnRenamed(key, "_group").drop(count)
    hot = groups.where(F.col(count) * HOT_SHARE > total).select(F.col(key).alias("_group"))
    same = F.col(key).eqNullSafe(F.col("_group"))
    is_hot = F.broadcast(hot)
    light = rows.join(is_hot, same, "left_anti").join(named, same)
    heavy = rows.join(F.broadcast(groups.where(F.col(count) * HOT_SHARE > total).withColumnRenamed(key, "_group").drop(count)), same)
    return heavy.unionByName(light).drop("_group")


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; null keys count as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def crc_mod_py(key: int | None, n: int) -> int:
    return zlib.crc32(b"" if key is None else str(key).encode()) % n


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array end to end, and each row's offset (one more than rows); nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n, at = len(column), column.offset
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1 + at)[at:]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string array into runs of rows of about `most` bytes: (first row, end row, bytes, offsets)."""
    data, offsets = text_buffer(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words of each row. Words never cross rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    word = ~IS_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = word[cut]
    last[cut - 1] = word[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNDO = np.uint64(pow(int(_RADIX), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_RADIX, _UNDO)):
            grown = np.full(max(n, HASH_BYTES + 1), base, np.uint64)
            grown[0] = 1
            np.multiply.accumulate(grown, out=grown)
            _powers[k] = grown
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (spans by rising starts and ends), from a running polynomial sum over HASH_BYTES at a time, or over one span."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        end = max(at + 1, int(np.searchsorted(ends, low + HASH_BYTES, "right")))
        high = int(ends[end - 1])
        power, undo = _power(high - low + 1)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=total[1:])
        out[at:end] = mix((total[ends[at:end] - low] - total[starts[at:end] - low]) * undo[starts[at:end] - low])
        at = end
    return out


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every k consecutive words of each row, and how many each row has. A row of 1 to k-1 words gives one shingle of all its words."""
    n = len(words)
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    place = np.arange(n) - np.repeat(ends - counts, counts)
    left = np.repeat(counts, counts) - place
    rolled = np.zeros(n, np.uint64)
    for j in range(k):
        part = np.zeros(n, np.uint64)
        if j < n:
            part[: n - j] = words[j:]
        part *= np.uint64((2 * j + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)
        rolled += np.where(left > j, mix(part + np.uint64(j)), np.uint64(0))
    keep = (left >= k) | (place == 0)
    return mix(rolled[keep]), np.bincount(owner[keep], minlength=len(counts))
