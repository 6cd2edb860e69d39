"""Media columns: texts and other payloads as lossless WebP, read back as pixel arrays.

A payload is a text's UTF-8 with bytes 0 up to a positive multiple of 64. Four bytes
are a pixel's alpha, red, green and blue samples, WIDTH of which are a row. A payload
is one file, up to the format's limit of 16,384 rows, which is 1 MiB; the files of a
longer one stand end to end in the column. Equal texts give equal bytes.

Null texts count as empty. Rows pass through one by one: repeated rows repeat, and
other columns stay; a column named like a new one is replaced. Null media give
null pixels. Bytes that are no lossless WebP raise an error.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dosegrid.llm import common, webp

WIDTH, ROWS = 16, 16_384
ROW_BYTES = 4 * WIDTH
#: Payload bytes that are coded together, and stored bytes that are read together: some 200 MB of memory at most.
CODED, READ = 1 << 20, 8 << 20
PIXELS = T.ArrayType(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("argb", T.BinaryType())]))
FEATURES = [("payload_bytes", T.LongType()), ("payload_sha256", T.StringType()), ("tail_crc32", T.LongType()), ("media_bytes", T.LongType()), ("media_sha256", T.StringType()), ("feature", T.StringType())]


def store_text(df: DataFrame, text: str = "text", into: str = "media") -> DataFrame:
    """df with the stored form of each text, and its unpadded size as <into>_text_bytes."""
    size = f"{into}_text_bytes"
    df = df.drop(into, size)
    place = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.BinaryType()), T.StructField(size, T.LongType())])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media, sizes = [], []
            for _, _, data, offsets in common.steps(batch.column(place), CODED):
                images, owner = [], []
                for k in range(len(offsets) - 1):
                    body = data[offsets[k] : offsets[k + 1]]
                    sizes.append(len(body))
                    padded = np.zeros(max(ROW_BYTES, -(-len(body) // ROW_BYTES) * ROW_BYTES), np.uint8)
                    padded[: len(body)] = body
                    pixels = padded.view(">u4").astype(np.uint32)
                    parts = [pixels[at : at + WIDTH * ROWS] for at in range(0, len(pixels), WIDTH * ROWS)]
                    images += parts
                    owner.append(len(parts))
                files = iter(webp.write(images, WIDTH))
                media += [b"".join(next(files) for _ in range(n)) for n in owner]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(media, pa.binary()), pa.array(sizes, pa.int64())], names=[*batch.schema.names, into, size])

    return common.in_arrow(df, store, schema)


def _runs(media: list[bytes | None]) -> Iterator[tuple[int, int, list[list[np.ndarray] | None]]]:
    """Pixels of the images of each row, for rows with some READ bytes of files at a time."""
    row = 0
    while row < len(media):
        end, held, files, owner = row, 0, [], []
        while end < len(media) and (end == row or held + len(media[end] or b"") <= READ):
            parts = webp.split_files(media[end]) if media[end] is not None else []
            held += len(media[end] or b"")
            files += parts
            owner.append(None if media[end] is None else len(parts))
            end += 1
        images = iter(webp.read_many(files))
        yield row, end, [None if n is None else [next(images) for _ in range(n)] for n in owner]
        row = end


def pixel_arrays(df: DataFrame, media: str = "media", into: str = "pixels") -> DataFrame:
    """df with an array of (width, height, argb) for the WebP files in a binary column; argb: big-endian 0xAARRGGBB by rows."""
    df = df.drop(into)
    place = df.columns.index(media)
    kind = pa.list_(pa.struct([("width", pa.int32()), ("height", pa.int32()), ("argb", pa.binary())]))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for _, _, rows in _runs(batch.column(place).to_pylist()):
                out += [None if row is None else [{"width": p.shape[1], "height": p.shape[0], "argb": p.astype(">u4").tobytes()} for p in row] for row in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, into])

    return common.in_arrow(df, decode, T.StructType([*df.schema.fields, T.StructField(into, PIXELS)]))


def feature(samples: np.ndarray) -> str:
    """Rows, mean, deviation, mean step between neighbours in a row, and entropy in bits, of 8-bit samples."""
    counts = np.bincount(samples, minlength=256)
    share = counts[counts > 0] / len(samples)
    values = np.arange(256)
    mean = (counts * values).sum() / len(samples)
    deviation = np.sqrt(max(0.0, (counts * (values - mean) ** 2).sum() / len(samples)))
    step = np.abs(np.diff(samples.reshape(-1, ROW_BYTES).astype(np.int16), axis=1)).mean()
    return f"{len(samples) // ROW_BYTES}:{mean:.6f}:{deviation:.6f}:{step:.6f}:{-(share * np.log2(share)).sum() + 0.0:.6f}"


def _together(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """Batches put together as long as their files are read side by side."""
    held: list[pa.RecordBatch] = []
    n = size = 0
    for batch in batches:
        if held and (n + batch.num_rows > webp.ABREAST or size + batch.column(place).nbytes > READ):
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n, size = [], 0, 0
        held.append(batch)
        n, size = n + batch.num_rows, size + batch.column(place).nbytes
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def read_features(df: DataFrame, media: str = "media") -> DataFrame:
    """The media column replaced by digests of the payload read back from it, and features of its pixels."""
    rest = df.drop(media, *(n for n, _ in FEATURES))
    kept_names = rest.columns
    place, others = df.columns.index(media), [df.columns.index(c) for c in kept_names]
    schema = T.StructType([*rest.schema.fields, *(T.StructField(n, t) for n, t in FEATURES)])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches, place):
            stored = batch.column(place).to_pylist()
            out: list[list] = [[] for _ in FEATURES]
            for first, _, rows in _runs(stored):
                for k, images in enumerate(rows):
                    if images is None:
                        values = [None] * len(FEATURES)
                    else:
                        samples = np.concatenate([p.astype(">u4").ravel().view(np.uint8) for p in images])
                        body, file = samples.tobytes(), stored[first + k]
                        values = [len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]), len(file), hashlib.sha256(file).hexdigest(), feature(samples)]
                    for column, v in zip(out, values, strict=True):
                        column.append(v)
            arrays = [pa.array(x, pa.int64() if isinstance(t, T.LongType) else pa.string()) for x, (_, t) in zip(out, FEATURES, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), *arrays], names=[*kept_names, *(n for n, _ in FEATURES)])

    return common.in_arrow(df, look, schema)


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = store_text(common.documents(spark, sf_dir).select("doc_id", "text")).drop("text")
    return read_features(stored.withColumnRenamed("media_text_bytes", "n_bytes"))
