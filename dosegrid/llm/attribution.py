"""Token counts of the fields or sections of a text, from one encoding of the whole text.

Each token has a span of bytes, hence of code points: it covers every code point of
which it holds a byte. Token spans are joined with section spans by order of their
bounds, and a token that crosses a bound is allocated by an explicit rule:

first  to the section with its first code point (the default),
last   to the section with its last code point,
split  to all sections it touches, in proportion to its bytes there.

So over sections that tile the text, counts add up to the count of the whole text.
Sections may also overlap or leave gaps; ends are exclusive, and bounds are cut to
the text. Null texts are empty, null lists of sections have no rows. Repeated rows
and ids are rows of their own; a section with a null bound has null counts. Other
columns are dropped; a key named like a column of the result is returned as <key>_key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosegrid.llm import common, tokens

RULES = ("first", "last", "split")
COLUMNS = ("section", "name", "start", "end", "n_tokens", "n_crossing", "doc_tokens")
SECTION = "array<struct<name:string,start:bigint,end:bigint>>"


def line_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sections that tile a text: its lines with their line ends. Start and end in code points; an empty text is one empty section."""
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    ends = np.append(points[np.flatnonzero(raw == 10) + 1], points[-1])
    return np.append(0, ends[:-1]), ends


def cumulative(ends: np.ndarray, rule: str, at: np.ndarray, of_byte: np.ndarray) -> np.ndarray:
    """Tokens allocated to the text before each code point bound `at`. ends: end byte of each token; of_byte: first byte of each code point, and the end."""
    byte = of_byte[np.clip(at, 0, len(of_byte) - 1)]
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    if rule == "split":
        k = np.searchsorted(ends, byte, "right")  # tokens wholly before
        if not len(ends):
            return np.zeros(len(at))
        inside = np.minimum(k, len(ends) - 1)
        part = (byte - starts[inside]) / np.maximum(1, ends[inside] - starts[inside])
        return k + np.where(k < len(ends), part, 0.0)
    marks = starts if rule == "first" else ends - 1
    return np.searchsorted(marks, byte, "left")


def token_counts(df: DataFrame, tokenizer: str, sections: str | None = None, text: str = "text", key: str = "doc_id", rule: str = "first") -> DataFrame:
    """A row for each section: key, section, name, start, end, n_tokens, n_crossing (tokens over either bound), doc_tokens.

    sections: a column of (name, start, end) in code points; None: the lines, named by number.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    number = "double" if rule == "split" else "bigint"
    named = key if key not in COLUMNS else f"{key}_key"
    schema = f"`{named}` {df.schema[key].dataType.simpleString()}, section bigint, name string, start bigint, end bigint, n_tokens {number}, n_crossing bigint, doc_tokens bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokens.byte_bpe(tokenizer)
        for batch in batches:
            place, columns = [], [[] for _ in range(7)]
            spans = None if sections is None else batch.column(2)
            for row, body in enumerate(batch.column(1).to_pylist()):
                raw = np.frombuffer((body or "").encode(), np.uint8)
                if sections is None:
                    low, high = start, end = line_bounds(raw)
                    names, known = [str(k) for k in range(len(low))], np.ones(len(low), bool)
                else:
                    wanted = (spans[row].as_py() if spans[row].is_valid else None) or []
                    if not wanted:
                        continue
                    names, start, end = ([w[n] for w in wanted] for n in ("name", "start", "end"))
                    known = np.array([x is not None and y is not None for x, y in zip(start, end, strict=True)])
                    low, high = (np.array([max(0, x or 0) for x in v]) for v in (start, end))
                ids = bpe.ids(body or "")
                ends = np.cumsum(bpe.n_bytes[ids])
                first = (raw & 0xC0) != 0x80
                of_byte = np.append(np.flatnonzero(first), len(raw))
                n = np.maximum(0, cumulative(ends, rule, high, of_byte) - cumulative(ends, rule, low, of_byte))
                bounds = of_byte[np.clip(np.stack([low, high]), 0, len(of_byte) - 1)]
                crossed = ~np.isin(bounds, np.append(ends, 0))
                both = crossed.all(0) & (np.searchsorted(ends, bounds[0], "right") == np.searchsorted(ends, bounds[1], "right"))
                place += [row] * len(names)
                for column, values in zip(columns, (range(len(names)), names, *(x.tolist() if isinstance(x, np.ndarray) else x for x in (start, end)), np.where(known, n, -1).tolist(), np.where(known, crossed.sum(0) - both, -1).tolist(), [len(ids)] * len(names)), strict=True):
                    column += list(values)
            for k in (4, 5):
                columns[k] = [None if x < 0 else x for x in columns[k]]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64() if rule == "split" else pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=[named, *COLUMNS])

    wanted = [F.col(key).alias("key"), F.col(text).alias("text"), *([] if sections is None else [F.col(sections).cast(SECTION)])]
    return common.in_arrow(df.select(*wanted), count, schema, tokenizers=True)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.documents(spark, sf_dir), tokens.default_path()).drop("name")
