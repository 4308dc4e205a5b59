"""Helpers of the text operators: saved steps, slices of Arrow text, word hashes."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.session import checkpoint_dir

#: White space between words.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """A written copy in the shared checkpoint folder: cuts lineage and outlives executors."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(column):
    return F.translate(column, ASCII_UPPER, ASCII_LOWER)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; null is empty. No copy where there are no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of at most ``limit`` bytes, or of one longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the multiplier (or of its inverse) modulo 2^64."""
    key = "inverse" if inverse else "plain"
    if len(_POWERS.get(key, ())) < n:
        base = pow(MULTIPLIER, -1, 1 << 64) if inverse else MULTIPLIER
        size = 1 << max(12, int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _POWERS[key] = np.multiply.accumulate(steps)
    return _POWERS[key][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range: the same bytes give the same hash wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    values = (sums[ends] - sums[starts]) * powers(len(data), True)[starts]
    return mix(values + (ends - starts).astype(np.uint64))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def words(data: np.ndarray, offsets: np.ndarray, first: int, last: int):
    """Lower-cased (A-Z) bytes of rows ``first`` to ``last``; start, end and row of each word."""
    low, high = int(offsets[first]), int(offsets[last])
    text = _LOWER[data[low:high]]
    if not len(text):
        none = np.zeros(0, np.int64)
        return text, none, none, none
    edges = offsets[first : last + 1] - low
    solid = ~_SPACE[text]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    inner = edges[:-1][edges[:-1] < len(text)]
    begins[inner] = solid[inner]
    before = edges[1:][edges[1:] > 0] - 1
    ends[before] = solid[before]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return text, starts, stops, np.searchsorted(edges, starts, "right") - 1 + first
