"""Integer vectors as bytes: read once, kept in a saved table, dealt to a grid of blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import mix

#: The columns of encoded rows: turn deals them out, n counts components, low and high bound them.
ENCODED = "turn long, vec_id long, label long, n int, v binary, low long, high long"
#: Integers from here on have no exact 64-bit form.
LARGEST = 1 << 62


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def encoded(df: DataFrame, id_col: str, vec_col: str, scale: int, label_col: str | None = None, width: int | None = None) -> DataFrame:
    """Rows (turn, vec_id, label, n, v, low, high) with ``floor(scale * x)`` of each component, x as double.

    Vectors that are null or hold null or non-finite components go, with ``width`` also those of another length.
    ``v`` holds 2 bytes a component where all of a vector fit, else 8, so equal vectors have equal bytes. ``turn`` numbers
    the rows (spread over 64 bits): repeated rows get different turns. An integer of 2^62 or more raises ValueError.
    """
    label = F.col(label_col).cast("long") if label_col else F.lit(None).cast("long")
    plain = df.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), F.col(vec_col).cast("array<double>").alias("x"))

    def encode(batches):
        at = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for batch in batches:
            x = batch.column("x")
            lengths = np.nan_to_num(np.asarray(x.value_lengths().fill_null(-1)), nan=-1).astype(np.int64)
            flat = np.asarray(x.flatten().to_numpy(zero_copy_only=False), np.float64)
            sizes = np.maximum(lengths, 0)
            edges = np.concatenate(([0], np.cumsum(sizes)))
            bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
            keep = (lengths >= 0) & (bad[edges[1:]] == bad[edges[:-1]])
            if width is not None:
                keep &= lengths == width
            kept = np.flatnonzero(keep)
            with np.errstate(over="ignore"):
                whole = np.floor(np.where(np.isfinite(flat), flat, 0.0) * float(scale))
            if not (np.abs(whole) < LARGEST).all():
                raise ValueError("a component is too large for a 64-bit integer")
            whole = whole.astype(np.int64)
            parts, lows, highs = [], np.zeros(len(kept), np.int64), np.zeros(len(kept), np.int64)
            for i, row in enumerate(kept.tolist()):
                own = whole[edges[row] : edges[row + 1]]
                if len(own):
                    lows[i], highs[i] = own.min(), own.max()
                small = -32768 <= lows[i] and highs[i] < 32768
                parts.append(own.astype("<i2" if small else "<i8").tobytes())
            turns = mix(np.arange(at, at + len(kept), dtype=np.uint64)).view(np.int64)
            at += len(kept)
            take = pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(turns), batch.column("vec_id").take(take), batch.column("label").take(take), pa.array(sizes[kept].astype(np.int32)),
                 binaries(parts), pa.array(lows), pa.array(highs)], ["turn", "vec_id", "label", "n", "v", "low", "high"])

    return plain.mapInArrow(encode, ENCODED)


def decoded(n: pa.ChunkedArray | pa.Array, v: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Encoded vectors as rows of 64-bit integers, padded with zeros to ``width``."""
    lengths, cells = np.asarray(n, np.int64), v.to_pylist()
    out = np.zeros((len(cells), width), np.int64)
    narrow = np.array([len(c) for c in cells], np.int64) == 2 * lengths
    if len(cells) and narrow.all() and (lengths == width).all():
        out[:] = np.frombuffer(b"".join(cells), "<i2").reshape(len(cells), width)
        return out
    for i, cell in enumerate(cells):
        out[i, : lengths[i]] = np.frombuffer(cell, "<i2" if narrow[i] else "<i8")
    return out


def grid(rows: int, asked: int, side_rows: int, tasks: int) -> tuple[int, int]:
    """Numbers of blocks of rows and of sets of asked rows.

    Every block meets every set, so a row is copied once for each set and an asked row once for each block. Sides of equal
    bound keep the copies of both lowest for the memory of one meeting; small inputs get as many blocks as ``tasks`` need.
    """
    sets = max(1, math.ceil(asked / side_rows))
    return max(1, math.ceil(rows / side_rows), min(math.ceil(tasks / sets), math.ceil(rows / 256))), sets


def meet(rows: DataFrame, asked: DataFrame, blocks: int, sets: int, task, schema: str) -> DataFrame:
    """Run ``task(rows, asked)`` on every pair of a block of ``rows`` and a set of ``asked``; both have a ``turn``."""
    deal = lambda n, salt: F.pmod(F.xxhash64("turn", F.lit(salt)), F.lit(n)).cast("int")
    left = rows.withColumn("_block", deal(blocks, 1)).withColumn("_set", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))  # both sides may come from one table
    right = asked.withColumn("_set", deal(sets, 2)).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("_block", "_set").cogroup(right.groupBy("_block", "_set")).applyInArrow(task, schema)
