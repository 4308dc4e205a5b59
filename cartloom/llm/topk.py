"""Exact top-k search by inner product."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCORES = "query_id long, vec_id long, score long"
#: Scores above this can't be packed with a position into one 64-bit key.
PACKED = 1 << 62


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """Rows (vec_id, v) with ``floor(scale * x)`` as integers. Vectors that are null or hold null or non-finite parts go."""
    parts = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(parts, lambda x: F.floor(x * F.lit(float(scale)))).alias("v")
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, padded with zeros to ``width``."""
    column = column.combine_chunks()
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = flat
    return out


def exact_scores(scores: np.ndarray) -> np.ndarray:
    """Python's integers back as 64-bit scores; ValueError where one doesn't fit."""
    if scores.size and max(abs(scores.max()), abs(scores.min())) >= 1 << 63:
        raise ValueError("an inner product is too large for a 64-bit score")
    return scores.astype(np.int64)


def accumulate(queries: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Dense scores of each query, one term after the other: its weight times the term's postings."""
    most = sum(int(np.abs(queries[:, t]).max(initial=0)) * int(np.abs(w).max(initial=0)) for t, (_, w) in enumerate(postings))
    if most >= 1 << 62:  # sums might wrap: whole numbers of any size instead
        wide = np.zeros((len(queries), size), object)
        for term, (rows, weights) in enumerate(postings):
            if len(rows):
                wide[:, rows] += queries[:, term].astype(object)[:, None] * weights.astype(object)[None, :]
        return exact_scores(wide)
    scores = np.zeros((len(queries), size), np.int64)
    for term, (rows, weights) in enumerate(postings):
        asking = np.flatnonzero(queries[:, term])
        if len(asking) and len(rows):
            add = queries[asking, term][:, None] * weights[None, :]
            if len(rows) == size and len(asking) == len(queries):
                scores += add
            else:
                scores[np.ix_(asking, rows)] += add
    return scores


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Query and candidate positions of the ``k`` highest scores of each row; ties go to the smaller position.

    A row's lowest possible value marks a candidate that doesn't count.
    """
    barred, size = np.iinfo(np.int64).min, scores.shape[1]
    k = min(k, size)
    if np.abs(scores[scores != barred]).max(initial=0) < PACKED // size:
        keys = np.where(scores == barred, barred, scores * size + (size - 1 - np.arange(size)))
        found = np.argpartition(keys, size - k, axis=1)[:, size - k :]
    else:
        found = np.argsort(-scores.astype(object), axis=1, kind="stable")[:, :k]
    asked = np.repeat(np.arange(len(scores)), k)
    found = found.ravel()
    real = scores[asked, found] != barred
    return asked[real], found[real]


def top_k(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
    scale: int = 256, block_rows: int | None = None, query_rows: int = 16384,
) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each query row: query_id, rank, vec_id, score.

    Candidates are dealt into blocks of about ``block_rows`` (2,048 to ``query_rows`` if not given), queries into blocks of about ``query_rows``. Every pair of
    blocks meets in one task, which scatters the weighted postings of each term into dense scores and keeps ``k``
    by partition selection; a window merges. Memory of a task is bounded by the two block sizes.

    ``is_query`` is a condition on ``vec_id``. A query never finds rows of its own id. Ties go to the smaller id. Missing
    dimensions count as zero. Null ids, null vectors and vectors with null or non-finite parts take no part. Repeated
    candidate rows count each; a repeated query id is asked once, with its smallest vector. Sums that might wrap are taken in
    integers of any size; a component or score beyond 64 bits raises an error. An empty table gives no rows.

    Both sides of a meeting are bounded, and blocks are as large as sets where there are many queries: a vector is copied once
    for each set of queries, a query once for each block.
    """
    rows = integer_vectors(df, id_col, vec_col, scale)
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    counts = rows.select(F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("q"), F.max(F.size("v")).alias("w")).first()
    sets, width = max(1, math.ceil((counts.q or 0) / query_rows)), max(1, counts.w or 1)
    # Small blocks only as far as tasks are needed.
    tasks = math.ceil(2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) / sets)
    blocks = max(1, math.ceil(counts.n / (block_rows or max(2048, min(query_rows, counts.n // tasks)))))
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    left = rows.withColumn("block", spread(blocks, 1)).withColumn("set", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))
    right = asked.withColumn("set", spread(sets, 2)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        ids, asking = np.asarray(candidates["vec_id"]), np.asarray(queries["vec_id"])
        parts: tuple[list, list, list] = ([], [], [])
        if len(ids) and len(asking):
            order = np.argsort(ids, kind="stable")
            ids, vectors, questions = ids[order], matrix(candidates["v"], width)[order], matrix(queries["v"], width)
            postings = [(rows := np.flatnonzero(vectors[:, t]), vectors[rows, t]) for t in range(width)]
            step = max(1, (1 << 22) // max(1, len(ids)) // 8)
            for at in range(0, len(asking), step):
                scores = accumulate(questions[at : at + step], postings, len(ids))
                mine = asking[at : at + step]
                scores[mine[:, None] == ids[None, :]] = np.iinfo(np.int64).min
                who, what = best(scores, k)
                for part, values in zip(parts, (mine[who], ids[what], scores[who, what]), strict=True):
                    part.append(values)
        joined = [np.concatenate(p) if p else np.zeros(0, np.int64) for p in parts]
        return pa.table({"query_id": joined[0], "vec_id": joined[1], "score": joined[2]})

    found = left.groupBy("block", "set").cogroup(right.groupBy("block", "set")).applyInArrow(search, SCORES)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
