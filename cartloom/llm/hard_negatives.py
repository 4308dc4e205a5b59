"""Hard negatives for contrastive training: Kronecker-packed integer products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm.common import saved
from cartloom.llm.topk import best
from cartloom.llm.vectors import decoded, encoded, grid, meet

#: Products of one tile of anchors and candidates kept at once.
TILE = 1 << 19
#: Marks a candidate that doesn't count, as in ``topk.best``.
BARRED = np.iinfo(np.int64).min
WIDE_FIELDS = 8


class Packing:
    """Fields of a wide integer. Components are biased by the lowest of their side, so all fields are non-negative and a field
    of ``bits`` holds the whole sum of products: no field ever carries into the next one."""

    def __init__(self, width: int, low_anchor: int, high_anchor: int, low: int, high: int):
        self.width, self.low_anchor, self.low = width, min(low_anchor, 0), min(low, 0)
        most = width * (max(high_anchor, 0) - self.low_anchor) * (max(high, 0) - self.low)
        self.bits = max(1, int(most).bit_length())
        # Sums beyond 64 bits take Python's integers of any width.
        self.dtype = np.uint64 if self.bits <= 64 else object
        self.fields = 64 // self.bits if self.bits <= 64 else WIDE_FIELDS

    def pack(self, vectors: np.ndarray) -> np.ndarray:
        """One row for each component: every entry holds that component of ``fields`` vectors, one after the other."""
        lanes = -(-len(vectors) // self.fields)
        biased = np.zeros((lanes * self.fields, self.width), self.dtype)
        biased[: len(vectors)] = (vectors.astype(object) - self.low if self.dtype is object else vectors - self.low).astype(self.dtype)
        out = np.zeros((self.width, lanes), self.dtype)
        for field in range(self.fields):
            part = biased[field * lanes : (field + 1) * lanes].T
            out += part << (field * self.bits if self.dtype is object else np.uint64(field * self.bits))
        return out

    def scores(self, anchors: np.ndarray, packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Exact inner products of ``anchors`` with the packed vectors, whose components add up to ``sums``."""
        wide = self.dtype is object
        biased = (anchors.astype(object) - self.low_anchor if wide else anchors - self.low_anchor).astype(self.dtype)
        total = np.zeros((len(anchors), packed.shape[1]), self.dtype)
        for t in range(self.width):
            total += biased[:, t, None] * packed[t][None, :]
        if self.bits == 64:
            fields = [total]
        else:
            shift = (lambda f: f * self.bits) if wide else (lambda f: np.uint64(f * self.bits))
            mask = (1 << self.bits) - 1 if wide else np.uint64((1 << self.bits) - 1)
            fields = [(total >> shift(f)) & mask for f in range(self.fields)]
        joined = np.concatenate(fields, axis=1)[:, : len(sums)]
        if not wide and self.bits <= 62:
            joined = joined.astype(np.int64)
            bias = self.low_anchor * sums[None, :] + self.low * anchors.sum(axis=1)[:, None] - self.width * self.low_anchor * self.low
            return joined + bias
        exact = joined.astype(object) + self.low_anchor * sums.astype(object)[None, :]
        exact += self.low * anchors.astype(object).sum(axis=1)[:, None] - self.width * self.low_anchor * self.low
        if exact.size and max(abs(exact.max()), abs(exact.min())) >= 1 << 63:
            raise ValueError("an inner product is too large for a 64-bit score")
        return exact.astype(np.int64)


def tiles(candidates: pa.Table, anchors: pa.Table, packing: Packing):
    """(rows of anchors, candidate ids, candidate labels, scores), candidates in order of their ids."""
    ids, labels = np.asarray(candidates["vec_id"], np.int64), np.asarray(candidates["label"], np.int64)
    if not len(ids) or not anchors.num_rows:
        return
    order = np.argsort(ids, kind="stable")
    ids, labels = ids[order], labels[order]
    vectors = decoded(candidates["n"], candidates["v"], packing.width)[order]
    packed, sums = packing.pack(vectors), vectors.sum(axis=1)
    asking = decoded(anchors["n"], anchors["v"], packing.width)
    step = max(1, TILE // len(ids))
    for at in range(0, len(asking), step):
        yield np.arange(at, min(at + step, len(asking))), ids, labels, packing.scores(asking[at : at + step], packed, sums)


def table_of(names: list[str], parts: list[list[np.ndarray]]) -> pa.Table:
    return pa.table({n: np.concatenate(p) if p else np.zeros(0, np.int64) for n, p in zip(names, parts, strict=True)})


def mine(
    df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", positives: int = 5,
    negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, side_rows: int = 32_768,
) -> DataFrame:
    """For each anchor and each of its nearest rows of the same label, the best rows of other labels in a band of scores.

    Components become ``floor(scale * x)``; the score is their integer inner product with the anchor, higher first, ties to
    the smaller id. An anchor's positives are the first ``positives`` rows of its label. For each, the first ``negatives``
    rows of other labels with ``low * p <= 100 * score <= high * p`` (p: the positive's score) are returned:
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Candidates are dealt into blocks and anchors into sets of at most about ``side_rows`` rows; every block meets every
    set twice: for the positives, then, with their scores, for the negatives. A meeting packs the components of several
    candidates into fields of one wide integer, multiplies once per anchor component and unpacks exact scores. It keeps the
    first few of each anchor only, so memory is bounded by the sides and a tile of scores.

    ``is_anchor`` is a condition on ``vec_id``. Rows with a null id, label or vector, or with a null or non-finite
    component, take no part. An anchor never meets rows of its own id; a repeated anchor id is asked once, with its
    smallest label and vector. Repeated candidate rows count each; a pair of anchor and positive with the same score is answered
    once. Missing components count as zero. A score beyond 64 bits raises ValueError. Other columns are ignored. An
    empty table, or one without anchors, gives no rows.
    """
    spark = df.sparkSession
    rows = saved(encoded(df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()), id_col, vec_col, scale, label_col))
    asked = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "n", "v", "turn", "low", "high")).alias("r")).select("vec_id", "r.*")
    a = asked.agg(F.count("*").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high")).first()
    c = rows.agg(F.count("*").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("n").alias("n")).first()
    packing = Packing(max(1, c.n or 1), a.low or 0, a.high or 0, c.low or 0, c.high or 0)
    blocks, sets = grid(c.rows, a.rows, side_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    candidates, columns = rows.select("turn", "vec_id", "label", "n", "v"), ["turn", "vec_id", "label", "n", "v"]

    def nearest(theirs: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        own, own_labels = np.asarray(anchors["vec_id"], np.int64), np.asarray(anchors["label"], np.int64)
        for at, ids, labels, scores in tiles(theirs, anchors, packing):
            scores[(labels[None, :] != own_labels[at, None]) | (ids[None, :] == own[at, None])] = BARRED
            who, what = best(scores, positives)
            for part, values in zip(found, (own[at][who], ids[what], scores[who, what]), strict=True):
                part.append(values)
        return table_of(["anchor_id", "positive_id", "positive_score"], found)

    near = meet(candidates, asked.select(*columns), blocks, sets, nearest, "anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = saved(near.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= positives).drop("_n").distinct())

    bands = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("positive_score")).alias("bands"))

    def negative(theirs: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], [], []]
        own, own_labels, wanted = np.asarray(anchors["vec_id"], np.int64), np.asarray(anchors["label"], np.int64), anchors["bands"].to_pylist()
        for at, ids, labels, scores in tiles(theirs, anchors, packing):
            scores[labels[None, :] == own_labels[at, None]] = BARRED
            scores[ids[None, :] == own[at, None]] = BARRED
            for turn in range(max(len(wanted[i]) for i in at)):
                band = [(i, wanted[i][turn]) for i in at if turn < len(wanted[i])]
                mine_ = np.array([i for i, _ in band])
                # low * p <= 100 * s <= high * p, in whole numbers
                least = np.array([max(-(-low * p // 100), BARRED + 1) for _, p in band])
                most = np.array([high * p // 100 for _, p in band])
                here = scores[mine_ - at[0]]
                here[(here < least[:, None]) | (here > most[:, None])] = BARRED
                who, what = best(here, negatives)
                values = (own[mine_[who]], np.array([p for _, p in band], np.int64)[who], ids[what], here[who, what])
                for part, value in zip(found, values, strict=True):
                    part.append(value)
        return table_of(["anchor_id", "positive_score", "negative_id", "negative_score"], found)

    far = meet(candidates, asked.select(*columns).join(bands, "vec_id"), blocks, sets, negative,
               "anchor_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return near.join(far, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
