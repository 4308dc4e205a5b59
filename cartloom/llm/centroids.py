"""Exact centroid clustering of integer vectors with geometric bounds on moved centroids."""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import saved
from cartloom.llm.vectors import decoded, encoded
from cartloom.session import checkpoint_dir

#: Bounds are kept in floating point; they count only beyond this relative slack, so rounding can't hide a nearer centroid.
SLACK = 1e-9
#: Rows of vectors that share one row of the tables, and bytes of vectors in a bucket.
BLOCK_ROWS, BUCKET_BYTES = 512, 32 << 20
MOST_BUCKETS = 100_000
STATE = "block long, cluster binary, upper binary, lower binary, sums array<long>, scanned long"


@dataclass
class Moves:
    """Centroids of a round and how far each went since the last one."""

    centroids: np.ndarray
    drift: np.ndarray
    #: loss[i, j]: how much nearer centroid j may have come to any vector of cluster i.
    loss: np.ndarray


def drifts(before: np.ndarray, after: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Drift of each centroid, and ``loss`` of each pair.

    The vectors of cluster i lie in a sphere of ``radius[i]`` around its old centroid. While centroid j moves along a
    line of length d, its distance to x shrinks at each point by the cosine of the angle between the move and the
    direction to x; that cosine is largest at the start. Seen from the old j, the plane through both centroids and the move
    shows the sphere as a disc whose direction makes angle a with the move and which spans b = asin(radius / distance)
    to each side. So no distance shrinks by more than d * cos(max(0, a - b)): at most the whole drift, and less than
    nothing where j moves away. A sphere around the old j itself loses the whole drift.
    """
    step = (after - before).astype(float)
    d = np.sqrt((step * step).sum(axis=1))
    apart = before[:, None, :].astype(float) - before[None, :, :]  # [i, j]: from j to i
    far = np.sqrt((apart * apart).sum(axis=2))
    along = (apart * step[None, :, :]).sum(axis=2)
    cosine = np.clip(along / np.maximum(far * d[None, :], 1e-300), -1.0, 1.0)
    inside = radius[:, None] * (1 + SLACK) >= far
    span = np.arcsin(np.clip(radius[:, None] * (1 + SLACK) / np.maximum(far, 1e-300), 0.0, 1.0))
    angle = np.maximum(0.0, np.arccos(cosine) - span - 1e-6)
    loss = np.where(inside | (d[None, :] == 0), d[None, :], d[None, :] * np.cos(angle))
    return d * (1 + SLACK), loss + np.abs(loss) * SLACK


def squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances in 64-bit integers."""
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        away = vectors - c
        out[:, j] = np.einsum("ij,ij->i", away, away)
    return out


def reassign(vectors: np.ndarray, moves: Moves, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray):
    """Nearest centroids, new bounds and how many vectors were scanned.

    ``upper`` bounds the distance to the own centroid, ``lower[:, j]`` that to centroid j from below. A vector keeps its cluster
    without a look at it if every other lower bound is above its upper bound; the rest are scanned exactly (ties: smaller number).
    """
    k = len(moves.centroids)
    upper = upper + moves.drift[cluster]
    lower = np.maximum(lower - moves.loss[cluster], 0.0)
    others = np.where(np.arange(k)[None, :] == cluster[:, None], np.inf, lower)
    open_ = np.flatnonzero(others.min(axis=1, initial=np.inf) <= upper * (1 + SLACK))
    if len(open_):
        # The exact distance to the own centroid settles most of them.
        own = vectors[open_] - moves.centroids[cluster[open_]]
        upper[open_] = np.sqrt(np.einsum("ij,ij->i", own, own).astype(float)) * (1 + SLACK)
        open_ = open_[others[open_].min(axis=1) <= upper[open_] * (1 + SLACK)]
    if len(open_):
        exact = squares(vectors[open_], moves.centroids)
        cluster, lower = cluster.copy(), lower.copy()
        cluster[open_] = exact.argmin(axis=1)
        roots = np.sqrt(exact.astype(float))
        lower[open_] = roots * (1 - SLACK)
        upper[open_] = roots[np.arange(len(open_)), cluster[open_]] * (1 + SLACK)
    return cluster, upper, lower, len(open_)


def tally(change: np.ndarray, vectors: np.ndarray, clusters: np.ndarray, sign: int) -> None:
    """Add the sums and counts of ``vectors`` by cluster."""
    for j in np.unique(clusters):
        own = clusters == j
        change[j, :-1] += sign * vectors[own].sum(axis=0)
        change[j, -1] += sign * int(own.sum())


def first_centroids(rows: DataFrame, k: int, seed: int, width: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of ``seed:vec_id``; rows of equal id stand in order of their bytes."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    top = rows.select(digest.alias("h"), "n", "v").orderBy(F.col("h").asc_nulls_last(), "n", "v").limit(k).toArrow()
    return decoded(top["n"], top["v"], width)


def bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """A written table in the checkpoint folder, bucketed by block: joins of two of them need no shuffle."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    df.write.bucketBy(buckets, "block").sortBy("block").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def cluster_vectors(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3,
) -> DataFrame:
    """Lloyd's rounds in whole numbers: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, one row per vector.

    Vectors of exactly ``width`` components, none null or non-finite, become ``floor(scale * x)``. Centroids start as the ``k``
    vectors with the smallest SHA-256 of ``seed:vec_id``. A round assigns every vector to the nearest centroid (ties:
    smaller number) and replaces each non-empty centroid by the exact floor of its mean; after ``rounds`` rounds vectors are assigned once more.

    Vectors lie in a table bucketed by block. A round joins it bucket by bucket, without a shuffle, to the bounds the last
    round wrote, loosens these by the geometry of the moves (``drifts``), and scans only vectors the bounds leave open. Sums change by
    the vectors that moved. The driver holds the centroids, radii and sums: ``k * (width + 3)`` numbers, whatever the input.

    Null ids count as vectors but start no centroid before others. Repeated rows count each. Fewer than ``k`` vectors give so many
    centroids. Other columns are ignored. An empty table gives no rows. Components whose squared distances may not
    fit 64 bits raise ValueError; sums beyond 64 bits fail in Spark's checked addition rather than wrap.
    """
    spark = df.sparkSession
    rows = saved(encoded(df, id_col, vec_col, scale, width=width))
    counts = rows.agg(F.count("*").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.length("v")).alias("bytes")).first()
    span = (counts.high or 0) - (counts.low or 0) + 1
    if width * span * span >= 1 << 62:
        raise ValueError("squared distances don't fit 64 bits")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MOST_BUCKETS, max(min(partitions, math.ceil(counts.n / BLOCK_ROWS)), math.ceil((counts.bytes or 0) / BUCKET_BYTES), 1))
    n_blocks = max(buckets, math.ceil(counts.n / BLOCK_ROWS))
    centroids = first_centroids(rows, k, seed, width)
    k = len(centroids)
    run = f"centroids_{uuid.uuid4().hex}"
    def pack(part: pa.Table) -> pa.Table:
        matrix = decoded(part["n"], part["v"], width)
        narrow = not matrix.size or (matrix.min() >= -32768 and matrix.max() < 32768)
        data = matrix.astype("<i2" if narrow else "<i8").tobytes()
        return pa.table({"block": part["block"][:1], "ids": pa.array([part["vec_id"].to_pylist()], pa.list_(pa.int64())), "v": pa.array([data], pa.binary())})

    # Turns are spread evenly, so a block has about BLOCK_ROWS rows whatever ids repeat.
    dealt = rows.select(F.pmod("turn", F.lit(n_blocks)).alias("block"), "vec_id", "n", "v").repartition(buckets, "block")
    tables = [f"{run}_vectors"]
    vectors = bucketed(dealt.groupBy("block").applyInArrow(pack, "block long, ids array<long>, v binary"), tables[0], buckets)

    def matrix_of(ids: int, data: bytes) -> np.ndarray:
        return np.frombuffer(data, "<i2" if len(data) == 2 * ids * width else "<i8").reshape(ids, width).astype(np.int64)

    def bounds(batch: pa.RecordBatch, i: int):
        read = lambda name, kind: np.frombuffer(batch.column(name)[i].as_py(), kind)
        return read("cluster", "<i4").astype(np.int64), read("upper", "<f8"), read("lower", "<f4").reshape(-1, k).astype(float)

    def round_(moves: Moves, state: DataFrame | None) -> DataFrame:
        first = state is None

        def assign(batches):
            for batch in batches:
                out: list[list] = [[], [], [], [], []]
                sizes = np.asarray(batch.column("ids").value_lengths())
                change, radius = np.zeros((k, width + 1), np.int64), np.zeros(k)
                for i in range(batch.num_rows):
                    own = matrix_of(int(sizes[i]), batch.column("v")[i].as_py())
                    if first:
                        exact = squares(own, moves.centroids)
                        now = exact.argmin(axis=1)
                        roots = np.sqrt(exact.astype(float))
                        lower, upper, scanned = roots * (1 - SLACK), roots[np.arange(len(own)), now] * (1 + SLACK), len(own)
                        tally(change, own, now, 1)
                    else:
                        was, upper, lower = bounds(batch, i)
                        now, upper, lower, scanned = reassign(own, moves, was, upper, lower)
                        moved = now != was
                        tally(change, own[moved], was[moved], -1)
                        tally(change, own[moved], now[moved], 1)
                    np.maximum.at(radius, now, upper)
                    # 32 bits of a lower bound are enough, rounded down.
                    short = np.nextafter(lower.astype("<f4"), np.float32(-1))
                    values = (batch.column("block")[i].as_py(), now.astype("<i4").tobytes(), upper.astype("<f8").tobytes(), short.tobytes(), scanned)
                    for part, value in zip(out, values, strict=True):
                        part.append(value)
                sums = [None] * batch.num_rows
                if sums:  # the batch's sums stand in its last row
                    sums[-1] = [*change.ravel().tolist(), *np.ceil(radius).astype(np.int64).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), *(pa.array(c, pa.binary()) for c in out[1:4]), pa.array(sums, pa.list_(pa.int64())), pa.array(out[4], pa.int64())],
                    ["block", "cluster", "upper", "lower", "sums", "scanned"])

        source = vectors if first else vectors.join(state.select("block", "cluster", "upper", "lower"), "block")
        tables.append(f"{run}_{len(tables)}")
        return bucketed(source.mapInArrow(assign, STATE), tables[-1], buckets)

    def totals(state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Changes of the sums and counts, and the radius of each cluster: k * (width + 2) rows."""
        cells = state.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("total"), F.max("x").alias("most")).collect()
        sums, most = [0] * (k * (width + 2)), [0] * (k * (width + 2))
        for r in cells:
            sums[r["at"]], most[r["at"]] = r["total"], r["most"]
        edge = k * (width + 1)
        return np.array(sums[:edge], object).reshape(k, width + 1), np.array(most[edge:], float)

    state, sums = None, np.zeros((k, width + 1), object)
    moves = Moves(centroids, np.zeros(k), np.zeros((k, k)))
    try:
        for _ in range(rounds if k else 0):
            state = round_(moves, state)
            change, radius = totals(state)
            sums = sums + change
            after = moves.centroids.copy()
            for j in range(k):
                if sums[j, width]:
                    after[j] = [int(s) // int(sums[j, width]) for s in sums[j, :width]]
            moves = Moves(after, *drifts(moves.centroids, after, radius))
        fresh = state is None
        last = vectors.join(state.select("block", "cluster", "upper", "lower"), "block") if state is not None else vectors

        def settle(batches):
            for batch in batches:
                out: tuple[list, list, list] = ([], [], [])
                for i in range(batch.num_rows if k else 0):
                    ids = batch.column("ids")[i].as_py()
                    own = matrix_of(len(ids), batch.column("v")[i].as_py())
                    if fresh:
                        now = squares(own, moves.centroids).argmin(axis=1)
                    else:
                        was, upper, lower = bounds(batch, i)
                        now = reassign(own, moves, was, upper, lower)[0]
                    away = own - moves.centroids[now]
                    for part, value in zip(out, (ids, now.tolist(), np.einsum("ij,ij->i", away, away).tolist()), strict=True):
                        part.extend(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64())], ["vec_id", "cluster", "distance"])

        placed = saved(last.mapInArrow(settle, "vec_id long, cluster int, distance long"))
    finally:
        for name in tables:  # the files stay in the checkpoint folder; only the names go
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return with_inertia(spark, placed, moves.centroids)


def with_inertia(spark: SparkSession, placed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Sums of distances beside each row; the table joined has one row per centroid."""
    per = {r["cluster"]: r["own"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("own")).collect()}
    digest = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    facts = [(j, per[j], sum(per.values()), digest[j]) for j in sorted(per)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
