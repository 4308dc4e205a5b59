"""Mixing sources to target weights."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartloom.llm.common import WORD, saved
from cartloom.operators.skew import numbered

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3


def water_fill(sizes: np.ndarray, weights: np.ndarray, most: float) -> np.ndarray:
    """Shares of the total by weight; a share stops at ``most`` times its size and the excess is shared again."""
    total, caps = float(sizes.sum()), most * sizes.astype(float)
    full = caps <= 0
    while True:
        open_weight = weights[~full].sum()
        level = (total - caps[full].sum()) / open_weight if open_weight else 0.0
        over = ~full & (weights * level > caps)
        if not over.any():
            return np.where(full, caps, weights * level)
        full |= over


def splitting_tree(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (rows) in each shard (columns).

    From the root down, the blocks of a node go left and right by a multivariate hypergeometric draw: each half gets an
    exact number of blocks, and every source's blocks add up to its quota.
    """
    rng = np.random.default_rng(seed)
    out = np.zeros((len(counts), shards), np.int64)

    def split(own: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[:, low] = own
            return
        middle = (low + high) // 2
        share = int(own.sum()) * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(own, share, method="marginals") if own.sum() else own * 0
        split(left, low, middle)
        split(own - left, middle, high)

    split(counts.astype(np.int64), 0, shards)
    return out


def source_plan(sizes: DataFrame, weights: tuple[float, ...], most: float, block_words: int, max_blocks: int) -> tuple[list, DataFrame]:
    """One row per source: its size, its target, whole passes, the words of the last pass and its number of blocks."""
    spark = sizes.sparkSession
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.col("source").asc_nulls_last()).collect()
    own = np.array([r.source_size for r in per], np.int64)
    target = water_fill(own, np.array([weights[i % len(weights)] for i in range(len(per))]), most) if len(per) else own.astype(float)
    total = int(own.sum())
    size_of_block = max(block_words, -(-total // max_blocks), 1)
    rows = []
    for i, r in enumerate(per):
        passes = min(int(target[i] // own[i]), int(most)) if own[i] else 0
        rows.append((i, r.source, int(own[i]), float(target[i]), passes, float(target[i] - passes * own[i]), max(1, -(-int(own[i]) // size_of_block))))
    schema = "source_no int, source string, source_size long, target double, passes int, rest double, n_blocks long"
    return rows, spark.createDataFrame(rows, schema)


#: What ``mix`` adds.
ADDED = ("size", "source_size", "target", "passes", "in_rest", "taken", "block", "shard", "place")


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, shards: int | None = None, block_words: int = 20_000,
    max_blocks: int = 65_536, seed: int = 7, shard_words: int = 20_000_000,
) -> DataFrame:
    """Draw whole documents so that each source's words come near its target.

    Sources in order of code points (null last) weigh ``weights`` in turn and share 100 % of all words; a target stops
    at ``most`` times its source's size and the excess is shared again. Every source is dealt by a seeded hash into
    blocks of about ``block_words`` (larger ones where there would be over ``max_blocks``). A target is so many whole passes
    and a last one, which draws blocks in a permuted order up to the quota; only the block at the edge is cut, and one
    more of its documents drawn if that brings the words nearer. A multivariate hypergeometric tree deals the drawn blocks of all sources to the output shards
    (16 or more, of about ``shard_words``); inside a shard, ``place`` is a local shuffle.

    Returns all columns of ``docs`` (those named as in ``ADDED`` are replaced) and: size, source_size, target, passes,
    in_rest, taken, block, shard, place. Null text has size 0; documents of size 0 are never taken. Rows of equal id and text share a
    block and are told apart only where the cut goes through them: so many of them are drawn as fit, whichever they are. An
    empty table gives no rows. The same rows and seed give the same mix, but for which of such equal rows is drawn.

    The driver holds one row per source (the mixture's table); documents and blocks stay on the executors.
    """
    keep = [c for c in docs.columns if c not in ADDED]
    # The caller's columns travel in one struct, so no name of theirs meets one of ours.
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("source"), F.xxhash64(F.lit(seed), F.col("doc_id"), F.xxhash64("text")).alias("draw"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    narrow = saved(sized.select("source", "size", "draw"))
    rows, plan = source_plan(narrow, weights, most, block_words, max_blocks)
    plan = F.broadcast(plan)  # one row per source
    shards = shards or max(16, -(-sum(r[2] for r in rows) // shard_words))

    def placed(df: DataFrame) -> DataFrame:
        joined = df.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")
        return joined.withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 1), "draw"), F.col("n_blocks")))

    # At most max_blocks rows and one for each source.
    blocks = placed(narrow).groupBy("source_no", "block", "rest").agg(F.sum("size").alias("words"))
    turn = Window.partitionBy("source_no").orderBy(F.xxhash64(F.lit(seed + 2), "source_no", "block"), "block")
    blocks = blocks.withColumn("upto", F.sum("words").over(turn.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = blocks.withColumn("before", F.col("upto") - F.col("words"))
    # The tree deals every block of the mix that is drawn in the last pass; the others follow the same dealing.
    drawn = blocks.withColumn("turn", F.row_number().over(turn)).withColumn("last", F.when(F.col("before") < F.col("rest"), 1).otherwise(0))
    quotas = {r.source_no: (r.drawn, r.others) for r in drawn.groupBy("source_no").agg(
        F.sum("last").alias("drawn"), F.sum(1 - F.col("last")).alias("others")).collect()}
    counts = np.array([quotas.get(r[0], (0, 0)) for r in rows], np.int64).reshape(len(rows), 2)
    ends = [np.cumsum(splitting_tree(counts[:, part], shards, seed + part), axis=1) for part in (0, 1)]
    bounds = docs.sparkSession.createDataFrame(
        [(r[0], ends[0][i].tolist(), ends[1][i].tolist(), int(counts[i, 0])) for i, r in enumerate(rows)],
        "source_no int, drawn_ends array<long>, other_ends array<long>, n_drawn long")
    shard = F.when(F.col("last") == 1, F.size(F.filter("drawn_ends", lambda e: e < F.col("turn")))).otherwise(
        F.size(F.filter("other_ends", lambda e: e < F.col("turn") - F.col("n_drawn"))))
    dealt = drawn.join(F.broadcast(bounds), "source_no").select("source_no", "block", "words", "before", "upto", shard.alias("shard"))
    full = placed(sized).join(F.broadcast(dealt), ["source_no", "block"])  # max_blocks bounds it

    # Only the edge block of a source is cut: its documents in permuted order as far as they fit, equal rows one by one,
    # then the one that fits best.
    edge = placed(narrow).join(F.broadcast(dealt), ["source_no", "block"]).where(
        (F.col("before") < F.col("rest")) & (F.col("upto") > F.col("rest")) & (F.col("size") > 0))
    steps = edge.groupBy("source_no", "draw", "rest", "before").agg(F.first("size").alias("unit"), F.count("*").alias("n"), F.sum("size").alias("size"))
    along = F.sum("size").over(Window.partitionBy("source_no").orderBy("draw").rowsBetween(Window.unboundedPreceding, 0))
    steps = saved(steps.withColumn("end", F.col("before") + along))
    fits = F.col("end") <= F.col("rest")
    upto = steps.where(~fits).groupBy("source_no").agg(F.min_by(F.struct(
        "draw", F.floor((F.col("rest") - F.col("end") + F.col("size")) / F.col("unit")).cast("long").alias("copies"),
        F.pmod(F.col("rest") - F.col("end") + F.col("size"), F.col("unit")).alias("gap")), "draw").alias("cut"))
    upto = upto.select("source_no", F.col("cut.draw").alias("cut"), F.col("cut.copies").alias("copies"), F.col("cut.gap").alias("gap"))
    off = F.struct(F.abs(F.col("unit") - F.col("gap")).alias("off"), "draw")
    extra = steps.where(~fits).join(F.broadcast(upto.select("source_no", "gap")), "source_no").groupBy("source_no").agg(
        F.min(off).alias("best"), F.first("gap").alias("gap"))
    extra = extra.where(F.col("best.off") < F.col("gap")).select("source_no", F.col("best.draw").alias("extra"))
    parts = {}  # (source, draw): how many of its equal rows are drawn; at most two per source
    cuts = []
    for r in upto.join(extra, "source_no", "left").collect():
        cuts.append((r.source_no, r.cut))
        parts[r.source_no, r.cut] = r["copies"]
        if r.extra is not None:
            parts[r.source_no, r.extra] = parts.get((r.source_no, r.extra), 0) + 1
    spark = docs.sparkSession
    kinds = "source_no int, draw long, most long, counted boolean"
    # Rows of the documents that are drawn in part are counted off; there may be very many equal ones, so by ranges.
    parted = steps.join(F.broadcast(spark.createDataFrame([(*k, v, True) for k, v in parts.items() if v], kinds)), ["source_no", "draw"])
    counted = {(r.source_no, r.draw) for r in parted.where(F.col("n") > F.col("most")).select("source_no", "draw").collect()}
    some = spark.createDataFrame([(*k, v, k in counted) for k, v in parts.items() if v], kinds)
    full = full.join(F.broadcast(spark.createDataFrame(cuts, "source_no int, cut long")), "source_no", "left")
    full = full.join(F.broadcast(some), ["source_no", "draw"], "left")
    first = F.lit(1).cast("long")
    if counted:
        few = saved(full.where("counted").withColumn("at", F.monotonically_increasing_id()))
        few = numbered(few, ["source_no", "draw"], ["at"], ["at"], out="nth").drop("at")
        full = full.where(~F.coalesce("counted", F.lit(False))).withColumn("nth", first).unionByName(few)
    else:
        full = full.withColumn("nth", first)
    chosen = F.coalesce(F.col("draw") < F.col("cut"), F.lit(True)) | F.coalesce(F.col("nth") <= F.col("most"), F.lit(False))
    within = F.when(F.col("upto") <= F.col("rest"), True).when(F.col("before") >= F.col("rest"), False).otherwise(chosen)
    in_rest = within & (F.col("size") > 0)
    return full.select(
        *[F.col("row").getField(c).alias(c) for c in keep], "size", "source_size", "target", "passes", in_rest.alias("in_rest"),
        (F.col("size") * (F.col("passes") + in_rest.cast("long"))).alias("taken"),
        "block", "shard", F.xxhash64(F.lit(seed + 3), "draw").alias("place"))


def sampled_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: each row as often as it is drawn, with the columns of ``docs``; rows never drawn go.

    Rows come shard by shard, each shard in the order of its local shuffle; the passes over a document follow each
    other at different places.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"), "doc_id", "source", "text")
    mixed = mix(named, **options)
    times = F.when(F.col("size") > 0, F.col("passes") + F.col("in_rest").cast("int")).otherwise(0)
    drawn = mixed.where(times > 0).withColumn("_turn", F.explode(F.sequence(F.lit(1), times)))
    drawn = drawn.select("_all", "shard", F.xxhash64("place", "_turn").alias("place"))
    ordered = drawn.repartition("shard").sortWithinPartitions("shard", "place")
    return ordered.select(*[F.col("_all").getField(c).alias(c) for c in docs.columns])
