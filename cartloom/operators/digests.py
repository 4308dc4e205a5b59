"""Two copies of a table compared by digests: buckets first, rows only where a bucket differs.

A digest is a pair of sums of row hashes, so it depends on neither row order nor partitioning and counts repeated rows.
One aggregation per side makes the leaves (``bucket, rows, low, high``), which can be kept beside the table; parents are sums of
leaves. A load of 100 TB is checked by comparing some thousand leaves, and only rows of unequal leaves are shuffled by key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.operators.skew import joined

#: Leaves of a digest tree; a power of two, so that halving gives whole levels.
LEAVES = 4096
SUM = "decimal(38,0)"
SIDES = ("source", "target")


def row_hash(columns: Sequence[Column], seed: int) -> Column:
    """64-bit hash that tells null from absent: ``xxhash64`` alone skips nulls, so their places are hashed as well."""
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "0").otherwise("1") for c in columns])
    return F.xxhash64(F.lit(seed), nulls, *columns)


def bucket_of(keys: Sequence[str], leaves: int = LEAVES) -> Column:
    return F.pmod(row_hash([F.col(k) for k in keys], 7), F.lit(leaves)).cast("int")


def _sum(c: Column) -> Column:
    # 64-bit sums would overflow; 38 digits hold 10^18 hashes
    return F.sum(c.cast(SUM)).cast(SUM)


def leaf_digests(df: DataFrame, keys: Sequence[str], columns: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """``bucket, rows, low, high`` of the rows' keys and columns; an empty bucket has no row."""
    cells = [F.col(c) for c in (*keys, *columns)]
    hashed = df.select(bucket_of(keys, leaves).alias("bucket"), row_hash(cells, 1).alias("a"), row_hash(cells, 2).alias("b"))
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), _sum(F.col("a")).alias("low"), _sum(F.col("b")).alias("high"))


def parent_digests(digests: DataFrame, fanout: int = 64) -> DataFrame:
    """The next level up: ``fanout`` neighbouring buckets in one."""
    return digests.groupBy(F.floor(F.col("bucket") / fanout).cast("int").alias("bucket")).agg(
        F.sum("rows").alias("rows"), *[F.sum(c).cast(SUM).alias(c) for c in ("low", "high")]
    )


def unequal_buckets(source: DataFrame, target: DataFrame) -> DataFrame:
    """Buckets of two digest tables of the same level that differ, with the rows of both sides."""
    sides = [d.select("bucket", F.struct("rows", "low", "high").alias(s)) for d, s in zip((source, target), SIDES)]
    both = sides[0].join(sides[1], "bucket", "full").where(~F.col("source").eqNullSafe(F.col("target")))
    return both.select("bucket", *[F.coalesce(f"{s}.rows", F.lit(0)).alias(f"{s}_rows") for s in SIDES])


def differing_keys(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], leaves: int = LEAVES,
    digests: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """``keys, status, source_rows, target_rows, columns`` of each key whose rows differ between the sides.

    ``missing`` is only in the source, ``extra`` only in the target, ``changed`` in both; ``columns`` names, in the given order, those
    whose values (as a multiset over the key's rows) differ: empty where the same values are paired otherwise, or where a key's
    whole rows are repeated. Null keys are keys. Both sides need the same types. ``digests`` may give kept leaves of a side.

    Rows of unequal buckets are summed by key with partial sums, so a key of any number of rows is one row per task
    before the shuffle; nothing is listed.
    """
    keys, columns, kept = list(keys), list(columns), dict(digests or {})
    frames = dict(zip(SIDES, (source, target)))
    leaf = {s: kept.get(s) or leaf_digests(df, keys, columns, leaves) for s, df in frames.items()}
    bad = unequal_buckets(leaf["source"], leaf["target"]).select("bucket")
    cells = [F.col(c) for c in (*keys, *columns)]

    def rows(side: str) -> DataFrame:
        hashes = {f"_h{s}": row_hash(cells, s) for s in (1, 2)} | {f"_c{i}": row_hash([F.col(c)], 3) for i, c in enumerate(columns)}
        # target hashes are taken off, so equal rows cancel out
        signed = {n: h.cast(SUM) if side == "source" else -h.cast(SUM) for n, h in hashes.items()}
        narrow = frames[side].select(
            bucket_of(keys, leaves).alias("bucket"), F.struct(*keys).alias("_key"), F.lit(side).alias("_side"), *[h.alias(n) for n, h in signed.items()]
        )
        return narrow.join(bad, "bucket", "left_semi").drop("bucket")

    both = rows("source").unionByName(rows("target"))
    sums = both.groupBy("_key").agg(
        *[F.count(F.when(F.col("_side") == s, 1)).alias(f"{s}_rows") for s in SIDES],
        *[_sum(F.col(c)).alias(c) for c in both.columns if c not in ("_key", "_side")],
    )
    status = F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("changed")
    named = F.array_compact(F.array(*[F.when(F.col(f"_c{i}") != 0, F.lit(c)) for i, c in enumerate(columns)]).cast("array<string>"))
    unlike = (F.col("source_rows") != F.col("target_rows")) | (F.col("_h1") != 0) | (F.col("_h2") != 0)
    none = F.array().cast("array<string>")
    return sums.where(unlike).select(
        "_key.*", status.alias("status"), "source_rows", "target_rows", F.when(status == "changed", named).otherwise(none).alias("columns")
    )


def difference_rows(df: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows of one side whose key is among ``found`` (see :func:`differing_keys`)."""
    return joined(df, found.select(*keys).distinct(), keys)
