"""Order-dependent steps that survive a hot key.

A plain ``Window.partitionBy(key)`` puts all rows of a key into one task. The functions here give
the same rows but split a key's rows by ranges of its order first, and join small per-range
summaries back, so one key may hold a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

#: A group above this many rows is split before it is ordered.
MAX_GROUP_ROWS = 2_000_000
#: Finest cut of one hot group.
QUANTILES = 4096


def joined(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join by keys that may be null: null matches null, as in the partitions of a window."""
    other = other.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(F.broadcast(other) if small else other, same, how).drop(*[f"_of_{k}" for k in keys])


def ranged(df: DataFrame, keys: Sequence[str], spread: Sequence[str], out: str = "_range", max_rows: int = MAX_GROUP_ROWS) -> DataFrame | None:
    """Add the range of each row within its group: 0 in groups of at most ``max_rows`` rows. None where no group is larger.

    ``spread`` names one numeric column, or an integer one and a numeric one. A larger group is cut into about
    ``rows / max_rows`` ranges at quantiles of that spread, so ranges follow its lexicographic order, and rows of equal
    spread share a range. Null in the spread comes first.

    One job counts the groups first. Then two small tables are broadcast: hot groups and
    their cut points. Both hold at most one entry per ``max_rows`` input rows (half a million entries for 10^12 rows).
    """
    keys = list(keys)
    head, tail = F.col(spread[0]).cast("double"), F.col(spread[-1]).cast("double")
    hot = (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min(head).alias("_head_low"),
            F.min(tail).alias("_tail_low"),
            F.max(tail).alias("_tail_high"),
        )
        .where(F.col("_rows") > max_rows)
    )
    if hot.isEmpty():
        return None
    fraction = (tail - F.col("_tail_low")) / (F.col("_tail_high") - F.col("_tail_low") + 1)
    place = fraction if len(spread) == 1 else head - F.col("_head_low") + fraction
    placed = (
        joined(df, hot, keys, "left", small=True)
        .withColumn("_place", F.when(F.col("_rows").isNotNull(), place))
        .drop("_head_low", "_tail_low", "_tail_high")
    )
    # one foldable literal: an array of thousands of literals would cost seconds to analyse
    percents = F.split(F.lit(",".join(str(i / QUANTILES) for i in range(1, QUANTILES))), ",").cast("array<double>")
    step = F.greatest(F.lit(1), F.floor(F.lit(float(QUANTILES * max_rows)) / F.col("_rows")).cast("int"))
    splits = (
        joined(df, hot, keys, small=True)
        .groupBy(*keys)
        .agg(
            F.percentile_approx(place, percents, F.lit(10000)).alias("_fine"),
            F.first("_rows").alias("_rows"),
        )
        .select(*keys, F.filter("_fine", lambda _, i: (i + 1) % step == 0).alias("_splits"))
    )
    here = F.col("_place")
    return (
        joined(placed.drop("_rows"), splits, keys, "left", small=True)
        .withColumn(out, F.coalesce(F.size(F.filter("_splits", lambda s: s < here)), F.lit(0)))
        .drop("_splits", "_place")
    )


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    spread: Sequence[str],
    out: str = "position",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``row_number`` over ``keys`` in ``order``.

    ``spread`` is as in :func:`ranged`; its order never contradicts ``order``. Ranges of a hot group are numbered on their
    own and shifted by the size of the earlier ones, a table of at most one entry per ``max_rows`` input rows.
    """
    keys = list(keys)
    cut = ranged(df, keys, spread, "_range", max_rows)
    if cut is None:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    return numbered_ranges(cut, keys, order, out)


def numbered_ranges(cut: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "position") -> DataFrame:
    """:func:`numbered` of rows that have their ``_range`` by :func:`ranged`."""
    keys = list(keys)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*keys, "_range").count()
    shifts = counts.withColumn("_shift", F.sum("count").over(earlier)).where(F.col("_shift") > 0).drop("count")
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    return (
        # explicit, so a partitioning by the keys alone is not reused for a hot group
        joined(cut.repartition(*keys, "_range").withColumn("_nth", F.row_number().over(within)), shifts, [*keys, "_range"], "left", small=True)
        .withColumn(out, (F.col("_nth") + F.coalesce("_shift", F.lit(0))).cast("bigint"))
        .drop("_nth", "_shift", "_range")
    )


def with_first(df: DataFrame, keys: Sequence[str], id_col: str, out: str = "first_id") -> DataFrame:
    """Add the smallest ``id_col`` of the row's group.

    Only groups of two or more rows reach the join, one row each; the big side of a hot group is
    split by the adaptive skew join because it is the streamed side of a left join.
    """
    keys = list(keys)
    repeated = (
        df.groupBy(*keys)
        .agg(F.min(id_col).alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > 1)
        .drop("_rows")
    )
    return (
        joined(df, repeated, keys, "left")
        .withColumn(out, F.coalesce("_first", F.col(id_col)))
        .drop("_first")
    )


def in_time(df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, max_rows: int) -> DataFrame | None:
    """Add ``_slice``: ranges of a hot group's ``(ts, tiebreak)`` order. A numeric tiebreak also cuts rows of one time.
    None where no group is hot."""
    timed = df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    spread = ["_us", tiebreak] if isinstance(df.schema[tiebreak].dataType, NumericType) else ["_us"]
    cut = ranged(timed, keys, spread, "_slice", max_rows)
    return None if cut is None else cut.drop("_us")


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: str,
    value: Column,
    out: str = "previous",
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """``lag(value)`` over ``keys`` in ``(ts, tiebreak)`` order, as ``struct<value>`` or null.

    A group above ``max_rows`` is ordered range by range; the first row of a range takes the last value of the
    range before from a summary of one row per hot range. Null keys are one group.
    """
    keys = list(keys)
    sliced = in_time(df.withColumn("_value", F.struct(value.alias("value"))), keys, ts, tiebreak, max_rows)
    if sliced is None:
        return df.withColumn(out, F.lag(F.struct(value.alias("value"))).over(Window.partitionBy(*keys).orderBy(ts, tiebreak)))
    carry = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max_by("_value", F.struct(ts, tiebreak)).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice")))
        .where(F.col("_carry").isNotNull())
        .drop("_last")
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(ts, tiebreak)
    return (
        joined(sliced.repartition(*keys, "_slice").withColumn("_lag", F.lag("_value").over(within)), carry, [*keys, "_slice"], "left")
        .withColumn(out, F.coalesce("_lag", "_carry"))
        .drop("_slice", "_value", "_lag", "_carry")
    )


def with_running_max(
    df: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, value: Column, out: str, max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Greatest ``value`` up to and including the row, over ``keys`` in ``(ts, tiebreak)`` order.

    Cut like :func:`with_previous`: a range adds the maximum of the group's earlier ranges.
    """
    keys = list(keys)
    sliced = in_time(df.withColumn("_value", value), keys, ts, tiebreak, max_rows)
    if sliced is None:
        plain = Window.partitionBy(*keys).orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.max(value).over(plain))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max("_value").alias("_top"))
        .withColumn("_carry", F.max("_top").over(before))
        .where(F.col("_carry").isNotNull())
        .drop("_top")
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(ts, tiebreak).rowsBetween(Window.unboundedPreceding, 0)
    return (
        joined(sliced.repartition(*keys, "_slice").withColumn("_here", F.max("_value").over(within)), carry, [*keys, "_slice"], "left")
        .withColumn(out, F.greatest("_here", "_carry"))
        .drop("_slice", "_value", "_here", "_carry")
    )
