"""The row of a given rank in each group without sorting a hot group.

A group above ``max_rows`` rows is narrowed instead: cut points of its order give the range in which the rank lies, rows below it
are counted, and only the rows inside go on, some 1/300 of them a round. Rows that tie in one column are narrowed by
the next. Each round is one aggregation with partial sums; what is left is ranked by a window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cartloom.operators.skew import MAX_GROUP_ROWS, joined
from cartloom.session import checkpoint_dir

#: Cut points of a group in one round; their ranks are exact to a tenth of a step.
STEPS = 1000


def nth_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], rank: Callable[[Column], Column], max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """One row per group: that of rank ``rank(rows of the group)``, counted from 1, in ascending ``order`` with nulls first.

    Null keys form groups. Rows equal in all of ``order`` are exchangeable. A rank outside of the group gives no row. A column that isn't a
    number can't narrow: rows that tie up to there are left to the window.

    Broadcast: one row of state per group above ``max_rows``, so at most one per ``max_rows`` input rows.
    """
    keys, order = list(keys), list(order)
    group = Window.partitionBy(*keys)

    def by_window(rows: DataFrame, want: Column) -> DataFrame:
        placed = rows.withColumn("_at", F.row_number().over(group.orderBy(*[F.col(c).asc_nulls_first() for c in order])))
        return placed.where(F.col("_at") == want).select(*df.columns)

    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > max_rows)
    hot = _kept(sizes.withColumn("_want", rank(F.col("_rows")).cast("bigint")).drop("_rows"))
    counted = df.withColumn("_rows", F.count(F.lit(1)).over(group))
    if hot.isEmpty():
        return by_window(counted, rank(F.col("_rows")))
    marked = joined(df, hot, keys, "left", small=True)
    cold = marked.where(F.col("_want").isNull()).drop("_want").withColumn("_rows", F.count(F.lit(1)).over(group))
    rows = marked.where(F.col("_want").isNotNull())
    parts = [by_window(cold, rank(F.col("_rows")))]
    for column in order:
        if rows is None or not isinstance(df.schema[column].dataType, NumericType):
            break
        small, rows = _narrowed(rows, keys, column, max_rows)
        parts.append(by_window(small, F.col("_want")))
    if rows is not None:
        parts.append(by_window(rows, F.col("_want")))
    return reduce(DataFrame.unionByName, parts)


def _kept(df: DataFrame) -> DataFrame:
    """A small table computed once, in the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _narrowed(rows: DataFrame, keys: list[str], column: str, max_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows (with ``_want``) among which the wanted rank lies by ``column``, ``_want`` counted among them: of the groups with at most
    ``max_rows`` such rows, and of the larger ones, whose rows all tie in ``column`` (None where there are none).

    A round drops both end values of a range at least, or ends in one of them, so heavy ties don't stop it.
    """
    # a double keeps the order of any number, though not every difference; NaN is above all in Spark's order
    value = F.coalesce(F.col(column).cast("double"), F.lit(float("-inf")))
    percents = F.split(F.lit(",".join(str(i / STEPS) for i in range(STEPS + 1))), ",").cast("array<double>")
    ranged = rows.withColumn("_low", F.lit(float("-inf"))).withColumn("_high", F.lit(float("nan"))).withColumn("_value", value)
    low, high, here = F.col("_low"), F.col("_high"), F.col("_value")
    inside = (here >= low) & (here <= high)
    while True:
        found = ranged.groupBy(*keys).agg(
            *[F.first(c).alias(c) for c in ("_want", "_low", "_high")],
            F.count(F.when(here < low, 1)).alias("_below"),
            F.count(F.when(inside, 1)).alias("_inside"),
            F.count(F.when(here == low, 1)).alias("_at_low"),
            F.count(F.when(here == high, 1)).alias("_at_high"),
            F.min(F.when((here > low) & (here <= high), here)).alias("_next"),
            F.max(F.when((here >= low) & (here < high), here)).alias("_previous"),
            F.percentile_approx(F.when(inside, here), percents, F.lit(10 * STEPS)).alias("_cuts"),
        ).withColumn("_nth", F.col("_want") - F.col("_below"))
        place = F.floor(F.col("_nth") * STEPS / F.col("_inside")).cast("int")
        cut = lambda i, end: F.coalesce(F.get("_cuts", place + i), end)
        first, last = F.col("_nth") <= F.col("_at_low"), F.col("_nth") > F.col("_inside") - F.col("_at_high")
        state = _kept(
            found.withColumn("_to_low", F.when(first, low).when(last, high).otherwise(F.greatest(cut(-1, low), "_next")))
            .withColumn("_to_high", F.when(first, low).when(last, high).otherwise(F.least(cut(2, high), "_previous")))
            .select(*keys, "_nth", "_inside", "_low", "_high", "_to_low", "_to_high")
        )
        large = state.where(F.col("_inside") > max_rows)
        if large.where(low < high).isEmpty():
            # the ranks of this round belong to the ranges that the rows carry
            ranks = state.select(*keys, F.col("_nth").alias("_want"), (F.col("_inside") > max_rows).alias("_large"))
            left = joined(ranged.where(inside).drop("_low", "_high", "_value", "_want"), ranks, keys, small=True)
            some = None if large.isEmpty() else left.where("_large").drop("_large")
            return left.where("not _large").drop("_large"), some
        bounds = state.select(*keys, F.col("_to_low").alias("_low"), F.col("_to_high").alias("_high"))
        ranged = joined(ranged.drop("_low", "_high"), bounds, keys, small=True)
