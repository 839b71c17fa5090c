"""Prefix sums and order statistics without a single-task sort.

A running total over a whole table needs an order but no partition key. Rows are
spread over equal-count value ranges first; each range sums locally and adds the
total of the ranges before it, which is one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import written

MIN_RANGES = 64


def range_count(df: DataFrame) -> int:
    """Power of two that keeps every shuffle partition of the cluster busy."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = MIN_RANGES
    while ranges < wanted:
        ranges *= 2
    return ranges


def _cut_points(value: str, ranges: int) -> Column:
    probs = [i / ranges for i in range(1, ranges)]
    return F.percentile_approx(F.col(value), probs, 10 * ranges).alias("_cuts")


def with_range(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``_range``: the number of cut points at or below ``value``.

    Cut points are approximate, which only changes how even the ranges are. With
    ``by`` they are taken per group; this is for a handful of groups on different
    scales, such as the columns of a table, so the cut points are broadcast.
    """
    ranges = range_count(df)
    if by:
        cuts = df.groupBy(*by).agg(_cut_points(value, ranges))
        out = df.join(F.broadcast(cuts), list(by))
    else:
        out = df.withColumn("_cuts", df.select(_cut_points(value, ranges)).scalar())
    return _placed_in(out, value, ranges)


def _placed_in(out: DataFrame, value: str, ranges: int) -> DataFrame:
    """``_range`` from the cut points in ``_cuts``, which go."""
    # Binary search: each halving is one small projection.
    out = out.withColumn("_range", F.lit(0))
    step = ranges // 2
    while step:
        probe = F.get(F.col("_cuts"), F.col("_range") + F.lit(step - 1))
        out = out.withColumn(
            "_range", F.col("_range") + F.when(F.col(value) >= probe, step).otherwise(0)
        )
        step //= 2
    return out.drop("_cuts")


def prefix_sums(
    df: DataFrame,
    order: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    cuts_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``before_<v>``: the sum of ``v`` over all smaller ``order`` values.

    Expects one row per (``by``, ``order``). Groups are spread over the value
    ranges as well, so one huge group is not one task.
    """
    ranged = with_range(df, order, cuts_by)
    group = [*by, "_range"]
    totals = ranged.groupBy(*group).agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    over_ranges = (
        Window.partitionBy(*(by or [F.lit(0)]))
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *[F.col(c).alias(f"_o_{c}") for c in group],
        *[
            F.coalesce(F.sum(f"_s_{v}").over(over_ranges), F.lit(0)).alias(f"_base_{v}")
            for v in values
        ],
    )
    # One row per range, or per range of a handful of groups, can be broadcast;
    # with many groups the size decides at run time.
    if not by or list(by) == list(cuts_by):
        offsets = F.broadcast(offsets)
    condition = F.lit(True)
    for c in group:
        condition = condition & ranged[c].eqNullSafe(offsets[f"_o_{c}"])
    inside = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(offsets, condition)
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_base_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"before_{v}")
            for v in values
        ],
    )


def exact_quantile(df: DataFrame, columns: Sequence[str], p: float = 0.5) -> DataFrame:
    """Interpolated quantile of each column as rows (feature, quantile).

    NULLs and NaNs are skipped. Rows are counted per value range first; only the
    ranges that hold the quantile are counted value by value, so the values of a
    column are not shuffled and no task ever holds a whole column.
    """
    cells = (
        df.select(
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                        for c in columns
                    ]
                )
            ).alias("cell")
        )
        .select("cell.feature", "cell.value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )
    # The cut points are approximate, so they are fixed before they are used twice.
    cuts = written(cells.groupBy("feature").agg(_cut_points("value", range_count(df))), "cut-points")
    ranged = _placed_in(cells.join(F.broadcast(cuts), "feature"), "value", range_count(df))
    sizes = ranged.groupBy("feature", "_range").agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy("feature")
    sizes = sizes.select(
        F.col("feature"),
        F.col("_range"),
        "n",
        F.sum("n").over(every).alias("total"),
        F.coalesce(
            F.sum("n").over(every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("before_n"),
    )
    rank = (F.col("total") - 1) * F.lit(float(p))
    low, high = F.floor(rank), F.ceil(rank)

    def covers(position: Column) -> Column:
        return (F.col("before_n") <= position) & (position < F.col("before_n") + F.col("n"))

    # At most two ranges of a column hold its quantile; only their values are counted one by one.
    held = written(sizes.where(covers(low) | covers(high)).drop("n"), "quantile-ranges")
    counts = (
        ranged.join(F.broadcast(held), ["feature", "_range"])
        .groupBy("feature", "_range", "total", F.col("before_n").alias("_base"), "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    inside = Window.partitionBy("feature", "_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("before_n", F.col("_base") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .where(covers(low) | covers(high))
        .groupBy("feature")
        .agg(
            F.max(F.when(covers(low), F.col("value"))).alias("lo"),
            F.max(F.when(covers(high), F.col("value"))).alias("hi"),
            F.first(rank - low).alias("part"),
        )
        .select(
            "feature", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("quantile")
        )
    )


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    value: str,
    out: str,
    block: int = 4096,
    before: str | None = None,
) -> DataFrame:
    """Inclusive running sum of ``value`` by integer ``order`` within each group.

    ``before`` names a column for the sum without the row itself. A long run is cut
    into blocks of ``block`` sequence numbers; only block totals are sorted per
    group. Rows with a NULL group key are one group; rows with a NULL order come
    first in their group. NULL values add nothing. No row is lost.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    keys = [*by, "_block"]
    totals = blocked.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_o_{c}") for c in keys],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"),
    )
    condition = F.lit(True)
    for c in keys:
        condition = condition & blocked[c].eqNullSafe(offsets[f"_o_{c}"])
    rows = Window.partitionBy(*keys).orderBy(order)
    spans = {out: rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)}
    if before:
        spans[before] = rows.rowsBetween(Window.unboundedPreceding, -1)
    return blocked.join(offsets, condition).select(
        *df.columns,
        *[
            (F.col("_base") + F.coalesce(F.sum(value).over(w), F.lit(0))).alias(name)
            for name, w in spans.items()
        ],
    )
