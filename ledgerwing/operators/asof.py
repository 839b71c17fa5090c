"""As-of and next-within joins on time-bucketed keys.

Spark's DataFrame API has no as-of join. The operator below never pairs rows:
it sorts the distinct anchors of the left side together with the observations
and carries the last observation forward. Work is split by (key, time bucket),
so a hot key spreads over its buckets; what crosses a bucket border is one
carried observation per (key, bucket). Repeated anchors and repeated
observations collapse map-side before anything is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

_DAY_BUCKET = 256
_SECOND = 1_000_000
_TIME_BUCKET = 300 * _SECOND
_INT_BUCKET = 65_536


def _ticks(df: DataFrame, name: str) -> tuple[Column, int, int]:
    """(integer time axis, default bucket width, ticks per tolerance unit)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("long"), _DAY_BUCKET, 1
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name)), _TIME_BUCKET, _SECOND
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp")), _TIME_BUCKET, _SECOND
    return F.col(name).cast("long"), _INT_BUCKET, 1


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    by: Sequence[str] = (),
    payload: Sequence[str] = (),
    direction: str = "backward",
    allow_exact: bool = True,
    tolerance: int | None = None,
    bucket: int | None = None,
    prefer: str = "max",
) -> DataFrame:
    """Left join each row to the nearest earlier (or later) observation.

    Args:
        left, right: inputs; ``by`` columns carry the same names on both sides.
        left_on, right_on: time columns (date, timestamp or integer).
        payload: columns of ``right`` to add; NULL where nothing matches.
        direction: ``backward`` (latest at or before) or ``forward``.
        allow_exact: whether equal times match.
        tolerance: largest distance, in days for dates and seconds for
            timestamps.
        bucket: time-axis ticks per bucket (days, microseconds or integers).
        prefer: which payload wins among observations at one time,
            ``max`` or ``min`` of the payload columns in order.

    Rows with a NULL time or key find no match, as in an equality join.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    sign = 1 if direction == "backward" else -1
    left_t, width, unit = _ticks(left, left_on)
    right_t, right_width, _ = _ticks(right, right_on)
    if width != right_width:
        raise TypeError(f"{left_on} and {right_on} differ in type")
    width = bucket or width
    keys = [f"_k{i}" for i in range(len(by))] or ["_k0"]

    def keyed(df: DataFrame) -> list[Column]:
        return [F.col(c).alias(k) for c, k in zip(by, keys, strict=False)] or [
            F.lit(0).alias("_k0")
        ]

    pick = F.max if prefer == "max" else F.min
    found = F.struct(F.col("_t").alias("_seen"), *[F.col(c) for c in payload])
    marks = (
        left.select(*keyed(left), (left_t * sign).alias("_t")).dropna().distinct()
    )
    observations = (
        right.select(*keyed(right), (right_t * sign).alias("_t"), *payload)
        .dropna(subset=[*keys, "_t"])
        .groupBy(*keys, "_t")
        .agg(pick(found).alias("_found"))
    )
    empty = F.lit(None).cast(observations.schema["_found"].dataType)
    rows = (
        marks.withColumn("_side", F.lit(1))
        .withColumn("_found", empty)
        .unionByName(observations.withColumn("_side", F.lit(0 if allow_exact else 2)))
        .withColumn("_b", F.floor(F.col("_t") / F.lit(width)))
    )
    last_in_bucket = rows.groupBy(*keys, "_b").agg(
        F.max_by("_found", F.when(F.col("_found").isNotNull(), F.col("_t"))).alias("_last")
    )
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        last_in_bucket.select(
            *keys,
            (F.col("_b") * width).alias("_t"),
            F.lit(-1).alias("_side"),
            F.last("_last", ignorenulls=True).over(earlier).alias("_found"),
            "_b",
        )
        .where(F.col("_found").isNotNull())
        .select(*keys, "_t", "_side", "_found", "_b")
    )
    upto = (
        Window.partitionBy(*keys, "_b")
        .orderBy("_t", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        rows.select(*keys, "_t", "_side", "_found", "_b")
        .unionByName(carried)
        .withColumn("_hit", F.last("_found", ignorenulls=True).over(upto))
        .where((F.col("_side") == 1) & F.col("_hit").isNotNull())
    )
    if tolerance is not None:
        matched = matched.where(F.col("_t") - F.col("_hit._seen") <= tolerance * unit)
    matched = matched.select(*keys, F.col("_t").alias("_m"), *[f"_hit.{c}" for c in payload])
    base = left.withColumn("_anchor", left_t * sign)
    condition = base["_anchor"] == matched["_m"]
    for name, key in zip(by, keys, strict=False):
        condition = condition & (base[name] == matched[key])
    return base.join(matched, condition, "left").drop("_anchor", "_m", *keys)


def next_within(
    left: DataFrame,
    right: DataFrame,
    left_on: str,
    right_on: str,
    by: Sequence[str],
    payload: Sequence[str],
    within: int,
) -> DataFrame:
    """First observation strictly after each row, at most ``within`` later.

    Same-time observations prefer the smallest payload.
    """
    return asof_join(
        left,
        right,
        left_on,
        right_on,
        by=by,
        payload=payload,
        direction="forward",
        allow_exact=False,
        tolerance=within,
        prefer="min",
    )


def validity_ranges(df: DataFrame, key: str, on: str) -> DataFrame:
    """Add ``valid_from`` and ``valid_to`` (the next observation, open at the end).

    Expects one row per (key, time), as the staging tables give, so a key holds
    at most one row per day.
    """
    w = Window.partitionBy(key).orderBy(on)
    return df.withColumn("valid_from", F.col(on)).withColumn("valid_to", F.lead(on).over(w))


def pct_change(
    df: DataFrame, key: str, on: str, value: str, n: int = 12, out: str = "pct_change"
) -> DataFrame:
    """Change against the row ``n`` observations earlier; zero-safe.

    Counts rows, not calendar periods. Expects one row per (key, time).
    """
    before = F.lag(value, n).over(Window.partitionBy(key).orderBy(on))
    return df.withColumn(out, F.col(value) / F.nullif(before, F.lit(0.0)) - F.lit(1.0))


def in_force(
    df: DataFrame,
    observations: DataFrame,
    series: dict[str, str],
    key: str,
    on: str,
    value: str,
    anchor: str,
) -> DataFrame:
    """Left join the value of each wanted series in force on a date.

    ``series`` maps a key value to its output column. Each observation is
    repeated for the days it is in force, up to the last observed day of any
    series, and the series become columns: the range conditions turn into one
    equality join on the day. Later anchors use the last day; a row without an
    anchor gets no value. The joined table has one row per calendar day, however
    long the other side is.
    """
    wanted = observations.where(F.col(key).isin(*series))
    last_day = wanted.agg(F.max(on)).scalar()
    until = F.greatest(F.coalesce(F.date_sub("valid_to", 1), last_day), F.col("valid_from"))
    daily = validity_ranges(wanted, key, on).select(
        key,
        value,
        F.explode(F.sequence("valid_from", until, F.expr("interval 1 day"))).alias("_day"),
    )
    calendar = daily.groupBy("_day").agg(
        *[F.max(F.when(F.col(key) == s, F.col(value))).alias(out) for s, out in series.items()]
    )
    # Not least(): it skips NULLs, and a missing anchor would see the newest values.
    day = F.when(F.col(anchor) > last_day, last_day).otherwise(F.col(anchor))
    return (
        df.withColumn("_day", day)
        .join(calendar, "_day", "left")
        .drop("_day")
    )
