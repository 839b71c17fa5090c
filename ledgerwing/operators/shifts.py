"""Year-over-year lookups on a company-year panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window, WindowSpec


def _placed(keys: Sequence[str], year: str) -> Column:
    """A window groups NULL keys and takes NULL years for peers; a join matches neither."""
    condition = F.col(year).isNotNull()
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def _years_of(df: DataFrame, keys: Sequence[str], year: str) -> WindowSpec:
    """Rows of a key by year; a row without a place in it stands apart from all but its equals.

    Otherwise all rows with a NULL key would be one group, and so one task.
    """
    told = [F.col(name) for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    apart = F.when(~_placed(keys, year), F.xxhash64(*told))
    return Window.partitionBy(*keys, apart).orderBy(year)


def year_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    year: str,
    value: str,
    offsets: Mapping[str, int],
) -> DataFrame:
    """Add the value of the same key exactly ``offset`` years away.

    Equals one left self-join per offset on the shifted year: a gap in the years
    gives NULL, and several rows in the neighbouring year fan out. A one-year
    RANGE frame does it in a single shuffle and sort, whatever the number of
    offsets. A key holds one row per fiscal period, so a frame and a group are
    bounded by the calendar. Rows with a NULL in a key or the year have no
    neighbours and are nobody's: nothing is collected of them.
    """
    out = df
    mine = F.when(_placed(keys, year), F.struct(F.col(value).alias("v")))
    years = _years_of(df, keys, year)
    for i, (_, offset) in enumerate(offsets.items()):
        near = F.collect_list(mine).over(years.rangeBetween(offset, offset))
        out = out.withColumn(f"_n{i}", F.when(_placed(keys, year), near))
    for i, name in enumerate(offsets):
        kept = [c for c in out.columns if c != f"_n{i}"]
        out = out.select(*kept, F.explode_outer(f"_n{i}").alias("_hit"))
        out = out.withColumn(name, F.col("_hit.v")).drop("_hit")
    return out


def year_pairs(
    df: DataFrame, keys: Sequence[str], year: str, columns: Sequence[str], prefix: str = "prior_"
) -> DataFrame:
    """Add last year's values of ``columns``; needs one row per (key, year).

    Rows with a NULL in a key or the year get NULLs.
    """
    w = _years_of(df, keys, year).rangeBetween(-1, -1)
    before = F.when(_placed(keys, year), F.first(F.struct(*columns)).over(w))
    return (
        df.withColumn("_before", before)
        .select(*df.columns, *[F.col(f"_before.{c}").alias(prefix + c) for c in columns])
    )


def latest_comparable_year(df: DataFrame, key: str, year: str) -> DataFrame:
    """Latest year of each key whose previous year is present as well."""
    years = df.select(key, year).distinct()
    before = years.select(key, (F.col(year) + 1).alias(year))
    return (
        years.join(before, [key, year], "left_semi").groupBy(key).agg(F.max(year).alias(year))
    )
