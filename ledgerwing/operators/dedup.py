"""Keep-latest and top-per-group operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _cols(items: Sequence[str | Column]) -> list[Column]:
    return [F.col(i) if isinstance(i, str) else i for i in items]


def top_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """The first ``n`` rows of each key by ``order``.

    ``row_number() <= n`` lets Catalyst place a group limit before the shuffle,
    so a task sends at most ``n`` rows per key however hot the key is.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def row_hash(df: DataFrame, skip: Sequence[str] = ()) -> Column:
    """Stable 64-bit digest of a row, used to break ties the same way every run."""
    return F.xxhash64(*[F.col(c) for c in df.columns if c not in skip])


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: str | Column = "ingested_at",
    tie: str | Column | None = None,
) -> DataFrame:
    """One row per key: the latest by ``order``; equal rows tie-break on a hash."""
    by = F.col(order) if isinstance(order, str) else order
    tie_break = row_hash(df) if tie is None else _cols([tie])[0]
    return top_per_key(df, keys, [by.desc_nulls_last(), tie_break.desc_nulls_last()])
