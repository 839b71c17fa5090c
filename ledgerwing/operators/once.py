"""Evaluate an expensive row expression exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Like ``withColumns``, for parses and Python functions others build on.

    Catalyst copies a projected expression into every filter and lambda that
    uses it, so a parse could run several times per row. The output of a
    generator is never copied: a one-element ``explode`` keeps the values apart
    from what is computed on them, inside the same stage.
    """
    cell = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.explode(F.array(cell)).alias("_once")).select(
        *df.columns, *[F.col(f"_once.{n}").alias(n) for n in columns]
    )
