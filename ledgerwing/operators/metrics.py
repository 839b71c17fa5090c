"""Evaluation statistics on scored rows, with NULL and empty-set rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import safe_div, wilson
from ..session import written
from .ranked import prefix_sums

SMALL_SAMPLE = 30
MIN_ROWS_FOR_BINS = 100


def _count_if(condition: Column) -> Column:
    return F.count_if(condition)


def classification_metrics(
    df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1 (0 when undefined)."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = df.groupBy(*by).agg(
        _count_if(~y & ~p).alias("tn"),
        _count_if(~y & p).alias("fp"),
        _count_if(y & ~p).alias("fn"),
        _count_if(y & p).alias("tp"),
    )
    zero = F.lit(0.0)
    precision = F.coalesce(safe_div("tp", F.col("tp") + F.col("fp")), zero)
    recall = F.coalesce(safe_div("tp", F.col("tp") + F.col("fn")), zero)
    both = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return counts.withColumns(
        {
            "accuracy": safe_div(
                F.col("tp") + F.col("tn"),
                F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"),
            ),
            "precision": precision,
            "recall": recall,
            "f1": F.coalesce(safe_div(2 * F.col("tp"), both), zero),
        }
    )


def accuracy_struct(hits: str, n: str) -> Column:
    """Accuracy, Wilson bounds and small-sample flag of two counts; NULL when empty."""
    ci = wilson(hits, n)
    some = F.col(n) > 0
    return F.struct(
        safe_div(hits, n).alias("accuracy"),
        F.when(some, ci["low"]).alias("ci_low"),
        F.when(some, ci["high"]).alias("ci_high"),
        (F.col(n) < SMALL_SAMPLE).alias("small_sample"),
    )


def accuracy_stat(
    df: DataFrame,
    predicted: str = "predicted_direction",
    actual: str = "actual_direction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Accuracy with its Wilson interval and a small-sample flag."""
    hits = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        _count_if(F.col(predicted) == F.col(actual)).alias("n_correct"),
    )
    return hits.withColumn("_s", accuracy_struct("n_correct", "n")).select(*hits.columns, "_s.*")


def accuracy_by(df: DataFrame, key: str, **columns: str) -> DataFrame:
    """Accuracy per value of ``key``, labelled and ordered as text."""
    grouped = accuracy_stat(df.withColumn("group", F.col(key).cast("string")), by=["group"], **columns)
    return grouped.orderBy("group")


def roc_auc(
    df: DataFrame, score: str = "predicted_score", label: str = "actual_direction", by: Sequence[str] = ()
) -> DataFrame:
    """Exact ROC-AUC with tied scores at mid-rank; NULL for a single class.

    Rows are reduced to distinct scores map-side; the running count of
    negatives below a score is a distributed prefix sum. The counts per score are
    written once, as the prefix sum reads them three times: rows are scored once.
    """
    per_score = (
        df.where(F.col(label).isNotNull())
        .groupBy(*by, F.col(score).alias("_score"))
        .agg(
            _count_if(F.col(label) == 1).alias("_pos"),
            _count_if(F.col(label) != 1).alias("_neg"),
        )
    )
    ranked = prefix_sums(written(per_score, "score-counts"), "_score", ["_neg"], by=by)
    won = F.sum(F.col("_pos") * (F.col("before__neg") + F.col("_neg") / F.lit(2.0)))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return ranked.groupBy(*by).agg((won / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def brier(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared difference of score and outcome."""
    return df.groupBy(*by).agg(F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0))).alias("brier"))


def score_calibration(
    df: DataFrame,
    score: str = "predicted_score",
    label: str = "actual_direction",
    n_bins: int = 10,
    min_rows: int = MIN_ROWS_FOR_BINS,
) -> DataFrame:
    """Observed rate per equal-width score bin.

    A bin is the number of lower edges ``lo + i * width`` at or below the score,
    compared edge by edge, so edge scores land as the definition says and the
    top bin is closed. Nothing is returned below ``min_rows`` or for a flat score.
    """
    span = df.agg(
        F.struct(
            F.min(score).alias("lo"), F.max(score).alias("hi"), F.count(F.lit(1)).alias("rows")
        ).alias("s")
    ).scalar()
    rows = df.select(F.col(score).alias("_s"), F.col(label).alias("_y"), span.alias("_span"))
    rows = rows.select(
        "_s", "_y", F.col("_span.lo").alias("lo"), F.col("_span.hi").alias("hi"), "_span.rows"
    ).where((F.col("rows") >= min_rows) & (F.col("hi") > F.col("lo")))
    width = (F.col("hi") - F.col("lo")) / F.lit(n_bins)
    passed: Column = F.lit(1)
    for i in range(1, n_bins):
        passed = passed + (F.col("_s") >= F.col("lo") + F.lit(i) * width).cast("int")
    return (
        rows.withColumn("bin", passed)
        .groupBy("bin", "lo", "hi")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("_s").alias("mean_predicted_score"),
            F.avg(F.col("_y").cast("double")).alias("actual_rate"),
        )
        .select(
            "bin",
            (F.col("lo") + (F.col("bin") - 1) * width).alias("score_low"),
            F.when(F.col("bin") == n_bins, F.col("hi"))
            .otherwise(F.col("lo") + F.col("bin") * width)
            .alias("score_high"),
            "n",
            "mean_predicted_score",
            "actual_rate",
            (F.col("n") < SMALL_SAMPLE).alias("small_sample"),
        )
    )


def dataset_summary(df: DataFrame, name: str) -> DataFrame:
    """Rows, companies, year span and positive rate of one slice."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("ticker").alias("companies"),
        F.min("fiscal_year").alias("fiscal_year_min"),
        F.max("fiscal_year").alias("fiscal_year_max"),
        F.avg(F.col("label").cast("double")).alias("positive_rate"),
    ).select(F.lit(name).alias("name"), "*")


def family_share(
    attributions: DataFrame, families: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Share of the summed mean absolute attribution per feature family.

    ``attributions`` has rows (feature, importance).
    """
    family: Column = F.lit("other")
    for name, members in families.items():
        if members:
            family = F.when(F.col("feature").isin(*members), F.lit(name)).otherwise(family)
    total = attributions.agg(F.sum("importance")).scalar()
    return (
        attributions.groupBy(family.alias("family"))
        .agg(F.sum("importance").alias("importance"))
        .withColumn("share", F.col("importance") / F.nullif(total, F.lit(0.0)))
    )
