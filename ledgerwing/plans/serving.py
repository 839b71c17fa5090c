"""Serving snapshot and the read views on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import top_per_key
from ..operators.metrics import score_calibration
from ..sources.tables import write_json_rounded


def export_predictions(outcomes: DataFrame, profiles: DataFrame) -> DataFrame:
    """Predictions with company names, ordered by ticker and year."""
    return (
        outcomes.join(profiles.select("ticker", "company_name"), "ticker", "left")
        .select(
            "ticker",
            "company_name",
            "sector",
            "fiscal_year",
            F.col("predicted_score").alias("score"),
            "predicted_direction",
            "actual_direction",
            "correct",
            "status",
            "data_split",
        )
        .orderBy("ticker", "fiscal_year")
    )


def company_meta(panel: DataFrame, companies: DataFrame) -> DataFrame:
    """Key ratios of each company's latest year."""
    cols = ["net_margin", "debt_to_equity", "roe_annualised", "revenue_growth_1y"]
    latest = top_per_key(
        panel.select("ticker", "sector", "fiscal_year", *cols),
        ["ticker"],
        [F.col("fiscal_year").desc()],
    )
    return latest.join(companies.select("ticker", "company_name"), "ticker", "left").select(
        "ticker",
        F.coalesce("company_name", "ticker").alias("company_name"),
        "sector",
        "fiscal_year",
        *cols,
    )


def write_snapshot(
    path: str, outcomes: DataFrame, panel: DataFrame, companies: DataFrame, report: DataFrame
) -> None:
    """Write what the read views need: predictions, company ratios, calibration."""
    export_predictions(outcomes, companies).write.mode("overwrite").parquet(f"{path}/predictions")
    write_json_rounded(company_meta(panel, companies), f"{path}/company_meta")
    write_json_rounded(report, f"{path}/calibration")


#: Columns of the snapshot's JSON parts, so that empty ones can be read too.
_META = (
    "ticker string, company_name string, sector string, fiscal_year int, net_margin double, "
    "debt_to_equity double, roe_annualised double, revenue_growth_1y double"
)
_REPORT = (
    "total_scored long, out_of_sample_n long, in_sample_n long, out_of_sample_years array<int>, base_rate double, "
    "accuracy double, ci_low double, ci_high double, small_sample boolean, realized_auc double, "
    "in_sample_accuracy double, in_sample_ci_low double, in_sample_ci_high double, warnings array<string>"
)


@dataclass(frozen=True)
class Snapshot:
    """What :func:`write_snapshot` wrote."""

    predictions: DataFrame
    company_meta: DataFrame
    calibration: DataFrame


def read_snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The parts of a written snapshot."""
    return Snapshot(
        spark.read.parquet(f"{path}/predictions"),
        spark.read.schema(_META).json(f"{path}/company_meta"),
        spark.read.schema(_REPORT).json(f"{path}/calibration"),
    )


def calibration_view(snapshot: Snapshot) -> tuple[DataFrame, DataFrame]:
    """The calibration report and the observed rate per score bin of the out-of-sample predictions."""
    test = snapshot.predictions.where(F.col("data_split") == "test")
    bins = score_calibration(test, "score", "actual_direction")
    return snapshot.calibration, bins.select("bin", "n", "mean_predicted_score", "actual_rate", "small_sample")


def sector_overview(predictions: DataFrame) -> DataFrame:
    """Scores per sector, with out-of-sample accuracy where there is any.

    Both parts are one aggregation: the second only looks at test rows.
    """
    test = F.col("data_split") == "test"
    return (
        predictions.where(F.col("sector").isNotNull())
        .groupBy("sector")
        .agg(
            F.countDistinct("ticker").alias("companies"),
            F.count(F.lit(1)).alias("predictions"),
            F.avg("score").alias("mean_score"),
            F.avg(F.col("predicted_direction").cast("double")).alias("pct_up"),
            F.nullif(F.count_if(test), F.lit(0)).alias("oos_n"),
            F.avg(F.when(test, F.col("correct").cast("double"))).alias("oos_accuracy"),
        )
        .orderBy(F.col("mean_score").desc(), "sector")
    )


def company_list(predictions: DataFrame) -> DataFrame:
    """Companies for a pick list."""
    return predictions.select("ticker", "company_name").distinct().orderBy("ticker")


def ranked_screen(predictions: DataFrame) -> DataFrame:
    """Latest score of each company, best first."""
    latest = top_per_key(predictions, ["ticker"], [F.col("fiscal_year").desc()])
    return latest.orderBy(F.col("score").desc(), "ticker")


def company_history(predictions: DataFrame, ticker: str) -> DataFrame:
    """Prediction history of one company, oldest first."""
    return predictions.where(F.col("ticker") == ticker).orderBy("fiscal_year")

