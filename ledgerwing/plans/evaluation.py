"""Calibration report and retrain decision."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import accuracy_by, accuracy_struct, roc_auc

AUC_DECAY = 0.05
MIN_ROWS_FOR_DECAY = 100
MIN_FRESH_ROWS = 30
HIGH_BASE_RATE = 0.75


@dataclass(frozen=True)
class TrainingState:
    """What the deployed model was trained and evaluated on."""

    trained_at: date
    trained_through_fiscal_year: int
    evaluated_through_fiscal_year: int
    baseline_auc: float
    baseline_accuracy: float
    model_artifact: str


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def calibration_report(outcomes: DataFrame) -> DataFrame:
    """One-row report; only out-of-sample rows count as performance.

    In-sample accuracy is a labelled reference. Warnings always state the sample
    size, that the held-out rows are the model's own test rows, and how many
    in-sample rows were left out; two more depend on the data.
    """
    test, train = F.col("data_split") == "test", F.col("data_split") == "train"
    out_of_sample = outcomes.where(test)
    hit = F.col("predicted_direction") == F.col("actual_direction")
    base = outcomes.where(F.col("status") == "scored").agg(
        F.count(F.lit(1)).alias("total_scored"),
        F.count_if(test).alias("out_of_sample_n"),
        F.count_if(train).alias("in_sample_n"),
        F.count_if(test & hit).alias("_oos_hits"),
        F.count_if(train & hit).alias("_ins_hits"),
        F.array_sort(F.collect_set(F.when(test, F.col("fiscal_year")))).alias("out_of_sample_years"),
        F.avg(F.when(test, F.col("actual_direction").cast("double"))).alias("base_rate"),
    )
    report = base.withColumns(
        {
            "_oos": accuracy_struct("_oos_hits", "out_of_sample_n"),
            "_ins": accuracy_struct("_ins_hits", "in_sample_n"),
            "realized_auc": roc_auc(out_of_sample).scalar(),
        }
    )
    n_years = F.size("out_of_sample_years")
    warnings = F.array_compact(
        F.array(
            _text(
                "small sample: ", F.col("out_of_sample_n"), " out-of-sample rows over ", n_years,
                " fiscal year(s)",
            ),
            F.lit("the out-of-sample rows are the held-out test rows: agreement is no new evidence"),
            _text(F.col("in_sample_n"), " in-sample rows are excluded from every metric"),
            F.when(n_years < 2, F.lit("yearly decay cannot be assessed with one year or none")),
            F.when(
                F.col("base_rate") > HIGH_BASE_RATE,
                F.lit("class imbalance: read the AUC instead of the accuracy"),
            ),
        )
    )
    return report.select(
        "total_scored",
        "out_of_sample_n",
        "in_sample_n",
        "out_of_sample_years",
        "base_rate",
        "_oos.accuracy",
        "_oos.ci_low",
        "_oos.ci_high",
        "_oos.small_sample",
        "realized_auc",
        F.col("_ins.accuracy").alias("in_sample_accuracy"),
        F.col("_ins.ci_low").alias("in_sample_ci_low"),
        F.col("_ins.ci_high").alias("in_sample_ci_high"),
        warnings.alias("warnings"),
    )


def fresh_rows(by_year: DataFrame, evaluated_through: int) -> DataFrame:
    """Count and years of out-of-sample rows beyond the evaluated window."""
    fresh = F.col("group").cast("int") > evaluated_through
    return by_year.agg(
        F.coalesce(F.sum(F.when(fresh, F.col("n"))), F.lit(0)).alias("fresh_rows"),
        F.array_sort(F.collect_set(F.when(fresh, F.col("group").cast("int")))).alias("fresh_years"),
    )


def retrain_decision(report: DataFrame, by_year: DataFrame, state: TrainingState) -> DataFrame:
    """Retrain on decay of the AUC or on enough rows of new fiscal years.

    Decay needs at least 100 out-of-sample rows and an AUC more than 0.05 below
    the baseline; new data needs at least 30 rows. Always gives its reasons.
    """
    fresh = fresh_rows(by_year, state.evaluated_through_fiscal_year).select(
        F.struct("fresh_rows", "fresh_years").alias("f")
    )
    row = report.withColumn("_f", fresh.scalar()).select(
        "realized_auc", "out_of_sample_n", "_f.fresh_rows", "_f.fresh_years"
    )
    auc, n, new = F.col("realized_auc"), F.col("out_of_sample_n"), F.col("fresh_rows")
    enough = n >= MIN_ROWS_FOR_DECAY
    decayed = F.coalesce(
        auc.isNotNull() & enough & (auc < F.lit(state.baseline_auc) - F.lit(AUC_DECAY)),
        F.lit(False),
    )
    arrived = new >= MIN_FRESH_ROWS
    fired = decayed | arrived
    years = F.array_join(F.col("fresh_years").cast("array<string>"), ", ")
    reasons = F.array_compact(
        F.array(
            F.when(decayed, _text("decay: out-of-sample AUC fell below the baseline over ", n, " rows")),
            F.when(arrived, _text("new data: ", new, " rows in fiscal years ", years)),
            F.when(~fired & (new == 0), F.lit("no retrain: no new fiscal year has outcomes")),
            F.when(
                ~fired & (new > 0), _text("no retrain: only ", new, " new rows in ", years)
            ),
            F.when(~fired & auc.isNotNull() & ~enough, _text("decay not assessable on ", n, " rows")),
            F.when(~fired & auc.isNotNull() & enough, F.lit("AUC within tolerance of the baseline")),
        )
    )
    return row.select(
        fired.alias("retrain_needed"),
        decayed.alias("decayed"),
        reasons.alias("reasons"),
        "fresh_rows",
        "fresh_years",
        "realized_auc",
        F.lit(state.baseline_auc).alias("baseline_auc"),
    )


def calibration_loop(outcomes: DataFrame, state: TrainingState) -> DataFrame:
    """Outcomes to decision in one plan."""
    by_year = accuracy_by(outcomes.where(F.col("data_split") == "test"), "fiscal_year")
    return retrain_decision(calibration_report(outcomes), by_year, state)
