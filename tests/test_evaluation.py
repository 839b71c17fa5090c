"""Calibration and retrain goldens."""

from datetime import date

import pytest

from ledgerwing.functions.scalars import wilson
from ledgerwing.operators import metrics
from ledgerwing.plans.evaluation import TrainingState, calibration_loop, calibration_report, retrain_decision
from pyspark.sql import functions as F

SCHEMA = ("ticker string, fiscal_year int, sector string, predicted_score double, predicted_direction int, "
          "actual_direction int, data_split string, status string")


def outcomes(spark, *rows):
    return spark.createDataFrame(
        [(f"T{i}", y, "s", float(s), int(s >= 0.5), a, split, "scored") for i, (y, s, a, split) in enumerate(rows)], SCHEMA)


def test_wilson(spark):
    r = spark.range(1).select(wilson(F.lit(0), F.lit(0)).alias("e"), wilson(F.lit(371), F.lit(447)).alias("w")).first()
    assert (r.e.low, r.e.high) == (0.0, 0.0)
    assert r.w.low == pytest.approx(0.7924, abs=1e-4) and r.w.high == pytest.approx(0.8620, abs=1e-4)


def test_accuracy(spark):
    df = outcomes(spark, *[(2024, 0.9, 1, "test")] * 30, *[(2024, 0.9, 0, "test")] * 10)
    r = metrics.accuracy_stat(df).first()
    assert (r.n, r.accuracy, r.small_sample) == (40, 0.75, False) and r.ci_low < 0.75 < r.ci_high
    e = metrics.accuracy_stat(df.where("false")).first()
    assert (e.n, e.accuracy, e.ci_low, e.small_sample) == (0, None, None, True)


def test_bins(spark):
    few = outcomes(spark, *[(2024, i / 50, i % 2, "test") for i in range(50)])
    flat = outcomes(spark, *[(2024, 0.5, i % 2, "test") for i in range(150)])
    assert metrics.score_calibration(few).count() == 0 and metrics.score_calibration(flat).count() == 0
    rising = outcomes(spark, *[(2024, i / 200, int(i % 10 < i // 20), "test") for i in range(200)])
    bins = metrics.score_calibration(rising).orderBy("bin").collect()
    assert sum(b.n for b in bins) == 200 and len(bins) == 10
    rates = [b.actual_rate for b in bins]
    assert rates == sorted(rates) and bins[-1].score_high == 199 / 200


def test_bin_edges_follow_comparisons(spark):
    scores = [i / 10 for i in range(11)] * 10
    lo, width = 0.0, 0.1
    want = {}
    for s in scores:
        b = next(i for i in range(9, -1, -1) if s >= lo + i * width)
        want[b + 1] = want.get(b + 1, 0) + 1
    df = outcomes(spark, *[(2024, s, 1, "test") for s in scores])
    assert {b.bin: b.n for b in metrics.score_calibration(df).collect()} == want


def test_report_separates_splits(spark):
    rows = [(2024, 0.9, 1, "test")] * 49 + [(2024, 0.1, 1, "test")] * 11 + [(2020, 0.9, 0, "train")] * 100
    r = calibration_report(outcomes(spark, *rows)).first()
    assert (r.out_of_sample_n, r.in_sample_n, r.total_scored) == (60, 100, 160)
    assert r.accuracy == pytest.approx(49 / 60) and r.in_sample_accuracy == 0.0
    assert r.realized_auc is None and len(r.warnings) == 5


STATE = TrainingState(date(2026, 6, 11), 2023, 2025, 0.726, 0.83, "m")


def decide(spark, auc, n, fresh=0):
    report = spark.createDataFrame([(auc, n)], "realized_auc double, out_of_sample_n long")
    years = [("2024", n)] + ([("2026", fresh)] if fresh else [])
    by_year = spark.createDataFrame(years, "group string, n long")
    return retrain_decision(report, by_year, STATE).first()


@pytest.mark.parametrize("auc,n,fresh,needed,n_reasons", [
    (0.726, 447, 0, False, 2), (0.60, 447, 0, True, 1), (0.726, 447, 60, True, 1),
    (0.726, 447, 13, False, 2), (0.55, 40, 0, False, 2), (0.60, 447, 60, True, 2)])
def test_decisions(spark, auc, n, fresh, needed, n_reasons):
    d = decide(spark, auc, n, fresh)
    assert d.retrain_needed is needed and d.fresh_rows == fresh and len(d.reasons) == n_reasons
    assert d.fresh_years == ([2026] if fresh else [])


def test_loop(spark):
    rows = [(2026, 0.9, i % 2, "test") for i in range(40)] + [(2024, 0.1, i % 2, "test") for i in range(70)]
    d = calibration_loop(outcomes(spark, *rows), STATE).first()
    assert d.retrain_needed and d.decayed and d.fresh_rows == 40
