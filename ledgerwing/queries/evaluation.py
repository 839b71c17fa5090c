"""Outcome statistics, calibration, retraining and training preparation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.ranked import exact_quantile
from ..plans import revenue_model as rm
from ..plans.evaluation import TrainingState, calibration_loop, calibration_report, fresh_rows
from . import standins as s
from .models import rounded
from .registry import query

_WILSON_C = "(p + 3.8416 / (2 * n)) / (1 + 3.8416 / n)"
_WILSON_H = "1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n)) / (1 + 3.8416 / n)"


def _stat(source: str, key: str = "") -> str:
    group = f"{key}, " if key else ""
    return f"""SELECT {group}n, n_correct, p AS accuracy,
        round(greatest(0, {_WILSON_C} - {_WILSON_H}), 9) AS ci_low,
        round(least(1, {_WILSON_C} + {_WILSON_H}), 9) AS ci_high, n < 30 AS small_sample
        FROM (SELECT *, CAST(n_correct AS DOUBLE) / n AS p FROM (
            SELECT {group}count(*) AS n, count(*) FILTER (correct) AS n_correct FROM {source}
            {f'GROUP BY {key}' if key else ''}))""".replace("3.8416", "3.8416::DOUBLE")


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return s.outcomes(spark, sf).where("status = 'scored'")


def held_out(spark: SparkSession, sf: str) -> DataFrame:
    return s.outcomes(spark, sf).where("data_split = 'test'")


@query(
    "classification_metrics",
    """SELECT sector, tn, fp, fn, tp, CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
        coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
        coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
        coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1
        FROM (SELECT sector, count(*) FILTER (actual_direction = 0 AND predicted_direction = 0) AS tn,
            count(*) FILTER (actual_direction = 0 AND predicted_direction = 1) AS fp,
            count(*) FILTER (actual_direction = 1 AND predicted_direction = 0) AS fn,
            count(*) FILTER (actual_direction = 1 AND predicted_direction = 1) AS tp
            FROM outcomes WHERE status = 'scored' GROUP BY sector)""",
)
def _classification(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.classification_metrics(
        scored(spark, sf), "actual_direction", "predicted_direction", by=["sector"]
    )


@query("accuracy_stat", _stat("test_rows"))
def _accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.accuracy_stat(held_out(spark, sf)), 9, "ci_low", "ci_high")


@query("accuracy_by_year", _stat("test_rows", "fiscal_year").replace("SELECT fiscal_year, n, n_correct", "SELECT CAST(fiscal_year AS VARCHAR) AS \"group\", n, n_correct"))
def _accuracy_year(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.accuracy_by(held_out(spark, sf), "fiscal_year"), 9, "ci_low", "ci_high")


@query("accuracy_by_sector", _stat("test_rows", "sector").replace("SELECT sector, n, n_correct", "SELECT sector AS \"group\", n, n_correct"))
def _accuracy_sector(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.accuracy_by(held_out(spark, sf), "sector"), 9, "ci_low", "ci_high")


def _auc(source: str, key: str = "") -> str:
    group = f"{key}, " if key else ""
    part = f"PARTITION BY {key} " if key else ""
    return f"""SELECT {group}round(sum(p * (below + n / 2.0::DOUBLE)) / nullif(CAST(sum(p) AS DOUBLE) * sum(n), 0), 9) AS auc
        FROM (SELECT *, coalesce(sum(n) OVER ({part}ORDER BY predicted_score
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
            FROM (SELECT {group}predicted_score, count(*) FILTER (actual_direction = 1) AS p,
                count(*) FILTER (actual_direction = 0) AS n FROM {source} GROUP BY ALL))
        {f'GROUP BY {key}' if key else ''}"""


@query("roc_auc", _auc("test_rows"))
def _roc(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.roc_auc(held_out(spark, sf)), 9, "auc")


@query("roc_auc_by_sector", _auc("test_rows", "sector"))
def _roc_sector(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.roc_auc(held_out(spark, sf), by=["sector"]), 9, "auc")


@query(
    "roc_auc_panel",
    _auc("(SELECT * FROM panel_outcomes WHERE data_split = 'test')"),
)
def _roc_panel(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.panel_outcomes(spark, sf).where("data_split = 'test'")
    return rounded(metrics.roc_auc(rows), 9, "auc")


@query(
    "brier",
    """SELECT fiscal_year, round(avg(pow(predicted_score - actual_direction, 2)), 9) AS brier
        FROM outcomes WHERE status = 'scored' GROUP BY fiscal_year""",
)
def _brier(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(
        metrics.brier(scored(spark, sf), "predicted_score", "actual_direction", ["fiscal_year"]), 9, "brier"
    )


@query(
    "score_calibration",
    """SELECT bin, round(lo + (bin - 1) * w, 9) AS score_low, round(CASE WHEN bin = 10 THEN hi ELSE lo + bin * w END, 9) AS score_high,
        count(*) AS n, round(avg(predicted_score), 9) AS mean_predicted_score,
        round(avg(actual_direction), 9) AS actual_rate, count(*) < 30 AS small_sample
        FROM (SELECT *, 1 + CAST(len(list_filter([1, 2, 3, 4, 5, 6, 7, 8, 9], lambda i: predicted_score >= lo + i * w)) AS INTEGER) AS bin
            FROM test_rows, (SELECT min(predicted_score) AS lo, max(predicted_score) AS hi,
                (max(predicted_score) - min(predicted_score)) / 10 AS w, count(*) AS c FROM test_rows) e
            WHERE c >= 100 AND hi > lo)
        GROUP BY bin, lo, hi, w""",
)
def _bins(spark: SparkSession, sf: str) -> DataFrame:
    bins = metrics.score_calibration(held_out(spark, sf))
    return rounded(bins, 9, "score_low", "score_high", "mean_predicted_score", "actual_rate")


@query(
    "calibration_report",
    f"""SELECT (SELECT count(*) FROM outcomes WHERE status = 'scored') AS total_scored,
        t.n AS out_of_sample_n, i.n AS in_sample_n,
        (SELECT string_agg(DISTINCT CAST(fiscal_year AS VARCHAR), ',' ORDER BY CAST(fiscal_year AS VARCHAR)) FROM test_rows) AS out_of_sample_years,
        (SELECT round(avg(actual_direction), 9) FROM test_rows) AS base_rate,
        t.accuracy, t.ci_low, t.ci_high, t.small_sample, (SELECT auc FROM ({_auc("test_rows")})) AS realized_auc,
        i.accuracy AS in_sample_accuracy, i.ci_low AS in_sample_ci_low, i.ci_high AS in_sample_ci_high,
        3 + CAST((SELECT count(DISTINCT fiscal_year) < 2 FROM test_rows) AS INTEGER)
          + CAST((SELECT avg(actual_direction) > 0.75 FROM test_rows) AS INTEGER) AS n_warnings
        FROM ({_stat("test_rows")}) t, ({_stat("(SELECT * FROM outcomes WHERE data_split = 'train')")}) i""",
)
def _report(spark: SparkSession, sf: str) -> DataFrame:
    report = calibration_report(s.outcomes(spark, sf)).withColumns(
        {
            "out_of_sample_years": F.array_join(F.col("out_of_sample_years").cast("array<string>"), ","),
            "n_warnings": F.size("warnings"),
        }
    )
    return rounded(
        report, 9, "base_rate", "ci_low", "ci_high", "realized_auc", "in_sample_ci_low", "in_sample_ci_high"
    ).drop("warnings")


STATE = TrainingState(date(2026, 1, 1), 2023, 2024, 0.60, 0.55, "stand-in")


@query(
    "retrain_decision",
    f"""SELECT decayed OR fresh_rows >= 30 AS retrain_needed, decayed, fresh_rows, fresh_years, realized_auc, 0.6::DOUBLE AS baseline_auc
        FROM (SELECT coalesce(auc < 0.6::DOUBLE - 0.05::DOUBLE AND (SELECT count(*) FROM test_rows) >= 100, false) AS decayed, auc AS realized_auc,
            (SELECT count(*) FROM test_rows WHERE fiscal_year > 2024) AS fresh_rows,
            (SELECT string_agg(DISTINCT CAST(fiscal_year AS VARCHAR), ',') FROM test_rows WHERE fiscal_year > 2024) AS fresh_years
            FROM ({_auc("test_rows")}))""",
)
def _retrain(spark: SparkSession, sf: str) -> DataFrame:
    decision = calibration_loop(s.outcomes(spark, sf), STATE).withColumn(
        "fresh_years", F.array_join(F.col("fresh_years").cast("array<string>"), ",")
    )
    return rounded(decision, 9, "realized_auc").drop("reasons")


@query(
    "fresh_rows",
    """SELECT count(*) FILTER (fiscal_year > 2023) AS fresh_rows,
        string_agg(DISTINCT CAST(fiscal_year AS VARCHAR), ',' ORDER BY CAST(fiscal_year AS VARCHAR)) AS fresh_years
        FROM test_rows""",
)
def _fresh(spark: SparkSession, sf: str) -> DataFrame:
    by_year = metrics.accuracy_by(held_out(spark, sf), "fiscal_year")
    return fresh_rows(by_year, 2023).withColumn(
        "fresh_years", F.array_join(F.col("fresh_years").cast("array<string>"), ",")
    )


@query(
    "dataset_summary",
    """SELECT CASE WHEN fiscal_year < 1999 THEN 'train' ELSE 'test' END AS name, count(*) AS n_rows,
        count(DISTINCT ticker) AS companies, min(fiscal_year) AS fiscal_year_min, max(fiscal_year) AS fiscal_year_max,
        round(avg(label), 9) AS positive_rate FROM panel
        WHERE label IS NOT NULL AND (fiscal_year < 1999 OR fiscal_year IN (1999, 2000)) GROUP BY ALL""",
)
def _summary(spark: SparkSession, sf: str) -> DataFrame:
    train, test = rm.time_split(s.panel(spark, sf).where("label is not null"), TEST_YEARS)
    both = metrics.dataset_summary(train, "train").unionByName(metrics.dataset_summary(test, "test"))
    return rounded(both, 9, "positive_rate")


TEST_YEARS, VALIDATION_YEARS = (1999, 2000), (1997, 1998)
_NUMERIC = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in rm.NUMERIC_FEATURES)
_SECTORS = ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_DUMMIES = ", ".join(f"CAST(sector = '{c}' AS INTEGER)::DOUBLE AS \"sector_{c}\"" for c in _SECTORS)
_ENCODED = f"SELECT ticker, fiscal_year, label, {_NUMERIC}, {_DUMMIES} FROM panel"


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    panel = s.panel(spark, sf)
    return rm.encode_features(panel, rm.learn_categories(panel))


query("encode_features", _ENCODED)(encoded)


@query("time_split", f"SELECT * FROM ({_ENCODED}) WHERE fiscal_year IN (1999, 2000)")
def _time_split(spark: SparkSession, sf: str) -> DataFrame:
    return rm.time_split(encoded(spark, sf), TEST_YEARS)[1]


@query(
    "inner_split",
    f"SELECT *, CASE WHEN fiscal_year IN (1997, 1998) THEN 'validation' ELSE 'fit' END AS part"
    f" FROM ({_ENCODED}) WHERE fiscal_year < 1999",
)
def _inner_split(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = rm.time_split(encoded(spark, sf), TEST_YEARS)
    fit, held = rm.inner_split(train, VALIDATION_YEARS)
    return fit.withColumn("part", F.lit("fit")).unionByName(held.withColumn("part", F.lit("validation")))


@query(
    "align_columns",
    f"""SELECT ticker, fiscal_year, label, revenue, 0.0::DOUBLE AS "sector_UNSEEN", "sector_FURNITURE", cpi_yoy FROM ({_ENCODED})""",
)
def _align(spark: SparkSession, sf: str) -> DataFrame:
    return rm.align_columns(
        encoded(spark, sf), ["revenue", "sector_UNSEEN", "sector_FURNITURE", "cpi_yoy"]
    )


@query(
    "exact_medians",
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(median(CAST({c} AS DOUBLE)), 9) AS quantile FROM panel"
        f" HAVING count({c}) > 0"
        for c in rm.NUMERIC_FEATURES
    ),
)
def _medians(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(exact_quantile(s.panel(spark, sf), rm.NUMERIC_FEATURES), 9, "quantile")


_NUMERIC_9 = ", ".join(f"round(CAST({c} AS DOUBLE), 9) AS {c}" for c in rm.NUMERIC_FEATURES)
_FILLED = {c: f"coalesce({c}, coalesce(md_{c}, 0))" for c in rm.NUMERIC_FEATURES}


@query(
    "median_impute_standardise",
    f"""SELECT ticker, fiscal_year, label, {', '.join(
        f"round(({e} - avg({e}) OVER ()) / coalesce(nullif(stddev_pop({e}) OVER (), 0), 1), 6) + 0.0::DOUBLE AS {c}"
        for c, e in _FILLED.items())}
        FROM (SELECT ticker, fiscal_year, label, {_NUMERIC_9} FROM panel),
             (SELECT {', '.join(f'median(round(CAST({c} AS DOUBLE), 9)) AS md_{c}' for c in rm.NUMERIC_FEATURES)} FROM panel) m""",
)
def _standardise(spark: SparkSession, sf: str) -> DataFrame:
    columns = rm.NUMERIC_FEATURES
    # A ratio that is the same for all rows must be so to the last bit, or its spread is noise.
    rows = rounded(encoded(spark, sf), 9, *columns)
    scaled = rm.median_impute_standardise(rows, columns, rm.fit_scaling(rows, columns))
    return scaled.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


@query(
    "majority_baseline",
    """SELECT fiscal_year, count(*) AS n, count(*) FILTER (actual_direction = 1) AS tp,
        round(avg(actual_direction), 9) AS accuracy FROM outcomes WHERE status = 'scored' GROUP BY fiscal_year""",
)
def _majority(spark: SparkSession, sf: str) -> DataFrame:
    rows = rm.majority_baseline(scored(spark, sf).drop("predicted_direction", "predicted_score"))
    found = metrics.classification_metrics(rows, "actual_direction", "predicted_direction", ["fiscal_year"])
    return rounded(
        found.select("fiscal_year", (F.col("tp") + F.col("fp")).alias("n"), "tp", "accuracy"), 9, "accuracy"
    )


def _split(spark: SparkSession, sf: str):
    rows = encoded(spark, sf).where("label is not null")
    return rm.time_split(rows, TEST_YEARS)


def _columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in rm.IDS]


@query("logistic_baseline")
def _logistic(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return rm.logistic_baseline(train, _columns(train)).score(test)


@query("boosted_trees")
def _trees(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split(spark, sf)
    return rm.boosted_trees(train, _columns(train)).score(test)


@query("tune")
def _tune(spark: SparkSession, sf: str) -> DataFrame:
    """All drawn settings on the inner split."""
    train, _ = _split(spark, sf)
    fit, held = rm.inner_split(train, VALIDATION_YEARS)
    _, results = rm.tune(fit, held, _columns(train), rm.sample_grid())
    return spark.createDataFrame(
        [(i, float(p["stepSize"]), int(p["maxDepth"]), auc) for i, (p, auc) in enumerate(results)],
        "trial int, step_size double, max_depth int, validation_auc double",
    )


@query("score_all")
def _score_all(spark: SparkSession, sf: str) -> DataFrame:
    panel = s.panel(spark, sf)
    train, _ = _split(spark, sf)
    model = rm.logistic_baseline(train, _columns(train))
    return rm.score_all(model, panel, rm.learn_categories(panel), "logistic").drop("scored_at")


# --- a linear model of stored coefficients over all columns ---------------------------
MODEL_COLUMNS = rm.feature_columns(_SECTORS)
WEIGHTS = {c: ((i * 37) % 19 - 9) / 10 for i, c in enumerate(MODEL_COLUMNS)}
INTERCEPT = 0.25
#: Rough centres and spreads, so that no feature drowns the others.
_SPREAD = {c: 10.0 ** (6 if c == "revenue" else 3 if c.endswith("count") else 1) for c in rm.NUMERIC_FEATURES}
SCALING = rm.Scaling(
    median={c: 0.5 for c in rm.NUMERIC_FEATURES},
    mean={c: 0.25 for c in MODEL_COLUMNS},
    deviation={c: _SPREAD.get(c, 1.0) for c in MODEL_COLUMNS},
)


def stored_model() -> rm.FittedModel:
    scorer = rm.LinearScorer([WEIGHTS[c] for c in MODEL_COLUMNS], INTERCEPT)
    return rm.FittedModel("stored", MODEL_COLUMNS, SCALING, scorer, False)


def _scaled_sql(column: str, value: str | None = None) -> str:
    filled = value or f'"{column}"'
    if column in rm.NUMERIC_FEATURES:
        filled = f"coalesce({filled}, 0.5::DOUBLE)"
    else:
        filled = f"coalesce({filled}, 0.0::DOUBLE)"
    return f"(({filled} - 0.25::DOUBLE) / {SCALING.deviation[column]}::DOUBLE)"


def _margin_sql(value: str = '"{c}"') -> str:
    cells = [(c, value.format(c=c, i=i)) for i, c in enumerate(MODEL_COLUMNS)]
    terms = [f"{WEIGHTS[c]}::DOUBLE * {_scaled_sql(c, cell)}" for c, cell in cells]
    return f"{INTERCEPT}::DOUBLE + " + " + ".join(terms)


@query(
    "stored_scores",
    f"""SELECT ticker, fiscal_year, round(p, 9) AS predicted_score, CAST(p >= 0.5 AS INTEGER) AS predicted_direction,
        'stored' AS model_artifact FROM (SELECT ticker, CAST(fiscal_year AS INTEGER) AS fiscal_year, 1 / (1 + exp(-({_margin_sql()}))) AS p FROM ({_ENCODED}))""",
)
def _stored_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every panel row scored by the stored model."""
    scored = rm.score_all(stored_model(), s.panel(spark, sf), _SECTORS, "stored")
    return rounded(scored.drop("scored_at"), 9, "predicted_score")


_TAKEN = 'CASE WHEN f = {i} THEN taken ELSE "{c}" END'
_RANK_SPAN = 1_000_003
_RANK = f"((CAST(substr(ticker, 2) AS BIGINT) * 31 + fiscal_year) * (7919 + 2 * f)) % {_RANK_SPAN}"


@query(
    "permutation_importance",
    f"""SELECT * FROM (WITH e AS ({_ENCODED} WHERE label IS NOT NULL),
        n AS (SELECT greatest(1, count(*) // 64) AS ranges FROM e),
        x AS (SELECT e.*, f, {_RANK} AS r FROM e, range(0, {len(MODEL_COLUMNS)}) t(f)),
        m AS (SELECT x.*, [{', '.join(f'"{c}"' for c in MODEL_COLUMNS)}] AS v, r * ranges // {_RANK_SPAN} AS part FROM x, n),
        g AS (SELECT *, v[f + 1] AS own FROM m),
        w AS (SELECT *, CASE WHEN lead(1) OVER q IS NULL THEN first_value(own) OVER (PARTITION BY f, part ORDER BY r, ticker, fiscal_year)
                ELSE lead(own) OVER q END AS taken FROM g WINDOW q AS (PARTITION BY f, part ORDER BY r, ticker, fiscal_year)),
        z AS (SELECT f, label AS actual_direction, {_margin_sql(_TAKEN)} AS predicted_score FROM w
            UNION ALL SELECT -1, label, {_margin_sql()} FROM e),
        a AS ({_auc("z", "f")})
        SELECT ([{', '.join(f"'{c}'" for c in MODEL_COLUMNS)}])[f + 1] AS feature, round(auc, 6) AS auc,
            round((SELECT auc FROM a WHERE f = -1) - auc, 6) AS importance FROM a WHERE f >= 0)""",
)
def _permutation(spark: SparkSession, sf: str) -> DataFrame:
    """All features of the stored model, permuted by an order that SQL can follow."""
    base = F.substring("ticker", 2, 20).cast("long") * 31 + F.col("fiscal_year")
    found = rm.permutation_importance(
        stored_model(),
        encoded(spark, sf),
        rank=lambda f: (base * (7919 + 2 * f)) % _RANK_SPAN,
        ranks=_RANK_SPAN,
        permuted_rows=64,
    )
    return rounded(found, 6, "auc", "importance")


@query(
    "first_order_conditions",
    f"""SELECT unnest([{', '.join(f"'{c}'" for c in rm.NUMERIC_FEATURES)}, '(intercept)']) AS feature, true AS stationary
        UNION ALL SELECT DISTINCT 'sector_' || sector, true FROM panel WHERE sector IS NOT NULL""",
)
def _first_order(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each slope of the penalised loss is nil where the logistic fit ended."""
    train, _ = _split(spark, sf)
    slopes = rm.gradient(rm.logistic_baseline(train, _columns(train)), train)
    return slopes.select("feature", (F.abs("slope") < 1e-4).alias("stationary"))


_ATTRIBUTION = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(abs({w}::DOUBLE * (\"{c}\" - m))), 9) AS importance"
    f' FROM (SELECT "{c}", avg("{c}") OVER () AS m FROM ({_ENCODED}))'
    for c, w in WEIGHTS.items()
)
_FAMILY = {c: f for f, own in rm.feature_groups(MODEL_COLUMNS).items() for c in own}
_FAMILIES = " ".join(f"WHEN '{c}' THEN '{f}'" for c, f in _FAMILY.items())


def attributions(spark: SparkSession, sf: str) -> DataFrame:
    rows = encoded(spark, sf)
    means = rows.agg(F.struct(*[F.avg(c).alias(c) for c in WEIGHTS]).alias("m")).scalar()
    return rm.linear_attribution(rows, WEIGHTS, {c: means[c] for c in WEIGHTS})


@query("linear_attribution", _ATTRIBUTION)
def _attribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(attributions(spark, sf), 9, "importance")


@query(
    "top_features",
    f"SELECT feature FROM ({_ATTRIBUTION}) ORDER BY importance DESC NULLS LAST, feature LIMIT {rm.TOP_FEATURES}",
)
def _top(spark: SparkSession, sf: str) -> DataFrame:
    return rm.top_features(rounded(attributions(spark, sf), 9, "importance")).select("feature")


@query(
    "family_share",
    f"""SELECT family, round(sum(importance), 6) AS importance, round(sum(importance) / sum(sum(importance)) OVER (), 6) AS share
        FROM (SELECT *, CASE feature {_FAMILIES} END AS family FROM ({_ATTRIBUTION})) GROUP BY family""",
)
def _family(spark: SparkSession, sf: str) -> DataFrame:
    shares = metrics.family_share(attributions(spark, sf), rm.feature_groups(MODEL_COLUMNS))
    return rounded(shares, 6, "importance", "share")
