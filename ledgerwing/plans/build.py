"""All models of the transform graph from their raw tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions.scalars import RISK_KEYWORDS
from ..operators.quality import model_rules, run_checks
from . import intermediate, marts
from .staging import staging_views

MARTS = (
    "company_profile",
    "filing_history",
    "signal_history",
    "sector_summary",
    "ml_training_set",
    "ml_inference_set",
    "prediction_outcomes",
)


def build_models(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    path: str,
    keywords: Mapping[str, str] = RISK_KEYWORDS,
    excluded_sector: str = intermediate.EXCLUDED_SECTOR,
    annualise: float = 4.0,
    train_through: int = 2023,
) -> dict[str, DataFrame]:
    """Every staging, intermediate and mart model by name.

    Staging and intermediate models are lazy views. What several marts read is
    written under ``path`` once and read back: the filings without their text
    (the one pass over documents), the feature panel, and the marts themselves.
    """

    def written(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    m = staging_views(dict(raw))
    companies = m["stg_companies"]
    narrow = written("narrow_filings", intermediate.narrow_filings(raw["raw_filings"], keywords))
    m["int_financial_ratios"] = intermediate.financial_ratios(
        m["stg_fundamentals"], companies, annualise
    )
    m["int_filing_language_features"] = narrow.drop("company_name", "document_url", "ingested_at")
    m["int_options_flow_daily"] = intermediate.options_flow_daily(m["stg_options_activity"])
    m["int_sentiment_daily"] = intermediate.sentiment_daily(m["stg_sentiment_mentions"])
    m["int_ml_features"] = written(
        "int_ml_features",
        intermediate.ml_features(
            companies,
            m["stg_fundamentals"],
            narrow,
            m["stg_macro_observations"],
            keywords,
            excluded_sector,
            annualise,
        ),
    )
    panel = m["int_ml_features"]
    m["company_profile"] = written(
        "company_profile", marts.company_profile(companies, m["int_financial_ratios"], narrow)
    )
    m["filing_history"] = written(
        "filing_history", marts.filing_history(narrow, companies, keywords)
    )
    m["signal_history"] = written(
        "signal_history",
        marts.signal_history(
            m["int_options_flow_daily"], m["int_sentiment_daily"], narrow, companies
        ),
    )
    m["sector_summary"] = written(
        "sector_summary",
        marts.sector_summary(m["company_profile"], m["signal_history"], companies),
    )
    m["ml_training_set"] = written("ml_training_set", intermediate.training_set(panel))
    m["ml_inference_set"] = written("ml_inference_set", intermediate.inference_set(panel))
    if "stg_model_predictions" in m:
        m["prediction_outcomes"] = written(
            "prediction_outcomes",
            marts.prediction_outcomes(m["stg_model_predictions"], panel, train_through),
        )
    return m


def check_models(models: Mapping[str, DataFrame], outside_excluded: str | None = None) -> DataFrame:
    """All data-quality rules of all built models: (model, rule, failures).

    Staging and intermediate models are views, so each is read once for all of its rules.
    """
    rules = model_rules(outside_excluded) if outside_excluded else model_rules()
    results = [
        run_checks(name, models[name], rules[name], models, once=name not in MARTS)
        for name in rules if name in models
    ]
    out = results[0]
    for part in results[1:]:
        out = out.unionByName(part)
    return out
