"""Intermediate models: ratios, language features, daily flows, the feature panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    RISK_KEYWORDS,
    div_if_positive,
    growth,
    key_of,
    needle_count,
    safe_div,
    word_count,
)
from ..operators.asof import in_force, next_within, pct_change
from ..operators.dedup import dedup_latest, row_hash
from ..operators.shifts import year_neighbours, year_pairs
from . import staging

#: Macro series as of the anchor date and their feature names.
MACRO_FEATURES = {
    "FEDFUNDS": "fed_funds_rate",
    "T10Y2Y": "yield_curve_spread",
    "UNRATE": "unemployment_rate",
}
PRICE_SERIES = "CPIAUCSL"
FILING_WINDOW_DAYS = 180
FILING_LAG_DAYS = 90
EXCLUDED_SECTOR = "Financials"


def _ratio_columns(annualise: float) -> dict[str, Column]:
    cap = F.col("close_price") * F.col("shares_outstanding")
    yearly = F.col("net_income") * F.lit(annualise)
    return {
        "market_cap": cap,
        "gross_margin": safe_div(F.col("revenue") - F.col("cost_of_revenue"), "revenue"),
        "net_margin": safe_div("net_income", "revenue"),
        "debt_to_equity": div_if_positive("total_debt", "total_equity"),
        "liabilities_to_assets": safe_div("total_liabilities", "total_assets"),
        "pe_ratio": safe_div(cap, yearly),
        "roe_annualised": div_if_positive(yearly, "total_equity"),
    }


def financial_ratios(
    fundamentals: DataFrame, companies: DataFrame, annualise: float = 4.0
) -> DataFrame:
    """Ratios per company and period; ``annualise`` is 1 for annual input."""
    return fundamentals.join(companies.select("ticker", "sector"), "ticker", "left").select(
        "fundamental_id",
        "ticker",
        "sector",
        "fiscal_year",
        "fiscal_quarter",
        "period_end_date",
        *[c.alias(name) for name, c in _ratio_columns(annualise).items()],
    )


def _language_columns(df: DataFrame, keywords: Mapping[str, str]) -> DataFrame:
    """Add the language features; a missing section counts as empty text."""
    mdna = F.coalesce(F.col("mdna_text"), F.lit(""))
    risk = F.coalesce(F.col("risk_factors_text"), F.lit(""))
    both = F.lower(F.concat(mdna, F.lit(" "), risk))
    counted = df.withColumns(
        {
            "mdna_chars": F.length(mdna),
            "risk_factors_chars": F.length(risk),
            "mdna_word_count": word_count(mdna),
            **{f"{stem}_mentions": needle_count(both, w) for stem, w in keywords.items()},
        }
    )
    total = reduce(Column.__add__, [F.col(f"{stem}_mentions") for stem in keywords])
    return counted.withColumn("risk_word_total", total).withColumn(
        "risk_words_per_1000",
        F.col("risk_word_total") * F.lit(1000.0) / F.nullif(F.col("mdna_word_count"), F.lit(0)),
    )


def _language_names(keywords: Mapping[str, str]) -> list[str]:
    return [
        "mdna_word_count",
        *[f"{stem}_mentions" for stem in keywords],
        "risk_word_total",
        "risk_words_per_1000",
    ]


def filing_language_features(
    filings: DataFrame, keywords: Mapping[str, str] = RISK_KEYWORDS
) -> DataFrame:
    """Language features of already deduplicated filings."""
    return _language_columns(filings, keywords).select(
        "accession_number",
        "ticker",
        "form_type",
        "filing_date",
        "mdna_chars",
        "risk_factors_chars",
        *_language_names(keywords),
    )


def narrow_filings(raw: DataFrame, keywords: Mapping[str, str] = RISK_KEYWORDS) -> DataFrame:
    """Deduplicated filings with language features and without their text.

    The features depend on one row only, so they are computed where the text is
    read and the shuffle of the deduplication carries numbers instead of
    documents. The copy kept is the one the filings staging model keeps.
    """
    # The digest covers the raw row, so ties fall as in the wide model.
    tagged = _language_columns(raw.withColumn("_tie", row_hash(raw)), keywords).select(
        "accession_number",
        F.upper("ticker").alias("ticker"),
        "company_name",
        "form_type",
        "filing_date",
        "document_url",
        "ingested_at",
        "mdna_chars",
        "risk_factors_chars",
        *_language_names(keywords),
        "_tie",
    )
    return dedup_latest(tagged, ["accession_number"], tie="_tie").drop("_tie")


def options_flow_daily(activity: DataFrame) -> DataFrame:
    def volume(kind: str) -> Column:
        return F.sum(F.when(F.col("contract_type") == kind, F.col("day_volume")).otherwise(0))

    return (
        activity.groupBy("underlying", "activity_date")
        .agg(
            F.count(F.lit(1)).alias("flagged_contracts"),
            F.sum("day_volume").alias("total_volume"),
            safe_div(volume("call"), volume("put")).alias("call_put_volume_ratio"),
            F.max("volume_oi_ratio").alias("max_volume_oi_ratio"),
            F.avg("implied_volatility").alias("avg_implied_volatility"),
        )
        .select(key_of("underlying", "activity_date").alias("flow_id"), "*")
    )


def sentiment_daily(mentions: DataFrame) -> DataFrame:
    return (
        mentions.groupBy("ticker", "mention_date")
        .agg(
            F.count(F.lit(1)).alias("mention_count"),
            F.sum("score").alias("total_score"),
            F.sum("num_comments").alias("total_comments"),
            F.avg("score").alias("avg_score"),
        )
        .select(key_of("ticker", "mention_date").alias("sentiment_id"), "*")
    )


def labelled_years(years: DataFrame) -> DataFrame:
    """Add last year's growth and next year's direction to company-years.

    The label is 1 for higher revenue next year, 0 for equal or lower, and NULL
    while next year is unknown.
    """
    near = year_neighbours(
        years, ["ticker"], "fiscal_year", "revenue", {"next_revenue": 1, "prev_revenue": -1}
    )
    return near.select(
        *years.columns,
        growth("revenue", "prev_revenue").alias("revenue_growth_1y"),
        F.when(F.col("next_revenue").isNull(), None)
        .when(F.col("next_revenue") > F.col("revenue"), 1)
        .otherwise(0)
        .cast("int")
        .alias("label"),
    )


def match_annual_filings(
    years: DataFrame,
    filings: DataFrame,
    carry: Sequence[str] = (),
    within: int = FILING_WINDOW_DAYS,
) -> DataFrame:
    """Add the first annual filing after each period end, and columns it carries."""
    payload = ["filing_date", "accession_number", *carry]
    annual = filings.where(F.col("form_type") == "10-K").select("ticker", *payload)
    # The date leads the payload so that it, then the accession number, decides.
    return next_within(
        years, annual, "period_end_date", "filing_date", by=["ticker"], payload=payload, within=within
    )


def macro_in_force(df: DataFrame, macro: DataFrame, on: str) -> DataFrame:
    """Add the macro features in force on a date, with prices as yearly change."""
    features = {**MACRO_FEATURES, PRICE_SERIES: "cpi_yoy"}
    wanted = macro.where(F.col("series_id").isin(*features))
    changed = pct_change(wanted, "series_id", "observation_date", "value", 12, out="yoy")
    observations = changed.select(
        "series_id",
        "observation_date",
        F.when(F.col("series_id") == PRICE_SERIES, F.col("yoy"))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    return in_force(df, observations, features, "series_id", "observation_date", "value", on)


def ml_features(
    companies: DataFrame,
    fundamentals: DataFrame,
    filings: DataFrame,
    macro: DataFrame,
    keywords: Mapping[str, str] = RISK_KEYWORDS,
    excluded_sector: str = EXCLUDED_SECTOR,
    annualise: float = 4.0,
) -> DataFrame:
    """Feature panel per company-year with only what was known at filing time.

    Args:
        companies, fundamentals, macro: staging models.
        filings: narrow deduplicated filings with language features.
        excluded_sector: sector left out; companies without a sector go too.

    The filing date (or period end plus 90 days) anchors the macro values. The
    ratios and the language features of the matched filing travel with their row,
    so neither is joined back.
    """
    members = companies.where(F.col("sector") != excluded_sector).select("ticker", "sector")
    ratios = _ratio_columns(annualise)
    del ratios["market_cap"], ratios["pe_ratio"]
    years = fundamentals.select(
        "ticker",
        "fiscal_year",
        "period_end_date",
        "revenue",
        *[c.alias(name) for name, c in ratios.items()],
    )
    # The labels share the shuffle by ticker with the join before them.
    labelled = labelled_years(years.join(members, "ticker"))
    anchored = match_annual_filings(labelled, filings, _language_names(keywords)).withColumn(
        "anchor_date", F.coalesce("filing_date", F.date_add("period_end_date", FILING_LAG_DAYS))
    )
    panel = macro_in_force(anchored, macro, "anchor_date")
    return panel.select(
        key_of("ticker", "fiscal_year").alias("ml_row_id"),
        "ticker",
        "fiscal_year",
        "period_end_date",
        "accession_number",
        "filing_date",
        "label",
        "sector",
        "revenue",
        "revenue_growth_1y",
        "gross_margin",
        "net_margin",
        "debt_to_equity",
        "liabilities_to_assets",
        "roe_annualised",
        *_language_names(keywords),
        *MACRO_FEATURES.values(),
        "cpi_yoy",
    )


def training_set(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("label").isNotNull())


def inference_set(panel: DataFrame) -> DataFrame:
    return panel.where(F.col("label").isNull())


def company_years(panel: DataFrame, keys: DataFrame) -> DataFrame:
    """Panel rows of a list of (ticker, fiscal_year) keys, any letter case."""
    wanted = keys.select(F.upper("ticker").alias("ticker"), "fiscal_year").distinct()
    return panel.join(wanted, ["ticker", "fiscal_year"], "left_semi")


def filing_text(panel: DataFrame, raw_filings: DataFrame, keys: DataFrame) -> DataFrame:
    """Section texts of the filings that cover the wanted company-years.

    Landed rows are picked by accession number before they are deduplicated, so
    only wanted texts reach that shuffle.
    """
    picked = company_years(panel, keys).select("fiscal_year", "accession_number")
    wanted = picked.select("accession_number").distinct()
    found = staging.filings(raw_filings.join(wanted, "accession_number", "left_semi"))
    return found.join(picked, "accession_number").select(
        "ticker", "fiscal_year", "accession_number", "filing_date", "mdna_text", "risk_factors_text"
    )


def feature_deltas(panel: DataFrame, features: Sequence[str]) -> DataFrame:
    """Year-over-year change of each feature; NULL where a side is missing."""
    paired = year_pairs(panel.select("ticker", "fiscal_year", *features), ["ticker"], "fiscal_year", features)
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("feature"),
                    F.col(f"prior_{f}").cast("double").alias("prior_value"),
                    F.col(f).cast("double").alias("current_value"),
                )
                for f in features
            ]
        )
    )
    return paired.select("ticker", "fiscal_year", cells.alias("c")).select(
        "ticker",
        "fiscal_year",
        "c.*",
        (F.col("c.current_value") - F.col("c.prior_value")).alias("delta"),
    )
