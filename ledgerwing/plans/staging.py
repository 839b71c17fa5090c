"""Raw landing tables to staging models.

Delivery is at-least-once, so four of the tables are deduplicated to the latest
copy. Deduplication keys fold the ticker's case like the ids built from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import key_of
from ..operators.dedup import dedup_latest


def companies(raw: DataFrame) -> DataFrame:
    return raw.select(F.upper("ticker").alias("ticker"), "cik", "company_name", "sector", "industry")


def filings(raw: DataFrame) -> DataFrame:
    """Latest copy of each filing."""
    return dedup_latest(raw, ["accession_number"]).select(
        "accession_number",
        "cik",
        F.upper("ticker").alias("ticker"),
        "company_name",
        "form_type",
        "filing_date",
        "document_url",
        "mdna_text",
        "risk_factors_text",
        "ingested_at",
    )


def fundamentals(raw: DataFrame) -> DataFrame:
    ticker = F.upper("ticker")
    period = F.concat(
        F.col("fiscal_year").cast("string"), F.lit("Q"), F.col("fiscal_quarter").cast("string")
    )
    measures = [
        "revenue",
        "cost_of_revenue",
        "net_income",
        "total_assets",
        "total_liabilities",
        "total_equity",
        "total_debt",
        "shares_outstanding",
        "close_price",
    ]
    return raw.select(
        key_of(ticker, period).alias("fundamental_id"),
        ticker.alias("ticker"),
        "fiscal_year",
        "fiscal_quarter",
        "period_end_date",
        *measures,
    )


def macro_observations(raw: DataFrame) -> DataFrame:
    """Latest copy of each series and date."""
    return dedup_latest(raw, ["series_id", "observation_date"]).select(
        key_of("series_id", "observation_date").alias("macro_observation_id"),
        "series_id",
        "observation_date",
        "value",
        "ingested_at",
    )


def model_predictions(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.upper("ticker").alias("ticker"),
        "fiscal_year",
        "predicted_score",
        "predicted_direction",
        "model_artifact",
        "scored_at",
    )


def options_activity(raw: DataFrame) -> DataFrame:
    return raw.select(
        key_of("contract_ticker", "detected_at").alias("activity_id"),
        F.upper("underlying").alias("underlying"),
        "contract_ticker",
        "contract_type",
        "strike",
        "expiration",
        "day_volume",
        "open_interest",
        "volume_oi_ratio",
        "implied_volatility",
        "detected_at",
        F.to_date("detected_at").alias("activity_date"),
    )


def sentiment_mentions(raw: DataFrame) -> DataFrame:
    """Latest copy of each post and ticker."""
    return dedup_latest(raw, ["post_id", F.upper("ticker")]).select(
        key_of("post_id", F.upper("ticker")).alias("mention_id"),
        "post_id",
        "subreddit",
        F.upper("ticker").alias("ticker"),
        "title",
        "score",
        "num_comments",
        "created_at",
        F.to_date("created_at").alias("mention_date"),
        "ingested_at",
    )


def transcript_segments(raw: DataFrame) -> DataFrame:
    """Latest copy of each transcript segment."""
    return dedup_latest(raw, ["url", "segment_index"]).select(
        key_of("url", "segment_index").alias("segment_id"),
        F.col("url").alias("transcript_url"),
        F.upper("ticker").alias("ticker"),
        "company_name",
        "fiscal_year",
        "fiscal_quarter",
        "segment_index",
        "speaker",
        "role",
        "section",
        "text",
        "ingested_at",
    )


STAGING = {
    "stg_companies": ("raw_companies", companies),
    "stg_filings": ("raw_filings", filings),
    "stg_fundamentals": ("raw_fundamentals", fundamentals),
    "stg_macro_observations": ("raw_macro_observations", macro_observations),
    "stg_model_predictions": ("raw_model_predictions", model_predictions),
    "stg_options_activity": ("raw_options_activity", options_activity),
    "stg_sentiment_mentions": ("raw_sentiment_mentions", sentiment_mentions),
    "stg_transcript_segments": ("raw_transcript_segments", transcript_segments),
}


def staging_views(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All staging models whose raw table is given."""
    return {name: build(raw[src]) for name, (src, build) in STAGING.items() if src in raw}
