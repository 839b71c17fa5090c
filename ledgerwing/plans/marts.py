"""Marts: profiles, filing and signal history, sector summary, outcomes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import RISK_KEYWORDS, attention_score, key_of
from ..operators.dedup import top_per_key


def company_profile(companies: DataFrame, ratios: DataFrame, filings: DataFrame) -> DataFrame:
    """One row per company: identity, latest ratios, filing activity."""
    latest = top_per_key(
        ratios.select(
            "ticker",
            "period_end_date",
            "market_cap",
            "pe_ratio",
            "gross_margin",
            "net_margin",
            "debt_to_equity",
            "roe_annualised",
            "fundamental_id",
        ),
        ["ticker"],
        [F.col("period_end_date").desc(), F.col("fundamental_id")],
    ).drop("fundamental_id")
    activity = filings.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("total_filings"), F.max("filing_date").alias("last_filing_date")
    )
    return (
        companies.join(latest, "ticker", "left")
        .join(activity, "ticker", "left")
        .select(
            "ticker",
            "cik",
            "company_name",
            "sector",
            "industry",
            F.col("period_end_date").alias("latest_fundamentals_date"),
            "market_cap",
            "pe_ratio",
            "gross_margin",
            "net_margin",
            "debt_to_equity",
            "roe_annualised",
            F.coalesce("total_filings", F.lit(0)).alias("total_filings"),
            "last_filing_date",
        )
    )


def filing_history(
    narrow: DataFrame, companies: DataFrame, keywords: Mapping[str, str] = RISK_KEYWORDS
) -> DataFrame:
    """Filings of known companies with sector and language features.

    ``narrow`` already carries the features of each filing, so there is no join
    back on the accession number.
    """
    return narrow.join(companies.select("ticker", "sector"), "ticker").select(
        "accession_number",
        "ticker",
        "sector",
        "company_name",
        "form_type",
        "filing_date",
        "document_url",
        "mdna_word_count",
        *[f"{stem}_mentions" for stem in keywords],
        "risk_word_total",
        "risk_words_per_1000",
    )


def filing_events_daily(filings: DataFrame) -> DataFrame:
    return filings.groupBy("ticker", F.col("filing_date").alias("signal_date")).agg(
        F.count(F.lit(1)).alias("filings_filed")
    )


def signal_history(
    options_flow: DataFrame, sentiment: DataFrame, filings: DataFrame, companies: DataFrame
) -> DataFrame:
    """One row per known ticker and day on which any signal fired.

    Each source has at most one row per ticker and day, so stacking the three
    and aggregating once gives the date spine and the three lookups in a single
    shuffle of already reduced rows.
    """
    none_long, none_double = F.lit(None).cast("long"), F.lit(None).cast("double")
    columns = {
        "flagged_contracts": none_long,
        "options_volume": none_long,
        "call_put_volume_ratio": none_double,
        "max_volume_oi_ratio": none_double,
        "mention_count": none_long,
        "sentiment_score": none_long,
        "filings_filed": none_long,
    }

    def part(df: DataFrame, ticker: str, day: str, **have: str) -> DataFrame:
        return df.select(
            F.col(ticker).alias("ticker"),
            F.col(day).alias("signal_date"),
            *[
                (F.col(have[c]) if c in have else empty).alias(c)
                for c, empty in columns.items()
            ],
        )

    stacked = (
        part(
            options_flow,
            "underlying",
            "activity_date",
            flagged_contracts="flagged_contracts",
            options_volume="total_volume",
            call_put_volume_ratio="call_put_volume_ratio",
            max_volume_oi_ratio="max_volume_oi_ratio",
        )
        .unionByName(
            part(
                sentiment,
                "ticker",
                "mention_date",
                mention_count="mention_count",
                sentiment_score="total_score",
            )
        )
        .unionByName(
            part(filing_events_daily(filings), "ticker", "signal_date", filings_filed="filings_filed")
        )
    )
    merged = stacked.groupBy("ticker", "signal_date").agg(*[F.max(c).alias(c) for c in columns])
    counts = [c for c in columns if c not in ("call_put_volume_ratio", "max_volume_oi_ratio")]
    filled = merged.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    return filled.join(companies.select("ticker"), "ticker").select(
        key_of("ticker", "signal_date").alias("signal_id"),
        "ticker",
        "signal_date",
        *columns,
        attention_score("max_volume_oi_ratio", "mention_count", "filings_filed").alias(
            "composite_signal_score"
        ),
    )


def sector_summary(profiles: DataFrame, signals: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per sector: members, valuation and signal activity."""
    activity = (
        signals.join(companies.select("ticker", "sector"), "ticker")
        .groupBy("sector")
        .agg(
            F.count(F.lit(1)).alias("signal_days"),
            F.sum("mention_count").alias("total_mentions"),
            F.sum("options_volume").alias("total_options_volume"),
            F.avg("composite_signal_score").alias("avg_signal_score"),
        )
    )
    members = profiles.groupBy("sector").agg(
        F.count(F.lit(1)).alias("company_count"),
        F.sum("market_cap").alias("total_market_cap"),
        F.avg("pe_ratio").alias("avg_pe_ratio"),
        F.avg("net_margin").alias("avg_net_margin"),
        F.avg("debt_to_equity").alias("avg_debt_to_equity"),
        F.sum("total_filings").alias("total_filings"),
    )
    return members.join(activity, "sector", "left")


def prediction_outcomes(
    predictions: DataFrame, panel: DataFrame, train_through: int = 2023
) -> DataFrame:
    """Predictions of panel members with their realised outcome.

    Years up to ``train_through`` are in-sample, later ones out-of-sample.
    """
    known = panel.select("ticker", "fiscal_year", "sector", "label")
    label = F.col("label")
    return predictions.join(known, ["ticker", "fiscal_year"]).select(
        key_of("ticker", "fiscal_year").alias("prediction_id"),
        "ticker",
        "fiscal_year",
        "sector",
        "predicted_score",
        "predicted_direction",
        label.alias("actual_direction"),
        (F.col("predicted_direction") == label).alias("correct"),
        F.when(label.isNull(), "pending").otherwise("scored").alias("status"),
        F.when(label.isNull(), "pending")
        .when(F.col("fiscal_year") <= train_through, "train")
        .otherwise("test")
        .alias("data_split"),
        "model_artifact",
        "scored_at",
    )
