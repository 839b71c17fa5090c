"""Staging, intermediate and mart models on the whole stand-in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import sector_from_sic
from ..operators.asof import asof_join, next_within, pct_change, validity_ranges
from ..operators.dedup import dedup_latest, top_per_key
from ..operators.asof import in_force
from ..operators.ranked import running_total
from ..operators.shifts import latest_comparable_year, year_neighbours, year_pairs
from ..plans import intermediate, marts, serving, staging
from ..plans.memo_checks import comparison_gaps
from . import standins as s
from .registry import query
from .standins_sql import LANGUAGE


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round what depends on the order of a floating-point sum."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "dedup_latest",
    "SELECT mention_id, post_id, subreddit, ticker, title, score, num_comments, created_at,"
    " mention_date, ingested_at FROM mentions",
)
def _dedup(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(s.mentions(spark, sf), "created_at", "ingested_at")


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) WHERE rn = 1""",
)
def _latest(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "o_totalprice"
    )
    return top_per_key(rows, ["o_custkey"], [F.col("order_date").desc(), F.col("o_orderkey").desc()])


@query("stg_companies", "SELECT ticker, cik, company_name, sector, industry FROM companies")
def _stg_companies(spark: SparkSession, sf: str) -> DataFrame:
    return s.companies(spark, sf)


@query(
    "stg_filings",
    "SELECT accession_number, cik, ticker, company_name, form_type, filing_date, document_url,"
    " mdna_text, risk_factors_text, ingested_at FROM filings",
)
def _stg_filings(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(s.filings(spark, sf), "ingested_at")


@query(
    "stg_fundamentals",
    """SELECT fundamental_id, ticker, fiscal_year, fiscal_quarter, period_end_date, revenue,
        cost_of_revenue, net_income, total_assets, total_liabilities, total_equity, total_debt,
        shares_outstanding, close_price FROM fundamentals""",
)
def _stg_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    return s.fundamentals(spark, sf)


@query(
    "raw_fundamentals",
    """SELECT ticker, fiscal_year, fiscal_quarter, period_end_date, revenue, cost_of_revenue, net_income,
        total_assets, total_liabilities, total_equity, total_debt, shares_outstanding, close_price FROM fundamentals""",
)
def _raw_fundamentals(spark: SparkSession, sf: str) -> DataFrame:
    return s.build_fundamentals(spark, sf)


@query(
    "stg_macro_observations",
    "SELECT macro_observation_id, series_id, observation_date, value, ingested_at FROM macro",
)
def _stg_macro(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(s.macro(spark, sf), "ingested_at")


@query(
    "stg_options_activity",
    """SELECT contract_ticker || '|' || detected_at AS activity_id, underlying, contract_ticker, contract_type,
        strike, expiration, day_volume, open_interest, volume_oi_ratio, implied_volatility, detected_at,
        activity_date FROM options""",
)
def _stg_options(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(s.options(spark, sf), "detected_at")


@query(
    "stg_model_predictions",
    "SELECT ticker, fiscal_year, predicted_score, predicted_direction, model_artifact, scored_at FROM predictions",
)
def _stg_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(staging.model_predictions(s.predictions(spark, sf)), "scored_at")


@query(
    "stg_transcript_segments",
    """SELECT 'call/' || conv_id || '|' || turn AS segment_id, 'call/' || conv_id AS transcript_url,
        'C' || conv_id AS ticker, 'Company ' || conv_id AS company_name, 2024 AS fiscal_year, 1 AS fiscal_quarter,
        CAST(turn AS INTEGER) AS segment_index, role AS speaker, CAST(NULL AS VARCHAR) AS role,
        CASE WHEN role = 'user' THEN 'qa' ELSE 'prepared_remarks' END AS section, text
        FROM conversations""",
)
def _stg_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.copies(s.table(spark, sf, "conversations")).select(
        s.text_of("call/", F.col("conv_id")).alias("url"),
        s.text_of("c", F.col("conv_id")).alias("ticker"),
        s.text_of("Company ", F.col("conv_id")).alias("company_name"),
        F.lit(2024).alias("fiscal_year"),
        F.lit(1).alias("fiscal_quarter"),
        F.col("turn").cast("int").alias("segment_index"),
        F.col("role").alias("speaker"),
        F.lit(None).cast("string").alias("role"),
        F.when(F.col("role") == "user", "qa").otherwise("prepared_remarks").alias("section"),
        "text",
        F.timestamp_seconds(F.col("copy")).alias("ingested_at"),
    )
    return staging.transcript_segments(rows).drop("ingested_at")


@query(
    "validity_ranges",
    "SELECT series_id, observation_date AS valid_from, next_date AS valid_to, value FROM macro_ranges",
)
def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    return validity_ranges(s.macro(spark, sf), "series_id", "observation_date").select(
        "series_id", "valid_from", "valid_to", "value"
    )


@query("pct_change_12", "SELECT series_id, observation_date, yoy FROM macro_ranges")
def _pct(spark: SparkSession, sf: str) -> DataFrame:
    changed = pct_change(s.macro(spark, sf), "series_id", "observation_date", "value", 12, "yoy")
    return changed.select("series_id", "observation_date", "yoy")


@query("financial_ratios", "SELECT * FROM ratios")
def _ratios(spark: SparkSession, sf: str) -> DataFrame:
    return intermediate.financial_ratios(s.fundamentals(spark, sf), s.companies(spark, sf))


@query(
    "financial_ratios_annual",
    """SELECT fundamental_id, CAST(close_price * shares_outstanding / nullif(net_income, 0) AS DOUBLE) AS pe_ratio,
        CASE WHEN total_equity > 0 THEN net_income / total_equity END AS roe_annualised FROM fundamentals""",
)
def _ratios_annual(spark: SparkSession, sf: str) -> DataFrame:
    ratios = intermediate.financial_ratios(s.fundamentals(spark, sf), s.companies(spark, sf), 1.0)
    return ratios.select("fundamental_id", "pe_ratio", "roe_annualised")


@query("language_features", "SELECT * FROM language")
def _language(spark: SparkSession, sf: str) -> DataFrame:
    return s.narrow_filings(spark, sf).drop("company_name", "document_url", "ingested_at")


@query(
    "options_flow_daily",
    "SELECT underlying || '|' || activity_date AS flow_id, * FROM options_flow",
)
def _flow(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(intermediate.options_flow_daily(s.options(spark, sf)), 8, "avg_implied_volatility")


@query(
    "sentiment_daily", "SELECT ticker || '|' || mention_date AS sentiment_id, * FROM sentiment"
)
def _sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(intermediate.sentiment_daily(s.mentions(spark, sf)), 8, "avg_score")


@query(
    "filing_events_daily",
    "SELECT ticker, filing_date AS signal_date, filings_filed FROM filing_days",
)
def _filing_events(spark: SparkSession, sf: str) -> DataFrame:
    return marts.filing_events_daily(s.filing_facts(spark, sf))


@query("company_profile", "SELECT * FROM profiles")
def _profile(spark: SparkSession, sf: str) -> DataFrame:
    companies = s.companies(spark, sf)
    ratios = intermediate.financial_ratios(s.fundamentals(spark, sf), companies)
    return marts.company_profile(companies, ratios, s.filing_facts(spark, sf))


@query(
    "filing_history",
    f"""SELECT f.accession_number, f.ticker, c.sector, f.company_name, f.form_type, f.filing_date,
        f.document_url, {LANGUAGE}
        FROM filings f JOIN companies c ON c.ticker = f.ticker
        LEFT JOIN language g ON g.accession_number = f.accession_number""",
)
def _filing_history(spark: SparkSession, sf: str) -> DataFrame:
    return marts.filing_history(s.narrow_filings(spark, sf), s.companies(spark, sf), s.KEYWORDS)


def signals(spark: SparkSession, sf: str) -> DataFrame:
    return marts.signal_history(
        intermediate.options_flow_daily(s.options(spark, sf)),
        intermediate.sentiment_daily(s.mentions(spark, sf)),
        s.filing_facts(spark, sf),
        s.companies(spark, sf),
    )


query("signal_history", "SELECT * FROM signals")(signals)


@query(
    "sector_summary",
    """SELECT p.sector, p.company_count, p.total_market_cap, p.avg_pe_ratio, p.avg_net_margin,
            p.avg_debt_to_equity, p.total_filings, x.signal_days, x.total_mentions, x.total_options_volume,
            x.avg_signal_score
        FROM (SELECT sector, count(*) AS company_count, round(sum(market_cap), 2) AS total_market_cap,
                  round(avg(pe_ratio), 6) AS avg_pe_ratio, round(avg(net_margin), 8) AS avg_net_margin,
                  round(avg(debt_to_equity), 6) AS avg_debt_to_equity,
                  CAST(sum(total_filings) AS BIGINT) AS total_filings
              FROM profiles GROUP BY sector) p
        LEFT JOIN (SELECT sector, count(*) AS signal_days, CAST(sum(mention_count) AS BIGINT) AS total_mentions,
                  CAST(sum(options_volume) AS BIGINT) AS total_options_volume,
                  round(avg(composite_signal_score), 8) AS avg_signal_score
              FROM signals JOIN companies USING (ticker) GROUP BY sector) x ON x.sector = p.sector""",
)
def _sector_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = marts.sector_summary(
        _profile(spark, sf), signals(spark, sf), s.companies(spark, sf)
    )
    summary = rounded(summary, 6, "avg_pe_ratio", "avg_debt_to_equity")
    summary = rounded(summary, 8, "avg_net_margin", "avg_signal_score")
    return rounded(summary, 2, "total_market_cap")


@query("year_shift_label", "SELECT * FROM labelled")
def _labels(spark: SparkSession, sf: str) -> DataFrame:
    years = s.fundamentals(spark, sf).select(
        "fundamental_id", "ticker", "fiscal_year", "period_end_date", "revenue"
    )
    return intermediate.labelled_years(years)


@query(
    "match_next_within",
    """SELECT fundamental_id, period_end_date, m.accession_number, m.filing_date
        FROM labelled LEFT JOIN matched m USING (fundamental_id)""",
)
def _next_within(spark: SparkSession, sf: str) -> DataFrame:
    years = s.fundamentals(spark, sf).select("fundamental_id", "ticker", "period_end_date")
    return intermediate.match_annual_filings(years, s.filing_facts(spark, sf)).drop("ticker")


@query(
    "asof_keyed",
    """SELECT p.event_id, p.user_id, e.event_id AS error_id, e.value AS error_value
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'error') e
            ON p.user_id = e.user_id AND p.ts >= e.ts""",
)
def _asof_keyed(spark: SparkSession, sf: str) -> DataFrame:
    events = s.table(spark, sf, "events")
    errors = events.where(F.col("event_type") == "error").select(
        "user_id",
        F.col("ts").alias("error_ts"),
        F.col("event_id").alias("error_id"),
        F.col("value").alias("error_value"),
    )
    joined = asof_join(
        events.where(F.col("event_type") == "purchase"),
        errors,
        "ts",
        "error_ts",
        by=["user_id"],
        payload=["error_id", "error_value"],
    )
    return joined.select("event_id", "user_id", "error_id", "error_value")


@query(
    "asof_keyless",
    """SELECT p.event_id, e.event_id AS seen_id
        FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') e ON p.ts >= e.ts""",
)
def _asof_keyless(spark: SparkSession, sf: str) -> DataFrame:
    events = s.table(spark, sf, "events").select("event_id", "ts", "event_type")
    seen = events.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("seen_id"), F.col("ts").alias("seen_ts")
    )
    left = events.where(F.col("event_type") == "purchase")
    return asof_join(left, seen, "ts", "seen_ts", payload=["seen_id"]).select("event_id", "seen_id")


@query(
    "next_event_within",
    """SELECT p.event_id, CASE WHEN epoch_us(e.ts) - epoch_us(p.ts) <= 86400000000 THEN e.event_id END AS next_id
        FROM (SELECT * FROM events WHERE event_type = 'view') p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') e
            ON p.user_id = e.user_id AND p.ts < e.ts""",
)
def _next_event(spark: SparkSession, sf: str) -> DataFrame:
    events = s.table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    clicks = events.where(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("next_id"), F.col("ts").alias("click_ts")
    )
    views = events.where(F.col("event_type") == "view")
    return next_within(
        views, clicks, "ts", "click_ts", by=["user_id"], payload=["next_id"], within=86_400
    ).select("event_id", "next_id")


@query("ml_features", "SELECT * FROM panel")
def _ml_features(spark: SparkSession, sf: str) -> DataFrame:
    return s.build_panel(spark, sf)


@query("training_set", "SELECT * FROM panel WHERE label IS NOT NULL")
def _training(spark: SparkSession, sf: str) -> DataFrame:
    return intermediate.training_set(s.panel(spark, sf))


@query("inference_set", "SELECT * FROM panel WHERE label IS NULL")
def _inference(spark: SparkSession, sf: str) -> DataFrame:
    return intermediate.inference_set(s.panel(spark, sf))


@query(
    "company_year_lookup",
    """SELECT p.ticker, p.fiscal_year, p.accession_number, p.revenue, p.net_margin FROM panel p
        WHERE (p.ticker, p.fiscal_year) IN (SELECT 'C' || o_custkey, year(o_orderdate) FROM orders
            WHERE o_orderstatus = 'P')""",
)
def _company_years(spark: SparkSession, sf: str) -> DataFrame:
    keys = s.table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(
        s.text_of("c", F.col("o_custkey")).alias("ticker"), F.year("o_orderdate").alias("fiscal_year")
    )
    return intermediate.company_years(s.panel(spark, sf), keys).select(
        "ticker", "fiscal_year", "accession_number", "revenue", "net_margin"
    )


@query(
    "filing_text_lookup",
    """SELECT f.ticker, p.fiscal_year, f.accession_number, f.filing_date, f.mdna_text, f.risk_factors_text
        FROM panel p JOIN filings f USING (accession_number)""",
)
def _filing_text(spark: SparkSession, sf: str) -> DataFrame:
    panel = s.panel(spark, sf)
    return intermediate.filing_text(panel, s.raw_filings(spark, sf), panel.select("ticker", "fiscal_year"))


@query(
    "latest_comparable_year",
    """WITH y AS (SELECT DISTINCT ticker, year(filing_date) AS fiscal_year FROM filings
            WHERE form_type = '10-K' AND mdna_text IS NOT NULL AND risk_factors_text IS NOT NULL)
        SELECT ticker, CAST(max(fiscal_year) AS INTEGER) AS fiscal_year FROM y
        WHERE EXISTS (SELECT 1 FROM y p WHERE p.ticker = y.ticker AND p.fiscal_year = y.fiscal_year - 1)
        GROUP BY ticker""".replace("WITH y AS", "SELECT * FROM (WITH y AS", 1) + ")",
)
def _comparable(spark: SparkSession, sf: str) -> DataFrame:
    both = F.col("mdna_text").isNotNull() & F.col("risk_factors_text").isNotNull()
    raw = s.raw_filings(spark, sf).withColumn("has_text", both).drop("mdna_text", "risk_factors_text")
    filings = dedup_latest(raw, ["accession_number"])
    years = filings.where("has_text and form_type = '10-K'").select(
        "ticker", F.year("filing_date").alias("fiscal_year")
    )
    return latest_comparable_year(years, "ticker", "fiscal_year")


DELTA_FEATURES = ("revenue", "net_margin", "risk_word_total", "risk_words_per_1000")


@query(
    "feature_deltas",
    " UNION ALL ".join(
        f"""SELECT c.ticker, c.fiscal_year, '{f}' AS feature, CAST(p.{f} AS DOUBLE) AS prior_value,
            CAST(c.{f} AS DOUBLE) AS current_value, CAST(c.{f} AS DOUBLE) - CAST(p.{f} AS DOUBLE) AS delta
            FROM panel c LEFT JOIN panel p ON p.ticker = c.ticker AND p.fiscal_year = c.fiscal_year - 1"""
        for f in DELTA_FEATURES
    ),
)
def _deltas(spark: SparkSession, sf: str) -> DataFrame:
    return intermediate.feature_deltas(s.panel(spark, sf), DELTA_FEATURES)


@query("prediction_outcomes", "SELECT * FROM panel_outcomes")
def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return ntz(s.panel_outcomes(spark, sf), "scored_at")


@query(
    "sector_from_sic",
    """SELECT p_partkey, CASE
        WHEN code BETWEEN 100 AND 999 THEN 'Agriculture' WHEN code BETWEEN 1000 AND 1499 THEN 'Mining & Energy'
        WHEN code BETWEEN 1500 AND 1799 THEN 'Construction' WHEN code BETWEEN 2000 AND 3999 THEN 'Manufacturing'
        WHEN code BETWEEN 4000 AND 4999 THEN 'Transportation & Utilities'
        WHEN code BETWEEN 5000 AND 5199 THEN 'Wholesale Trade' WHEN code BETWEEN 5200 AND 5999 THEN 'Retail Trade'
        WHEN code BETWEEN 6000 AND 6799 THEN 'Financials' WHEN code BETWEEN 7000 AND 8999 THEN 'Services'
        WHEN code BETWEEN 9100 AND 9999 THEN 'Public Administration' ELSE 'Unknown' END AS sector
        FROM (SELECT p_partkey, CASE p_partkey % 9 WHEN 7 THEN NULL WHEN 8 THEN NULL ELSE (p_partkey * 37) % 10000 END AS code
              FROM part)""",
)
def _sic(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    code = (
        F.when(key % 9 == 7, F.lit("n/a")).when(key % 9 == 8, None).otherwise(((key * 37) % 10000).cast("string"))
    )
    return s.table(spark, sf, "part").select("p_partkey", sector_from_sic(code).alias("sector"))


@query(
    "sector_overview",
    """SELECT sector, count(DISTINCT ticker) AS companies, count(*) AS predictions,
        round(avg(predicted_score), 8) AS mean_score, round(avg(predicted_direction), 8) AS pct_up,
        nullif(count(*) FILTER (data_split = 'test'), 0) AS oos_n,
        round(avg(CASE WHEN data_split = 'test' THEN CAST(correct AS INTEGER) END), 8) AS oos_accuracy
        FROM panel_outcomes GROUP BY sector""",
)
def _overview(spark: SparkSession, sf: str) -> DataFrame:
    predictions = s.panel_outcomes(spark, sf).withColumnRenamed("predicted_score", "score")
    return rounded(serving.sector_overview(predictions), 8, "mean_score", "pct_up", "oos_accuracy")


def exported(spark: SparkSession, sf: str) -> DataFrame:
    return serving.export_predictions(s.panel_outcomes(spark, sf), s.companies(spark, sf))


query(
    "export_predictions",
    """SELECT p.ticker, c.company_name, p.sector, p.fiscal_year, p.predicted_score AS score, p.predicted_direction,
        p.actual_direction, p.correct, p.status, p.data_split
        FROM panel_outcomes p LEFT JOIN companies c USING (ticker)""",
)(exported)


@query(
    "ranked_screen",
    """SELECT ticker, fiscal_year, score, status FROM (
        SELECT ticker, fiscal_year, predicted_score AS score, status,
               row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM panel_outcomes)
        WHERE rn = 1""",
)
def _screen(spark: SparkSession, sf: str) -> DataFrame:
    return serving.ranked_screen(exported(spark, sf)).select("ticker", "fiscal_year", "score", "status")


@query(
    "company_list",
    "SELECT DISTINCT ticker, company_name FROM panel_outcomes JOIN companies USING (ticker)",
)
def _company_list(spark: SparkSession, sf: str) -> DataFrame:
    return serving.company_list(exported(spark, sf))


@query(
    "company_meta",
    """SELECT ticker, coalesce(company_name, ticker) AS company_name, sector, fiscal_year,
        round(net_margin, 4) AS net_margin, round(debt_to_equity, 4) AS debt_to_equity,
        round(roe_annualised, 4) AS roe_annualised, round(revenue_growth_1y, 4) AS revenue_growth_1y
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM panel)
        LEFT JOIN (SELECT ticker, company_name FROM companies) USING (ticker) WHERE rn = 1""",
)
def _company_meta(spark: SparkSession, sf: str) -> DataFrame:
    meta = serving.company_meta(s.panel(spark, sf), s.companies(spark, sf))
    return rounded(meta, 4, "net_margin", "debt_to_equity", "roe_annualised", "revenue_growth_1y")


@query(
    "comparison_gaps",
    """SELECT ticker, fiscal_year,
        CASE WHEN now IS NULL THEN 'current-year filing text unavailable; ' ELSE '' END ||
        CASE WHEN prior IS NULL THEN 'prior-year filing text unavailable; ' ELSE '' END || 'no comparison performed' AS gaps
        FROM (SELECT *, CASE WHEN lag(fiscal_year) OVER w = fiscal_year - 1 THEN lag(now) OVER w END AS prior
            FROM (SELECT y.ticker, y.fiscal_year, min(f.filing_date || '~' || f.accession_number) AS now
                FROM fundamentals y JOIN companies c ON c.ticker = y.ticker AND c.sector <> 'BUILDING'
                LEFT JOIN filings f ON f.ticker = y.ticker AND f.form_type = '10-K'
                    AND f.filing_date > y.period_end_date AND f.filing_date <= y.period_end_date + 180
                GROUP BY y.ticker, y.fiscal_year)
            WINDOW w AS (PARTITION BY ticker ORDER BY fiscal_year))
        WHERE now IS NULL OR prior IS NULL""",
)
def _comparison_gaps(spark: SparkSession, sf: str) -> DataFrame:

    pairs = year_pairs(
        s.panel(spark, sf).select("ticker", "fiscal_year", "accession_number"),
        ["ticker"],
        "fiscal_year",
        ["accession_number"],
        prefix="prior_",
    ).select(
        "ticker",
        "fiscal_year",
        F.col("accession_number").alias("current_accession"),
        F.col("prior_accession_number").alias("prior_accession"),
    )
    return comparison_gaps(pairs).select(
        "ticker", "fiscal_year", F.array_join("gaps", "; ").alias("gaps")
    )


# --- missing keys, years, anchors and sequence numbers -------------------------------
_GAPPY = """(SELECT o_orderkey, CASE WHEN o_custkey % 6 <> 0 THEN o_custkey END AS owner,
    CASE WHEN o_orderkey % 5 <> 0 THEN year(o_orderdate) END AS y,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS anchor,
    CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS seq,
    CASE WHEN o_orderkey % 10 <> 0 THEN floor(o_totalprice) ELSE 1 END AS v FROM orders)"""


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose owner, year, date or sequence number is missing now and then."""
    key = F.col("o_orderkey")
    return s.table(spark, sf, "orders").select(
        key,
        F.when(F.col("o_custkey") % 6 != 0, F.col("o_custkey")).alias("owner"),
        F.when(key % 5 != 0, F.year("o_orderdate")).alias("y"),
        F.when(key % 5 != 0, F.to_date("o_orderdate")).alias("anchor"),
        F.when(key % 10 != 0, key).alias("seq"),
        F.when(key % 10 != 0, F.floor("o_totalprice")).otherwise(1).cast("double").alias("v"),
    )


@query(
    "in_force_missing_anchor",
    f"""SELECT o_orderkey, m.value AS rate FROM {_GAPPY} g LEFT JOIN macro_ranges m ON m.series_id = 'FEDFUNDS'
        AND g.anchor >= m.observation_date AND (m.next_date IS NULL OR g.anchor < m.next_date)""",
)
def _in_force_missing(spark: SparkSession, sf: str) -> DataFrame:
    series = {"FEDFUNDS": "rate"}
    rows = in_force(gappy(spark, sf), s.macro(spark, sf), series, "series_id", "observation_date", "value", "anchor")
    return rows.select("o_orderkey", "rate")


@query(
    "year_neighbours_missing_keys",
    f"""SELECT c.o_orderkey, c.owner, c.y, n.v AS next_v FROM {_GAPPY} c
        LEFT JOIN {_GAPPY} n ON n.owner = c.owner AND n.y = c.y + 1""",
)
def _neighbours_missing(spark: SparkSession, sf: str) -> DataFrame:
    rows = year_neighbours(gappy(spark, sf), ["owner"], "y", "v", {"next_v": 1})
    return rows.select("o_orderkey", "owner", "y", "next_v")


@query(
    "year_pairs_missing_keys",
    f"""WITH_ROWS c.owner, c.y, c.v, p.v AS prior_v FROM t c LEFT JOIN t p ON p.owner = c.owner AND p.y = c.y - 1""".replace(
        "WITH_ROWS", f"SELECT * FROM (WITH t AS (SELECT owner, y, max(v) AS v FROM {_GAPPY} GROUP BY ALL) SELECT"
    )
    + ")",
)
def _pairs_missing(spark: SparkSession, sf: str) -> DataFrame:
    rows = gappy(spark, sf).groupBy("owner", "y").agg(F.max("v").alias("v"))
    return year_pairs(rows, ["owner"], "y", ["v"])


@query(
    "running_total_missing_keys",
    f"""SELECT run, seq, sum(v) OVER (PARTITION BY run ORDER BY seq NULLS FIRST ROWS UNBOUNDED PRECEDING) AS so_far,
        coalesce(sum(v) OVER (PARTITION BY run ORDER BY seq NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM (SELECT owner % 50 AS run, seq, CAST(v AS DOUBLE) AS v FROM {_GAPPY})""",
)
def _running_missing(spark: SparkSession, sf: str) -> DataFrame:
    rows = gappy(spark, sf).select((F.col("owner") % 50).alias("run"), "seq", "v")
    return running_total(rows, ["run"], "seq", "v", "so_far", before="before").drop("v")
