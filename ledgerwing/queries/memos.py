"""Memo ledgers and checks on the whole driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import memo_checks as mc
from ..contracts import EVENT_STREAMS
from ..operators.dedup import dedup_latest
from ..streaming.events import TOPICS, serialise
from . import standins as s
from .feeds import _judge
from .models import rounded
from .registry import query

METRICS = ("revenue", "revenue_growth_1y", "net_margin", "debt_to_equity")


def costed(spark: SparkSession, sf: str) -> DataFrame:
    return mc.call_cost(s.ledger(spark, sf), mc.price_table(spark, s.PRICES))


@query(
    "call_cost",
    """SELECT run_id, seq, model, agent_name, ticker, input_tokens, output_tokens, cache_creation_input_tokens,
        cache_read_input_tokens, round(cost_usd, 9) AS cost_usd FROM costed""",
)
def _cost(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(costed(spark, sf), 9, "cost_usd")


@query(
    "cost_summary",
    """SELECT agent_name, ticker, CAST(grouping_id(agent_name, ticker) AS INTEGER) AS level, count(*) AS calls,
        round(sum(cost_usd), 8) AS cost_usd FROM costed GROUP BY ROLLUP (agent_name, ticker)""",
)
def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(mc.cost_summary(costed(spark, sf)), 8, "cost_usd")


@query("unpriced_models", "SELECT DISTINCT model FROM ledger WHERE model = 'small'")
def _unpriced(spark: SparkSession, sf: str) -> DataFrame:
    return mc.unpriced_models(s.ledger(spark, sf), mc.price_table(spark, {"large": (10.0, 50.0)}))


@query(
    "spend_cap_breaches",
    """SELECT run_id, seq, round(before, 8) AS spent_before FROM (
        SELECT *, coalesce(sum(cost_usd) OVER (PARTITION BY run_id ORDER BY seq
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM costed)
        WHERE before + 0.004123457 > 0.006""",
)
def _caps(spark: SparkSession, sf: str) -> DataFrame:
    calls = costed(spark, sf).withColumn("projected_cost", F.lit(0.004123457))
    breaches = mc.spend_cap_breaches(calls, 0.006)
    return rounded(breaches.select("run_id", "seq", "spent_before"), 8, "spent_before")


def _call(price_in: str, price_out: str, tokens: str, out: int) -> str:
    return f"(({tokens}) * {price_in} + {out} * {price_out}) / 1e6"


@query(
    "project_batch_cost",
    f"""SELECT accession_number, a AS current_tokens, b AS prior_tokens,
        round({_call("10", "50", "500 + a", 4000)} + {_call("10", "50", "1250 + a + b", 4000)}
            + {_call("10", "50", "1250", 2000)} + {_call("10", "50", "10500", 8000)}
            + {_call("5", "25", "4500 + a + b", 1500)}, 8) AS projected_cost_usd
        FROM (SELECT n.accession_number, coalesce(n.t, 0) AS a, coalesce(p.t, 0) AS b
            FROM (SELECT accession_number, doc_id, (coalesce(length(mdna_text), 0) + coalesce(length(risk_factors_text), 0)) // 4 AS t
                FROM (SELECT *, CAST(substr(accession_number, 2) AS BIGINT) AS doc_id FROM filings)) n
            LEFT JOIN (SELECT (coalesce(length(mdna_text), 0) + coalesce(length(risk_factors_text), 0)) // 4 AS t,
                CAST(substr(accession_number, 2) AS BIGINT) AS doc_id FROM filings) p ON p.doc_id = n.doc_id - 1)""",
)
def _project(spark: SparkSession, sf: str) -> DataFrame:
    """The filing numbered one lower stands for the prior year's."""
    rows = dedup_latest(mc.estimate_tokens(s.raw_filings(spark, sf)), ["accession_number"])
    number = F.substring("accession_number", 2, 20).cast("long")
    now = rows.select("accession_number", number.alias("n"), F.col("tokens").alias("current_tokens"))
    prior = now.select((F.col("n") + 1).alias("n"), F.col("current_tokens").alias("prior_tokens"))
    years = now.join(prior, "n", "left")
    costs = mc.project_batch_cost(years, (10.0, 50.0), (5.0, 25.0))
    return rounded(
        costs.select("accession_number", "current_tokens", "prior_tokens", "projected_cost_usd"),
        8,
        "projected_cost_usd",
    )


def statements(spark: SparkSession, sf: str) -> DataFrame:
    """Two statements per panel row; every third year misquotes, some cite NULL."""
    year = F.col("fiscal_year")
    echoed = F.col("net_margin") * F.when(year % 3 == 0, 1.002).otherwise(1.0001)
    cells = F.array(
        F.struct(F.lit("net_margin").alias("source_metric"), echoed.alias("metric_value")),
        F.struct(
            F.lit("debt_to_equity").alias("source_metric"),
            F.when(year % 2 == 0, F.coalesce("debt_to_equity", F.lit(1.0)))
            .otherwise(F.col("debt_to_equity"))
            .alias("metric_value"),
        ),
        F.struct(F.lit("no_such_metric").alias("source_metric"), F.when(year == 1997, 1.0).alias("metric_value")),
    )
    rows = s.panel(spark, sf).select("ticker", "fiscal_year", F.explode(cells).alias("c"))
    return rows.select("ticker", "fiscal_year", "c.*")


@query(
    "grounding_warnings",
    """SELECT ticker, fiscal_year, 'net_margin' AS source_metric FROM panel
            WHERE fiscal_year % 3 = 0 AND abs(net_margin * 0.002) > greatest(1e-3 * abs(net_margin * 1.002), 1e-6)
        UNION ALL SELECT ticker, fiscal_year, 'debt_to_equity' FROM panel WHERE fiscal_year % 2 = 0 AND debt_to_equity IS NULL
        UNION ALL SELECT ticker, fiscal_year, 'no_such_metric' FROM panel WHERE fiscal_year = 1997""",
)
def _grounding(spark: SparkSession, sf: str) -> DataFrame:
    found = mc.grounding_warnings(statements(spark, sf), s.panel(spark, sf), METRICS)
    return found.select("ticker", "fiscal_year", "source_metric")


@query(
    "traceability_warnings",
    """SELECT doc_id, i AS finding FROM documents CROSS JOIN (VALUES (1), (2)) v(i)""",
)
def _traceability(spark: SparkSession, sf: str) -> DataFrame:
    """Per document a true quote, an invented one and a blank one."""
    docs = s.table(spark, sf, "documents")
    quotes = F.array(
        F.struct(F.lit(0).alias("finding"), F.upper(F.lit("  SOURCE:\n")).alias("lead")),
        F.struct(F.lit(1).alias("finding"), F.lit("invented evidence ").alias("lead")),
        F.struct(F.lit(2).alias("finding"), F.lit(" \n ").alias("lead")),
    )
    findings = docs.select("doc_id", "source", F.explode(quotes).alias("q")).select(
        "doc_id",
        F.lit("extraction").alias("source_agent"),
        "q.finding",
        F.when(F.col("q.finding") == 2, F.col("q.lead"))
        .otherwise(F.concat("q.lead", "source"))
        .alias("source_attribution"),
    )
    corpus = docs.select(
        "doc_id",
        F.lit("extraction").alias("source_agent"),
        F.concat(F.col("text"), F.lit("\n source:   "), F.col("source")).alias("body"),
    )
    found = mc.traceability_warnings(findings, corpus, ["doc_id", "source_agent"])
    return found.select("doc_id", "finding")


@query(
    "data_gaps",
    """SELECT accession_number, CASE WHEN coalesce(mdna_text, '') = '' THEN 'mdna_text missing for ' || accession_number || '; ' ELSE '' END
            || 'risk_factors_text missing for ' || accession_number
            || CASE WHEN coalesce(mdna_text, '') = '' THEN '; nothing extracted: the filing has no section text' ELSE '' END AS gaps,
        coalesce(mdna_text, '') = '' AS skipped
        FROM filings WHERE coalesce(risk_factors_text, '') = ''""",
)
def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    # Only whether a section has text matters: one letter stands for it from the scan on.
    short = {c: F.substring(c, 1, 1) for c in ("mdna_text", "risk_factors_text")}
    filings = s.staging.filings(s.raw_filings(spark, sf).withColumns(short))
    return mc.data_gaps(filings).withColumn("gaps", F.array_join("gaps", "; "))


@query(
    "rubric_summary",
    """SELECT 'C' || doc_id AS ticker, 1 + CAST(doc_id % 5 AS INTEGER) AS factual_grounding, 5 AS internal_consistency,
        quality AS honesty, CAST(NULL AS INTEGER) AS specificity, round(memo, 8) AS memo_cost, round(judge, 8) AS judge_cost
        FROM labels LEFT JOIN (SELECT ticker, sum(CASE WHEN agent_name <> 'system' THEN cost_usd ELSE 0 END) AS memo,
            sum(CASE WHEN agent_name = 'system' THEN cost_usd ELSE 0 END) AS judge FROM costed GROUP BY ticker) c
            ON c.ticker = 'C' || doc_id""",
)
def _rubric(spark: SparkSession, sf: str) -> DataFrame:
    scores = _judge(spark, sf).withColumn("ticker", s.text_of("C", F.col("doc_id")))
    summary = mc.rubric_summary(scores, costed(spark, sf), judge_agent="system")
    return rounded(summary, 8, "memo_cost", "judge_cost")


@query(
    "event_payloads",
    """SELECT 'macro.raw' AS topic, series_id AS key, series_id, observation_date, value,
        'ml_features (ticker=' || series_id || ', fiscal_year=' || year(observation_date) || ')' AS reference FROM macro""",
)
def _payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to published messages and back."""
    good, _ = serialise(s.macro(spark, sf), "macro", "series_id")
    back = good.select("key", F.from_json("value", EVENT_STREAMS["macro"]).alias("r"))
    rows = back.select(
        F.lit(TOPICS["macro"]).alias("topic"), "key", "r.series_id", "r.observation_date", "r.value"
    )
    named = rows.withColumns(
        {"ticker": F.col("series_id"), "fiscal_year": F.year("observation_date")}
    )
    return named.withColumn("reference", mc.panel_reference()).drop("ticker", "fiscal_year")


@query(
    "memo_sources",
    """SELECT ml_row_id, CASE WHEN accession_number IS NULL THEN 1 ELSE 2 END AS n_sources,
        'ml_features (ticker=' || ticker || ', fiscal_year=' || fiscal_year || ')' ||
        CASE WHEN accession_number IS NULL THEN '' ELSE '; raw_filings accession ' || accession_number || ' (10-K filed ' || filing_date || ')' END AS sources
        FROM panel""",
)
def _sources(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.panel(spark, sf).withColumn("form_type", F.lit("10-K"))
    filing = F.when(F.col("accession_number").isNotNull(), mc.filing_reference())
    refs = mc.distinct_sources(mc.panel_reference(), filing, mc.panel_reference())
    return rows.select("ml_row_id", refs.alias("refs")).select(
        "ml_row_id", F.size("refs").alias("n_sources"), F.array_join("refs", "; ").alias("sources")
    )
