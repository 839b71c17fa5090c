"""Deterministic checks and ledgers around generated research memos."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import call_price, is_close, token_estimate
from ..functions.text import RUBRIC, parse_report, squash
from ..operators.ranked import running_total

# --- Fixed values of the five-call worst-case projection -------------------------
SYSTEM_TOKENS = 500
STRUCTURE_TOKENS = 750
PROBE_CHARS = 60
# --------------------------------------------------------------------------------


def price_table(spark: SparkSession, prices: Mapping[str, tuple[float, float]]) -> DataFrame:
    """USD per million input and output tokens of each priced model.

    Built from a dictionary in the caller's hands, so it is small enough to broadcast.
    """
    table = spark.createDataFrame(
        [(m, float(i), float(o)) for m, (i, o) in prices.items()],
        "model string, price_in double, price_out double",
    )
    return F.broadcast(table)


def unpriced_models(ledger: DataFrame, prices: DataFrame) -> DataFrame:
    """Models in the ledger without a price."""
    return ledger.select("model").distinct().join(prices, "model", "left_anti")


def call_cost(ledger: DataFrame, prices: DataFrame) -> DataFrame:
    """Ledger with ``cost_usd``; a model without a price is an error."""
    known = F.when(
        F.col("price_in").isNull(),
        F.raise_error(F.concat(F.lit("no price for model "), F.col("model"))),
    ).otherwise(
        call_price(
            F.col("price_in"),
            F.col("price_out"),
            F.col("input_tokens"),
            F.col("output_tokens"),
            F.coalesce("cache_creation_input_tokens", F.lit(0)),
            F.coalesce("cache_read_input_tokens", F.lit(0)),
        )
    )
    return (
        ledger.join(prices, "model", "left")
        .withColumn("cost_usd", known)
        .drop("price_in", "price_out")
    )


def cost_summary(ledger: DataFrame, by: Sequence[str] = ("agent_name", "ticker")) -> DataFrame:
    """Spend and calls per grouping level, down to the grand total."""
    return ledger.rollup(*by).agg(
        F.grouping_id().cast("int").alias("level"),
        F.count(F.lit(1)).alias("calls"),
        F.sum("cost_usd").alias("cost_usd"),
    )


def spend_cap_breaches(
    ledger: DataFrame, cap: float, by: Sequence[str] = ("run_id",), seq: str = "seq"
) -> DataFrame:
    """Calls whose worst case would lift the run over its cap.

    ``projected_cost`` is the worst case known before the call and ``cost_usd``
    the real cost after it; the spend before a call is the running real cost.
    """
    run = running_total(ledger, by, seq, "cost_usd", "spent_after", before="spent_before")
    return run.where(F.col("spent_before") + F.col("projected_cost") > F.lit(cap))


def estimate_tokens(filings: DataFrame) -> DataFrame:
    """Replace the section texts by ``tokens``; done before any shuffle, it is all they are read for."""
    sized = filings.withColumn("tokens", token_estimate("mdna_text", "risk_factors_text"))
    return sized.drop("mdna_text", "risk_factors_text")


def project_batch_cost(
    years: DataFrame, writer: tuple[float, float], judge: tuple[float, float]
) -> DataFrame:
    """Worst-case cost of five calls per company-year from its estimated tokens.

    Needs ``current_tokens`` and ``prior_tokens``; a missing year counts as empty.
    """
    sized = years.fillna(0, ["current_tokens", "prior_tokens"])
    a, b = F.col("current_tokens"), F.col("prior_tokens")
    system, structure = F.lit(SYSTEM_TOKENS), F.lit(STRUCTURE_TOKENS)
    calls: list[tuple[tuple[float, float], Column, int]] = [
        (writer, system + a, 4000),
        (writer, system + a + b + structure, 4000),
        (writer, system + structure, 2000),
        (writer, system + F.lit(10_000), 8000),
        (judge, system + a + b + F.lit(4_000), 1500),
    ]
    total: Column = F.lit(0.0)
    for (price_in, price_out), tokens_in, tokens_out in calls:
        total = total + call_price(F.lit(price_in), F.lit(price_out), tokens_in, F.lit(tokens_out))
    return sized.withColumn("projected_cost_usd", total)


def panel_metrics(panel: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Panel in long form: (ticker, fiscal_year, source_metric, real_value)."""
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("source_metric"), F.col(m).cast("double").alias("real_value"))
            for m in metrics
        ]
    )
    return panel.select("ticker", "fiscal_year", F.explode(cells).alias("c")).select(
        "ticker", "fiscal_year", "c.*"
    )


def grounding_warnings(
    statements: DataFrame, panel: DataFrame, metrics: Sequence[str], rel: float = 1e-3, abs_: float = 1e-6
) -> DataFrame:
    """Statements whose echoed value differs from the real one.

    Two NULLs agree, one NULL does not; a metric that does not exist is NULL.
    """
    real = panel_metrics(panel, metrics)
    joined = statements.join(real, ["ticker", "fiscal_year", "source_metric"], "left")
    echoed, truth = F.col("metric_value"), F.col("real_value")
    one_missing = echoed.isNull() != truth.isNull()
    differs = ~is_close(truth, echoed, rel, abs_)
    return joined.where(one_missing | F.coalesce(differs, F.lit(False)))


def traceability_warnings(
    findings: DataFrame, corpus: DataFrame, on: Sequence[str], probe: int | None = None
) -> DataFrame:
    """Findings whose attribution does not occur in the text they cite.

    Both sides are folded to lower case with single blanks. The whole attribution
    must occur, or with ``probe`` its first characters (``PROBE_CHARS`` is the
    lenient rule for generated memos). Only the verdict of a finding leaves the
    join, not the cited text.
    """
    quote = squash("source_attribution")
    asked = findings.withColumn("_probe", quote if probe is None else F.substring(quote, 1, probe))
    cited = corpus.select(*on, squash("body").alias("_body"))
    joined = asked.join(cited, list(on), "left")
    blank = F.coalesce(F.col("_probe"), F.lit("")) == ""
    found = F.coalesce(F.contains(F.col("_body"), F.col("_probe")), F.lit(False))
    return joined.where(blank | ~found).select(*findings.columns)


def data_gaps(filings: DataFrame) -> DataFrame:
    """Filings with a missing section and the list of their gaps."""
    def missing(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("")) == ""

    no_mdna, no_risk = missing("mdna_text"), missing("risk_factors_text")
    gaps = F.array_compact(
        F.array(
            F.when(no_mdna, F.concat(F.lit("mdna_text missing for "), "accession_number")),
            F.when(no_risk, F.concat(F.lit("risk_factors_text missing for "), "accession_number")),
            F.when(no_mdna & no_risk, F.lit("nothing extracted: the filing has no section text")),
        )
    )
    return filings.where(no_mdna | no_risk).select(
        "accession_number", gaps.alias("gaps"), (no_mdna & no_risk).alias("skipped")
    )


def comparison_gaps(pairs: DataFrame) -> DataFrame:
    """Company-years that cannot be compared with the year before."""
    now, prior = F.col("current_accession").isNull(), F.col("prior_accession").isNull()
    gaps = F.array_compact(
        F.array(
            F.when(now, F.lit("current-year filing text unavailable")),
            F.when(prior, F.lit("prior-year filing text unavailable")),
            F.lit("no comparison performed"),
        )
    )
    return pairs.where(now | prior).withColumn("gaps", gaps)


def judge_scores(reports: DataFrame, report: str = "report") -> DataFrame:
    """Reports with rubric scores and verdict."""
    return reports.withColumns(parse_report(report))


def rubric_summary(scores: DataFrame, ledger: DataFrame, judge_agent: str = "judge") -> DataFrame:
    """Rubric scores per company with memo and judging cost; unscored ones drop out."""
    judged = F.col("agent_name") == judge_agent
    costs = ledger.groupBy("ticker").agg(
        F.sum(F.when(~judged, F.col("cost_usd")).otherwise(0.0)).alias("memo_cost"),
        F.sum(F.when(judged, F.col("cost_usd")).otherwise(0.0)).alias("judge_cost"),
    )
    scored = scores.where(F.col(RUBRIC[0]).isNotNull())
    return scored.join(costs, "ticker", "left").select(
        "ticker", *RUBRIC, "memo_cost", "judge_cost"
    )


def filing_reference() -> Column:
    """Provenance text of a filing row."""
    return F.format_string(
        "raw_filings accession %s (%s filed %s)",
        "accession_number",
        "form_type",
        F.col("filing_date").cast("string"),
    )


def panel_reference() -> Column:
    """Provenance text of a panel row."""
    return F.format_string("ml_features (ticker=%s, fiscal_year=%d)", "ticker", "fiscal_year")


def distinct_sources(*references: Column) -> Column:
    """Sorted distinct references of a memo."""
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*references))))
