"""Annual fundamentals from long tables of tagged financial facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Tags of each fundamentals field, in order of preference.
FIELD_CONCEPTS: dict[str, tuple[str, ...]] = {
    "revenue": (
        "RevenueFromContractWithCustomerExcludingAssessedTax",
        "Revenues",
        "SalesRevenueNet",
        "RevenueFromContractWithCustomerIncludingAssessedTax",
        "RealEstateRevenueNet",
        "OperatingLeaseLeaseIncome",
        "OperatingLeasesIncomeStatementLeaseRevenue",
    ),
    "cost_of_revenue": ("CostOfGoodsAndServicesSold", "CostOfRevenue", "CostOfSales"),
    "net_income": ("NetIncomeLoss",),
    "total_assets": ("Assets",),
    "total_liabilities": ("Liabilities",),
    "total_equity": (
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
    ),
    "total_debt": ("LongTermDebt", "LongTermDebtNoncurrent"),
}
COVER_SHARES = "EntityCommonStockSharesOutstanding"
BALANCE_SHARES = "CommonStockSharesOutstanding"
MIN_DURATION_DAYS = 300


@dataclass(frozen=True)
class FieldRule:
    """How one fundamentals field is resolved from candidate facts."""

    concepts: tuple[str, ...]
    taxonomy: str = "us-gaap"
    unit: str = "USD"
    prefer: str = "priority"
    non_negative: bool = True


#: Revenue tags are parts of a total, so the largest wins; income and equity may
#: be negative, every other field may not.
DEFAULT_RULES: dict[str, FieldRule] = {
    **{
        field: FieldRule(
            concepts,
            prefer="max_value" if field == "revenue" else "priority",
            non_negative=field not in ("net_income", "total_equity"),
        )
        for field, concepts in FIELD_CONCEPTS.items()
    },
    "cover_shares": FieldRule((COVER_SHARES,), taxonomy="dei", unit="shares"),
    "balance_shares": FieldRule((BALANCE_SHARES,), unit="shares"),
}


def qualify_facts(df: DataFrame, non_negative: Column | None = None) -> DataFrame:
    """Facts of full fiscal years reported on an annual form.

    A fact with a start date must span at least 300 days. ``non_negative`` marks
    the rows whose value may not be below zero.
    """
    keep = (
        (F.col("form") == "10-K")
        & (F.col("fp") == "FY")
        & F.col("val").isNotNull()
        & F.col("end").isNotNull()
        & (F.col("start").isNull() | (F.datediff("end", "start") >= MIN_DURATION_DAYS))
    )
    if non_negative is not None:
        keep = keep & (~non_negative | (F.col("val") >= 0))
    return df.where(keep)


def _rule_table(spark: SparkSession, rules: Mapping[str, FieldRule]) -> DataFrame:
    """One row per tag of each rule; a constant of a few rows, so broadcast."""
    rows = [
        (rule.taxonomy, concept, rule.unit, field, rank, rule.non_negative)
        for field, rule in rules.items()
        for rank, concept in enumerate(rule.concepts)
    ]
    schema = "taxonomy string, concept string, unit string, field string, rank int, nn boolean"
    return F.broadcast(spark.createDataFrame(rows, schema))


def _candidates(facts: DataFrame, rules: Mapping[str, FieldRule]) -> DataFrame:
    """Qualified facts tagged with their field, latest filed per (tag, period end)."""
    # Tagging follows the cheap row filter, which reaches the scan.
    tagged = qualify_facts(facts).join(
        _rule_table(facts.sparkSession, rules), ["taxonomy", "concept", "unit"]
    )
    # Of facts filed on one day the first one listed counts.
    newest = F.struct(_filed(), -F.col("pos"))
    return (
        tagged.where(~F.col("nn") | (F.col("val") >= 0))
        .groupBy("cik", "field", "rank", "end")
        .agg(F.max_by(F.struct("val", "filed", "concept"), newest).alias("fact"))
        .select("cik", "field", "rank", "end", "fact.val", "fact.filed", "fact.concept")
    )


def _filed() -> Column:
    """Filing date as an ordering; an unknown date comes first."""
    return F.coalesce(F.unix_date("filed"), F.lit(-(2**31)))


def _strength(rules: Mapping[str, FieldRule]) -> Column:
    """Ordering whose maximum is the winning tag of one field and period end."""
    largest = [f for f, r in rules.items() if r.prefer == "max_value"]
    lead = F.when(F.col("field").isin(*largest), F.col("val").cast("double")).otherwise(
        -F.col("rank").cast("double")
    )
    return F.struct(lead, _filed(), -F.col("rank"))


def resolve_concepts(facts: DataFrame, rules: Mapping[str, FieldRule] = DEFAULT_RULES) -> DataFrame:
    """Winning fact of every (company, field, period end).

    Input columns: cik, taxonomy, concept, unit, start, end, val, fp, form,
    filed, pos. Both steps are partial aggregations; no facts are collected.
    """
    return (
        _candidates(facts, rules)
        .groupBy("cik", "field", "end")
        .agg(F.max_by(F.struct("val", "filed", "concept"), _strength(rules)).alias("fact"))
        .select("cik", "field", "end", "fact.val", "fact.filed", "fact.concept")
    )


def fundamentals_history(
    facts: DataFrame,
    rules: Mapping[str, FieldRule] = DEFAULT_RULES,
    fields: Sequence[str] = tuple(FIELD_CONCEPTS),
) -> DataFrame:
    """One row per company and fiscal year, for all companies at once.

    Years are the calendar years of revenue period ends; the last end in a year
    stands for it. Other fields must match that period end. Share counts match
    by calendar year, from the cover page, or from the balance sheet for a
    company that has no cover-page counts at all.
    """
    every = [*fields, "cover_shares", "balance_shares"]

    def winner(field: str) -> Column:
        mine = F.col("field") == field
        return F.max_by(F.when(mine, F.col("val")), F.when(mine, F.col("_strength"))).alias(field)

    per_end = (
        _candidates(facts, rules)
        .select("cik", "end", "field", F.col("val").cast("double").alias("val"),
                _strength(rules).alias("_strength"))
        .groupBy("cik", "end")
        .agg(*[winner(f) for f in every])
    )

    def at_last_end(column: Column, present: Column, name: str) -> Column:
        return F.max_by(column, F.when(present, F.col("end"))).alias(name)

    has_revenue = F.col("revenue").isNotNull()
    per_year = per_end.groupBy("cik", F.year("end").alias("fiscal_year")).agg(
        at_last_end(F.struct("end", *fields), has_revenue, "period"),
        *[
            at_last_end(F.col(c), F.col(c).isNotNull(), c)
            for c in ("cover_shares", "balance_shares")
        ],
    )
    # A company has one row per calendar year here.
    company = Window.partitionBy("cik")
    has_cover = F.max(F.col("cover_shares").isNotNull()).over(company)
    return (
        per_year.withColumn(
            "shares_outstanding",
            F.when(has_cover, F.col("cover_shares")).otherwise(F.col("balance_shares")),
        )
        .where(F.col("period").isNotNull())
        .select(
            "cik",
            F.col("fiscal_year").cast("int").alias("fiscal_year"),
            F.lit(4).alias("fiscal_quarter"),
            F.col("period.end").alias("period_end_date"),
            *[f"period.{f}" for f in fields],
            "shares_outstanding",
            F.lit(None).cast("double").alias("close_price"),
        )
    )


def latest_fundamentals(history: DataFrame) -> DataFrame:
    """Most recent fiscal year of each company."""
    rest = [c for c in history.columns if c != "cik"]
    return (
        history.groupBy("cik")
        .agg(F.max_by(F.struct(*rest), F.col("fiscal_year")).alias("h"))
        .select("cik", *[f"h.{c}" for c in rest])
    )
