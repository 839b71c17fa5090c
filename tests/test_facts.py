"""Fundamentals goldens on hand-written facts."""

from datetime import date

from ledgerwing.operators.facts import DEFAULT_RULES, fundamentals_history, latest_fundamentals, resolve_concepts

SCHEMA = ("cik string, taxonomy string, concept string, unit string, pos long, start date, end date, "
          "val double, fp string, form string, filed date")


def fact(concept, val, end, filed, start=None, form="10-K", fp="FY", taxonomy="us-gaap", unit="USD", pos=0, cik="1"):
    day = date.fromisoformat
    return (cik, taxonomy, concept, unit, pos, day(start) if start else None, day(end), float(val), fp, form, day(filed))


def history(spark, *facts):
    df = spark.createDataFrame(list(facts), SCHEMA)
    return {r.fiscal_year: r for r in fundamentals_history(df).collect()}


def rev(val, end="2024-12-31", filed="2025-02-01", concept="Revenues", **kw):
    start = kw.pop("start", f"{end[:4]}-01-01")
    return fact(concept, val, end, filed, start=start, **kw)


def test_restatement_wins_and_first_of_a_day(spark):
    rows = history(spark, rev(100), rev(110, filed="2026-02-01"), rev(90, filed="2026-02-01", pos=5))
    assert rows[2024].revenue == 110


def test_short_and_quarterly_facts_are_dropped(spark):
    rows = history(spark, rev(100), rev(999, filed="2026-01-01", start="2024-10-01"),
                   rev(888, filed="2026-01-01", form="10-Q"), rev(777, filed="2026-01-01", fp="Q4"))
    assert rows[2024].revenue == 100


def test_negative_magnitude_is_rejected(spark):
    rows = history(spark, rev(100), fact("LongTermDebt", 50, "2024-12-31", "2025-02-01"),
                   fact("LongTermDebt", -60, "2024-12-31", "2026-02-01"), fact("NetIncomeLoss", -5, "2024-12-31", "2025-02-01", start="2024-01-01"))
    assert rows[2024].total_debt == 50 and rows[2024].net_income == -5


def test_component_and_total(spark):
    part = rev(3, concept="RevenueFromContractWithCustomerExcludingAssessedTax", filed="2026-06-01")
    assert history(spark, part, rev(1000))[2024].revenue == 1000


def test_priority_and_stale_tag(spark):
    rows = history(
        spark, rev(10), rev(20, end="2025-12-31"),
        fact("CostOfGoodsAndServicesSold", 5, "2024-12-31", "2025-02-01", start="2024-01-01"),
        fact("CostOfRevenue", 6, "2024-12-31", "2026-02-01", start="2024-01-01"),
        fact("CostOfRevenue", 7, "2025-12-31", "2026-02-01", start="2025-01-01"))
    assert rows[2024].cost_of_revenue == 5 and rows[2025].cost_of_revenue == 7


def test_shares_match_by_year(spark):
    shares = {"taxonomy": "dei", "unit": "shares"}
    rows = history(
        spark, rev(10, end="2024-09-28", start="2023-10-01"), rev(10, end="2023-09-30", start="2022-10-01"),
        fact("EntityCommonStockSharesOutstanding", 7, "2024-10-20", "2024-11-01", **shares),
        fact("EntityCommonStockSharesOutstanding", 8, "2024-11-20", "2024-11-25", **shares),
        fact("CommonStockSharesOutstanding", 99, "2023-09-30", "2023-11-01", unit="shares"))
    assert rows[2024].shares_outstanding == 8 and rows[2023].shares_outstanding is None
    rows = history(spark, rev(10), fact("CommonStockSharesOutstanding", 99, "2024-12-31", "2025-02-01", unit="shares"))
    assert rows[2024].shares_outstanding == 99


def test_one_row_per_year_and_revenue_only(spark):
    rows = history(spark, rev(1, end="2024-01-06", start="2023-01-07"), rev(2, end="2024-12-28"),
                   fact("Assets", 5, "2022-12-31", "2023-02-01"))
    assert set(rows) == {2024} and rows[2024].revenue == 2
    assert rows[2024].period_end_date == date(2024, 12, 28) and rows[2024].fiscal_quarter == 4
    assert history(spark, fact("Assets", 5, "2022-12-31", "2023-02-01")) == {}


def test_latest_and_resolve(spark):
    df = spark.createDataFrame([rev(1, end="2023-12-31"), rev(2), rev(5, cik="2", end="2020-12-31")], SCHEMA)
    latest = {r.cik: (r.fiscal_year, r.revenue) for r in latest_fundamentals(fundamentals_history(df)).collect()}
    assert latest == {"1": (2024, 2.0), "2": (2020, 5.0)}
    winners = resolve_concepts(df, {"revenue": DEFAULT_RULES["revenue"]})
    assert winners.count() == 3
