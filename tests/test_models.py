"""Raw CSV tables through staging to the panel and the marts, plus rules and plans."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerwing.operators import quality as q
from ledgerwing.plans import intermediate, marts, serving, staging
from ledgerwing.plans.build import MARTS, build_models, check_models
from ledgerwing.plans.evaluation import calibration_report
from ledgerwing.sources.tables import read_raw_csv

CSV = {
    "raw_companies": """ticker,cik,company_name,sector,industry
aa,0000000001,"Alpha, Inc.",Tech,Chips
BB,0000000002,Beta,Financials,Banks
CC,0000000003,Gamma,,Oil
""",
    "raw_filings": '''accession_number,cik,ticker,company_name,form_type,filing_date,document_url,mdna_text,risk_factors_text,ingested_at
F1,0000000001,AA,Alpha,10-K,2025-02-10,u/old,"Old text","Risk",2025-02-10 01:00:00
F1,0000000001,AA,Alpha,10-K,2025-02-10,u/new,"A decline, a ""Decline"" and declined
sales","litigation",2025-02-10 02:00:00
F2,0000000001,AA,Alpha,10-K,2025-03-10,u2,later,,2025-03-10 01:00:00
F3,0000000009,ZZ,Unknown,8-K,2025-03-10,u3,x,y,2025-03-10 01:00:00
''',
    "raw_fundamentals": """ticker,fiscal_year,fiscal_quarter,period_end_date,revenue,cost_of_revenue,net_income,total_assets,total_liabilities,total_equity,total_debt,shares_outstanding,close_price
AA,2024,4,2024-12-31,100,60,10,200,50,80,40,10,5
AA,2025,4,2025-12-31,100,60,-10,200,50,-5,40,10,5
AA,2027,4,2027-12-31,0,,0,0,50,0,40,10,5
BB,2024,4,2024-12-31,100,60,10,200,50,80,40,10,5
CC,2024,4,2024-12-31,100,60,10,200,50,80,40,10,5
""",
    "raw_macro_observations": "series_id,observation_date,value,ingested_at\n"
    + "".join(f"CPIAUCSL,2024-{m:02d}-01,{100 + m},2026-01-01 00:00:00\n" for m in range(1, 13))
    + "CPIAUCSL,2025-01-01,111.1,2026-01-01 00:00:00\n"
    + "FEDFUNDS,2025-01-01,4.0,2026-01-01 00:00:00\nFEDFUNDS,2025-01-01,4.5,2026-01-02 00:00:00\n"
    + "FEDFUNDS,2025-03-01,5.0,2026-01-01 00:00:00\nT10Y2Y,2025-02-10,0.4,2026-01-01 00:00:00\n",
    "raw_sentiment_mentions": """post_id,subreddit,ticker,title,score,num_comments,created_at,ingested_at
p1,stocks,aa,t,5,1,2025-02-10 10:00:00,2025-02-10 11:00:00
p1,stocks,AA,t,7,1,2025-02-10 10:00:00,2025-02-10 12:00:00
p2,stocks,AA,t,-1,2,2025-02-10 12:00:00,2025-02-10 12:00:00
""",
    "raw_options_activity": """underlying,contract_ticker,contract_type,strike,expiration,day_volume,open_interest,volume_oi_ratio,implied_volatility,detected_at
AA,O1,call,1,2025-07-01,300,100,3.0,0.2,2025-02-10 15:30:00
AA,O2,call,1,2025-07-01,700,100,7.0,,2025-02-11 15:30:00
AA,O3,put,1,2025-07-01,100,10,10.0,0.4,2025-02-11 15:30:00
""",
}


@pytest.fixture(scope="module")
def stg(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    raw = {}
    for name, body in CSV.items():
        path = root / f"{name}.csv"
        path.write_text(body)
        raw[name] = read_raw_csv(spark, name, str(path))
    return raw, staging.staging_views(raw)


def panel_of(stg):
    raw, s = stg
    return intermediate.ml_features(s["stg_companies"], s["stg_fundamentals"],
                                    intermediate.narrow_filings(raw["raw_filings"]), s["stg_macro_observations"])


def test_staging(stg):
    _, s = stg
    assert len(s) == 6
    filings = {r.accession_number: r for r in s["stg_filings"].collect()}
    assert len(filings) == 3 and filings["F1"].document_url == "u/new" and "\n" in filings["F1"].mdna_text
    mentions = {r.mention_id: r.score for r in s["stg_sentiment_mentions"].collect()}
    assert mentions == {"p1|AA": 7, "p2|AA": -1}
    assert s["stg_companies"].where("ticker = 'AA'").first()["company_name"] == "Alpha, Inc."
    assert s["stg_fundamentals"].where("ticker = 'AA' and fiscal_year = 2024").first()["fundamental_id"] == "AA|2024Q4"


def test_narrow_equals_wide(stg):
    raw, s = stg
    narrow = intermediate.narrow_filings(raw["raw_filings"])
    wide = intermediate.filing_language_features(s["stg_filings"])
    cols = wide.columns
    assert sorted(map(tuple, narrow.select(*cols).collect())) == sorted(map(tuple, wide.collect()))
    f1 = narrow.where("accession_number = 'F1'").first()
    assert (f1.decline_mentions, f1.litigation_mentions, f1.risk_word_total) == (3, 1, 4)
    assert f1.risk_words_per_1000 == 4 * 1000.0 / f1.mdna_word_count
    assert narrow.where("accession_number = 'F2'").first()["risk_factors_chars"] == 0


def test_ratios(stg):
    _, s = stg
    r = {x.fundamental_id: x for x in intermediate.financial_ratios(s["stg_fundamentals"], s["stg_companies"]).collect()}
    assert r["AA|2024Q4"].pe_ratio == 50 / 40 and r["AA|2024Q4"].debt_to_equity == 0.5
    assert r["AA|2025Q4"].debt_to_equity is None and r["AA|2025Q4"].roe_annualised is None
    z = r["AA|2027Q4"]
    assert z.net_margin is None and z.gross_margin is None and z.pe_ratio is None and z.liabilities_to_assets is None


def test_panel(stg):
    rows = {r.ml_row_id: r for r in panel_of(stg).collect()}
    assert set(rows) == {"AA|2024", "AA|2025", "AA|2027"}  # the excluded and the unknown sector are gone
    a = rows["AA|2024"]
    assert a.label == 0 and a.revenue_growth_1y is None and a.accession_number == "F1"
    assert a.fed_funds_rate == 4.5 and a.yield_curve_spread == 0.4 and a.unemployment_rate is None
    assert a.cpi_yoy == pytest.approx(111.1 / 101 - 1) and a.decline_mentions == 3
    b = rows["AA|2025"]
    assert b.label is None and b.revenue_growth_1y == 0.0 and b.accession_number is None
    assert b.fed_funds_rate == 5.0 and b.mdna_word_count is None
    assert rows["AA|2027"].revenue_growth_1y is None
    assert intermediate.training_set(panel_of(stg)).count() == 1
    assert intermediate.inference_set(panel_of(stg)).count() == 2


def test_lookups(spark, stg):
    panel = panel_of(stg)
    keys = spark.createDataFrame([("aa", 2024), ("aa", 1999)], "ticker string, fiscal_year int")
    assert intermediate.company_years(panel, keys).count() == 1
    text = intermediate.filing_text(panel, stg[1]["stg_filings"], keys).collect()
    assert len(text) == 1 and text[0].fiscal_year == 2024


def test_marts(spark, stg):
    raw, s = stg
    ratios = intermediate.financial_ratios(s["stg_fundamentals"], s["stg_companies"])
    profile = {r.ticker: r for r in marts.company_profile(s["stg_companies"], ratios, s["stg_filings"]).collect()}
    assert profile["AA"].total_filings == 2 and profile["BB"].total_filings == 0
    assert profile["AA"].latest_fundamentals_date == date(2027, 12, 31)
    flow = intermediate.options_flow_daily(s["stg_options_activity"])
    by_day = {r.activity_date: r for r in flow.collect()}
    assert by_day[date(2025, 2, 10)].call_put_volume_ratio is None
    assert by_day[date(2025, 2, 11)].call_put_volume_ratio == 7.0 and by_day[date(2025, 2, 11)].avg_implied_volatility == 0.4
    signals = marts.signal_history(flow, intermediate.sentiment_daily(s["stg_sentiment_mentions"]), s["stg_filings"], s["stg_companies"])
    got = {r.signal_id: r for r in signals.collect()}
    assert set(got) == {"AA|2025-02-10", "AA|2025-02-11", "AA|2025-03-10"}
    d = got["AA|2025-02-10"]
    assert (d.mention_count, d.sentiment_score, d.filings_filed) == (2, 6, 1)
    assert d.composite_signal_score == 3 * 8 + 2 * 5 + 10
    history = marts.filing_history(intermediate.narrow_filings(raw["raw_filings"]), s["stg_companies"])
    assert {r.accession_number for r in history.collect()} == {"F1", "F2"}
    sectors = {r.sector: r for r in marts.sector_summary(
        marts.company_profile(s["stg_companies"], ratios, s["stg_filings"]), signals, s["stg_companies"]).collect()}
    assert sectors["Tech"].signal_days == 3 and sectors["Financials"].signal_days is None


def test_outcomes(spark, stg):
    p = spark.createDataFrame([("AA", 2024, 0.9, 1), ("AA", 2025, 0.2, 0), ("BB", 2024, 0.9, 1)],
                              "ticker string, fiscal_year int, predicted_score double, predicted_direction int")
    p = p.withColumns({"model_artifact": F.lit("m"), "scored_at": F.current_timestamp()})
    out = {r.prediction_id: r for r in marts.prediction_outcomes(p, panel_of(stg)).collect()}
    assert set(out) == {"AA|2024", "AA|2025"}
    assert out["AA|2024"].correct is False and out["AA|2024"].data_split == "test"
    assert out["AA|2025"].status == "pending" and out["AA|2025"].correct is None


def test_model_rules_on_the_fixture(stg):
    _, s = stg
    rules = q.model_rules()
    assert len(rules) == 19
    failures = {
        (name, r.rule): r.failures
        for name in ("stg_companies", "stg_filings", "stg_fundamentals", "stg_sentiment_mentions")
        for r in q.run_checks(name, s[name], rules[name], s).collect() if r.failures
    }
    assert failures == {("stg_companies", "not_null(sector)"): 1}


def test_panel_plan(stg):
    plan = panel_of(stg)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan
    assert "WindowGroupLimit" in plan


def test_text_leaves_before_the_shuffle(spark):
    """The narrow filings carry no document text through an exchange."""
    from ledgerwing.queries import standins as s
    raw = s.table(spark, "/root/testdata/sf0.001", "documents").select(
        F.col("doc_id").cast("string").alias("accession_number"), F.lit("A").alias("ticker"), F.lit("A").alias("company_name"),
        F.lit("10-K").alias("form_type"), F.current_date().alias("filing_date"), F.lit("u").alias("document_url"),
        F.col("text").alias("mdna_text"), F.col("text").alias("risk_factors_text"), F.current_timestamp().alias("ingested_at"))
    plan = intermediate.narrow_filings(raw)._jdf.queryExecution().executedPlan()
    exchanges = [line for line in plan.toString().splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "_text" not in exchanges[0]


def test_whole_build_checks_and_snapshot(spark, stg, tmp_path):
    raw = dict(stg[0])
    raw["raw_model_predictions"] = spark.createDataFrame(
        [("aa", 2024, 0.9, 1, "m"), ("AA", 2025, 0.2, 0, "m")],
        "ticker string, fiscal_year int, predicted_score double, predicted_direction int, model_artifact string",
    ).withColumn("scored_at", F.current_timestamp())
    models = build_models(spark, raw, str(tmp_path / "marts"))
    assert set(MARTS) <= set(models) and models["prediction_outcomes"].count() == 2
    # A second build replaces every mart with the same rows.
    again = build_models(spark, raw, str(tmp_path / "marts"))
    assert again["filing_history"].count() == 2
    failed = {(r.model, r.rule) for r in check_models(again).where("failures > 0").collect()}
    assert ("stg_companies", "not_null(sector)") in failed and ("company_profile", "not_null(sector)") in failed
    assert not any(m in ("prediction_outcomes", "signal_history", "filing_history") for m, _ in failed)
    snapshot = str(tmp_path / "snapshot")
    serving.write_snapshot(
        snapshot, again["prediction_outcomes"], again["int_ml_features"], again["stg_companies"],
        calibration_report(again["prediction_outcomes"]))
    assert spark.read.parquet(f"{snapshot}/predictions").count() == 2
    meta = spark.read.json(f"{snapshot}/company_meta").first()
    assert meta.ticker == "AA" and meta.company_name == "Alpha, Inc."
    history = serving.company_history(spark.read.parquet(f"{snapshot}/predictions"), "AA")
    assert [r.fiscal_year for r in history.collect()] == [2024, 2025]


def test_views_are_read_once_for_all_their_rules(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        read.add(1)
        return x

    rows = spark.createDataFrame(
        [("a", "A", 1.0), ("a", "B", None), (None, "A", 2.0), ("b", "Z", 3.0), ("c", None, 4.0)],
        "fundamental_id string, ticker string, revenue double",
    )
    models = {
        "stg_companies": spark.createDataFrame([("A", "1", "x"), ("B", None, "y")], "ticker string, cik string, sector string"),
        "stg_fundamentals": rows.withColumn("fundamental_id", counted("fundamental_id")),
    }
    found = {(r.model, r.rule): r.failures for r in check_models(models).collect()}
    assert read.value == 5
    plain = [q.run_checks(m, models[m], q.model_rules()[m], models) for m in models]
    assert found == {(r.model, r.rule): r.failures for p in plain for r in p.collect()}
    own = {k: n for (m, k), n in found.items() if m == "stg_fundamentals"}
    assert own == {
        "unique(fundamental_id)": 1, "not_null(fundamental_id)": 1, "not_null(ticker)": 1,
        "relationships(ticker)": 1, "not_null(revenue)": 1,
    }


def test_scopes_of_rules_hold_when_columns_are_written(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 0, 50.0), ("b", 1, 50.0), ("b", 1, None), ("z", None, 50.0)], "k string, own int, v double"
    )
    rules = [
        q.Rule("unique", "k", where="own = 1"), q.relationship("k", "known", "k"), q.bounds("v", 0, 9, where="own = 1"),
        q.invariant("odd", "own = 0 and v > 9"), q.accepted("k", "a", "b"),
    ]
    models = {"known": spark.createDataFrame([("a",), ("b",)], "k string")}
    results = [{r.rule: r.failures for r in q.run_checks("m", rows, rules, models, once=o).collect()} for o in (False, True)]
    assert results[0] == results[1] == {
        "unique(k)": 1, "relationships(k)": 1, "bounds(v)": 1, "invariant(odd)": 1, "accepted_values(k)": 1,
    }
