"""Memo checks, cost ledger and the model jobs."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerwing.operators import quality as q
from ledgerwing.operators.metrics import roc_auc
from ledgerwing.plans import memo_checks as mc
from ledgerwing.plans import revenue_model as rm
from ledgerwing.queries import QUERIES
from ledgerwing.queries.quality_loads import RULES


def ledger(spark, *rows):
    return spark.createDataFrame(list(rows), "model string, agent_name string, ticker string, input_tokens long, "
                                 "output_tokens long, cache_creation_input_tokens long, cache_read_input_tokens long")


def test_call_cost(spark):
    prices = mc.price_table(spark, {"m": (10.0, 50.0)})
    rows = mc.call_cost(ledger(spark, ("m", "a", "T", 1_000_000, 0, 0, 0), ("m", "a", "T", 0, 1_000_000, 0, 0),
                               ("m", "judge", "T", 0, 0, 1_000_000, 1_000_000)), prices)
    assert sorted(r.cost_usd for r in rows.collect()) == pytest.approx([10.0, 13.5, 50.0])
    bad = ledger(spark, ("other", "a", "T", 1, 0, 0, 0))
    assert mc.unpriced_models(bad, prices).first()["model"] == "other"
    with pytest.raises(Exception, match="no price for model other"):
        mc.call_cost(bad, prices).collect()
    total = mc.cost_summary(rows).where("level = 3").first()
    assert total.calls == 3 and total.cost_usd == pytest.approx(73.5)


def test_spend_cap(spark):
    df = spark.createDataFrame([("r", i, 1.0, 0.5) for i in range(6)], "run_id string, seq int, cost_usd double, projected_cost double")
    assert sorted(r.seq for r in mc.spend_cap_breaches(df, 3.5).collect()) == [4, 5]


def test_grounding(spark):
    panel = spark.createDataFrame([("A", 2024, 0.5, None)], "ticker string, fiscal_year int, net_margin double, debt double")
    said = spark.createDataFrame(
        [("A", 2024, "net_margin", 0.5002), ("A", 2024, "net_margin", 0.6), ("A", 2024, "debt", 1.0), ("A", 2024, "debt", None),
         ("A", 2024, "net_margin", None), ("A", 2024, "nope", None)],
        "ticker string, fiscal_year int, source_metric string, metric_value double")
    got = {(r.source_metric, r.metric_value) for r in mc.grounding_warnings(said, panel, ["net_margin", "debt"]).collect()}
    assert got == {("net_margin", 0.6), ("debt", 1.0), ("net_margin", None)}


def test_traceability(spark):
    corpus = spark.createDataFrame([("m", "extraction", "Revenue  ROSE\nby 5%"), ("m", "signal", "score")], "memo string, source_agent string, body string")
    found = spark.createDataFrame(
        [("m", "extraction", "revenue rose by 5%", 1), ("m", "signal", "revenue rose by 5%", 2), ("m", "extraction", "invented", 3),
         ("m", "extraction", "  ", 4), ("m", "missing", "revenue", 5)], "memo string, source_agent string, source_attribution string, id int")
    bad = mc.traceability_warnings(found, corpus, ["memo", "source_agent"])
    assert sorted(r.id for r in bad.collect()) == [2, 3, 4, 5]


def test_every_rule_finds_its_planted_faults(spark):
    from ledgerwing.queries.quality_loads import flawed, owners
    sf = "/root/testdata/sf0.001"
    for rule, _ in RULES.values():
        assert q.offending(flawed(spark, sf), rule, owners(spark, sf)).count() > 0
    with pytest.raises(ValueError):
        q.offending(flawed(spark, sf), q.Rule("odd", "ratio"))


def panel(spark, n=600):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        growth = rng.gauss(0, 1)
        rows.append((f"T{i % 60}", 2015 + i % 11, ["Tech", "Energy"][i % 2], float(rng.random()),
                     None if i % 7 == 0 else growth, int(growth + rng.gauss(0, 0.5) > 0)))
    return spark.createDataFrame(rows, "ticker string, fiscal_year int, sector string, revenue double, revenue_growth_1y double, label int")


def test_encoding_and_splits(spark):
    df = panel(spark)
    cats = rm.learn_categories(df)
    assert cats == ["Energy", "Tech"]
    enc = rm.encode_features(df, cats)
    assert enc.where("revenue_growth_1y is null").count() == df.where("revenue_growth_1y is null").count()
    assert enc.where("net_margin is not null").count() == 0
    train, test = rm.time_split(enc)
    assert train.agg(F.max("fiscal_year")).first()[0] < test.agg(F.min("fiscal_year")).first()[0]
    assert {r[0] for r in test.select("fiscal_year").distinct().collect()} == {2024, 2025}
    groups = rm.feature_groups(rm.feature_columns(cats))
    assert sorted(sum(groups.values(), [])) == sorted(rm.feature_columns(cats))
    fit, held = rm.inner_split(train)
    assert fit.count() + held.count() == train.count() and held.count() > 0
    assert rm.align_columns(enc, ["revenue", "sector_New"]).first()["sector_New"] == 0.0


def test_models_beat_the_majority(spark):
    df = panel(spark)
    cats = rm.learn_categories(df)
    train, test = rm.time_split(rm.encode_features(df, cats))
    columns = ["revenue", "revenue_growth_1y", "sector_Energy"]
    linear = rm.logistic_baseline(train, columns)
    trees = rm.boosted_trees(train, columns, maxIter=5, maxDepth=3)
    for model in (linear, trees):
        assert roc_auc(model.score(test), label="label").first()["auc"] > 0.75
    assert roc_auc(rm.majority_baseline(test), label="label").first()["auc"] == 0.5
    top = rm.top_features(rm.model_attribution(linear, test), 1).first()
    assert top.feature == "revenue_growth_1y"
    found = rm.permutation_importance(linear, test, columns).collect()
    drops = {r.feature: r.importance for r in found}
    assert max(drops, key=drops.get) == "revenue_growth_1y"
    scored = rm.score_all(linear, df, cats, "m")
    assert scored.count() == df.count() and scored.where("predicted_direction not in (0, 1)").count() == 0


def test_tuning_picks_the_best_trial(spark):
    train, _ = rm.time_split(rm.encode_features(panel(spark, 300), ["Tech"]))
    fit, held = rm.inner_split(train)
    grid = [{**g, "maxIter": 2} for g in rm.sample_grid(2)]
    best, results = rm.tune(fit, held, ["revenue", "revenue_growth_1y"], grid)
    assert best in grid and len(results) == 2 and rm.sample_grid(3) == rm.sample_grid(3)
    assert len(rm.sample_grid()) == 40


def test_registered_tuning_runs_the_whole_grid(spark, monkeypatch):
    ran = []

    class Scored:
        def score(self, df):
            return df.withColumn("predicted_score", F.lit(0.5))

    monkeypatch.setattr(rm, "_fit_trees", lambda rows, columns, scaling, params: ran.append(params) or Scored())
    rows = QUERIES["tune"](spark, "/root/testdata/sf0.001").orderBy("trial").collect()
    grid = rm.sample_grid()
    assert sorted(map(repr, ran)) == sorted(map(repr, grid))
    assert [(r.step_size, r.max_depth) for r in rows] == [(g["stepSize"], g["maxDepth"]) for g in grid]
