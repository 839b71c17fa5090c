"""How much the larger steps move: plans and figures that must not grow with wide or repeated work."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ledgerwing.operators.ranked import exact_quantile
from ledgerwing.operators.boosting import BinnedRows
from ledgerwing.plans import intermediate, serving
from ledgerwing.plans import revenue_model as rm
from ledgerwing.queries import QUERIES
from ledgerwing.queries import standins as s
from ledgerwing.queries import universe
from ledgerwing.streaming import events as ev
from ledgerwing.streaming import merge as mg

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _orders(spark, path: str) -> str:
    """Three customers, one without orders; lines of one order lie apart; some values are missing."""
    spark.sql("SELECT * FROM VALUES (1L, 10.5D), (1L, -1D), (2L, 7D), (3L, 1D), (NULL, 9D) t(c_custkey, c_acctbal)").write.parquet(f"{path}/customer.parquet")
    spark.sql(
        "SELECT o_orderkey, o_custkey, CAST(day AS timestamp_ntz) AS o_orderdate FROM VALUES (1L, 1L, '1996-02-01'), (2L, 1L, '1996-05-01'),"
        " (3L, 1L, '1997-01-01'), (4L, 2L, NULL), (5L, NULL, '1997-01-01'), (NULL, 2L, '1997-01-01') t(o_orderkey, o_custkey, day)"
    ).write.parquet(f"{path}/orders.parquet")
    spark.sql(
        "SELECT * FROM VALUES (1L, 100D, 0.1D, 0.02D, 3D), (2L, 50D, 0D, 0D, 1D), (1L, 10D, NULL, 0.01D, 2D),"
        " (3L, NULL, 0.1D, 0.1D, NULL), (4L, 20D, 0.5D, 0D, 4D), (NULL, 30D, 0D, 0D, 5D), (5L, 40D, 0D, 0D, 6D)"
        " t(l_orderkey, l_extendedprice, l_discount, l_tax, l_quantity)"
    ).write.parquet(f"{path}/lineitem.parquet")
    return path


def test_fundamentals_shuffle_line_columns_once(spark, tmp_path):
    df = s.build_fundamentals(spark, _orders(spark, str(tmp_path)))
    dealt = [x for x in plan_of(df).splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    assert len(dealt) == 1 and "REPARTITION_BY_COL" in dealt[0]
    columns = ("ticker", "fiscal_year", "revenue", "cost_of_revenue", "net_income", "total_liabilities", "total_debt", "shares_outstanding", "close_price", "total_equity")
    found = {tuple(r) for r in df.select(*columns).collect()}
    year = ("C1", 1996, 140.0, 96.0, -5.0, 64.0, 2.1, 6.0, 100.0)
    assert found == {
        (*year, 10.5),
        (*year, -1.0),
        ("C1", 1997, None, None, None, None, None, None, None, 10.5),
        ("C1", 1997, None, None, None, None, None, None, None, -1.0),
        ("C2", None, 10.0, 12.0, -9.6, 8.0, 0.0, 4.0, 20.0, 7.0),
    }


def test_quantile_counts_values_of_few_ranges(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=999).tolist(), rng.integers(0, 5, 1000).astype(float).tolist()
    rows = [(x, y) for x, y in zip([*a, None], b, strict=True)] + [(float("nan"), None)]
    df = spark.createDataFrame(rows, "a double, b double")
    for p in (0.0, 0.37, 0.5, 1.0):
        out = exact_quantile(df, ["a", "b"], p)
        assert "quantile-ranges" in " ".join(out.inputFiles())
        found = dict(map(tuple, out.collect()))
        assert found["a"] == pytest.approx(np.quantile(a, p), abs=1e-12)
        assert found["b"] == pytest.approx(np.quantile(b, p), abs=1e-12)


def test_panel_labels_share_the_shuffle_by_ticker(spark):
    names = ("mdna_word_count", *[f"{k}_mentions" for k in s.KEYWORDS], "risk_word_total", "risk_words_per_1000")
    measures = ("revenue", "cost_of_revenue", "net_income", "total_assets", "total_liabilities", "total_equity", "total_debt")
    day = "date_add(date'1996-12-31', cast(id as int) * 365) AS"
    years = spark.range(3).selectExpr("'C1' AS ticker", "1996 + cast(id as int) AS fiscal_year", f"{day} period_end_date", "1D AS close_price", "1D AS shares_outstanding", *[f"cast(id + 1 as double) AS {m}" for m in measures])
    companies = spark.range(1).selectExpr("'C1' AS ticker", "'A' AS sector")
    filings = spark.range(3).selectExpr("'C1' AS ticker", "'10-K' AS form_type", "date_add(date'1997-02-01', cast(id as int) * 365) AS filing_date", "concat('F', id) AS accession_number", *[f"1 AS {n}" for n in names])
    macro = spark.range(3).selectExpr("'FEDFUNDS' AS series_id", f"{day} observation_date", "2D AS value")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        panel = intermediate.ml_features(companies, years, filings, macro, s.KEYWORDS, "none")
        assert not [x for x in plan_of(panel).splitlines() if "Exchange hashpartitioning(ticker" in x and "_w" in x]
        found = {r.fiscal_year: (r.label, r.accession_number, r.revenue_growth_1y) for r in panel.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {1996: (1, "F0", None), 1997: (1, "F1", 1.0), 1998: (None, "F2", 0.5)}


def test_snapshot_joins_outcomes_once(spark, monkeypatch):
    seen = []

    def stop(path, outcomes, *rest):
        seen.extend(outcomes.inputFiles())
        raise InterruptedError

    monkeypatch.setattr(serving, "write_snapshot", stop)
    with pytest.raises(InterruptedError):
        QUERIES["snapshot_views"](spark, SF)
    assert seen and all("/outcomes-" in f for f in seen)


def test_prediction_years_are_told_apart_by_number(spark):
    assert "hashpartitioning(o_custkey" in plan_of(s.predictions(spark, SF))


def test_table_pages_are_dealt_over_the_cluster(spark):
    assert QUERIES["html_table_rows"](spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_stream_batches_that_are_written_once_are_not_cached(spark, tmp_path):
    plans = []
    values = ['{"series_id":"A","observation_date":"2024-01-01","value":1.0,"ingested_at":"2024-01-02T00:00:00"}', "not json"]
    for batch, lines in enumerate((values, values[:1])):
        path = str(tmp_path / f"lines{batch}")
        spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)

        def handler(records, batch_id):
            plans.append(plan_of(records))
            ev.land(records, str(tmp_path / "landed"), batch_id)

        ev.run_stream(
            ev.read_lines(spark, path), "macro", handler, str(tmp_path / f"dlq{batch}"), str(tmp_path / f"check{batch}"), writes_once=True
        ).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "landed")).count() == 1
        assert spark.read.parquet(str(tmp_path / f"dlq{batch}")).count() == len(lines) - 1
    assert not any("InMemory" in p for p in plans)


def test_counted_streams_keep_little_on_disk(spark, tmp_path, monkeypatch):
    n, folder = 300, str(tmp_path)
    events = "id AS event_id, TIMESTAMP_NTZ'2024-01-02 03:04:05' AS ts, IF(id % 3 = 0, 'a', 'b') AS event_type, id / 7D AS value"
    lines = "id AS l_orderkey, 1L AS l_partkey, 1 AS l_linenumber, 5D AS l_extendedprice, 2D AS l_quantity, id % 4 / 100D AS l_tax, 0.1D AS l_discount"
    for name, columns in (("events", events), ("lineitem", lines)):
        spark.sql(f"SELECT {columns} FROM range({n})").write.parquet(f"{folder}/{name}.parquet")
    monkeypatch.setattr(universe, "LINES_PER_FILE", 20)
    made, run_counted, scratch = [], mg.run_counted, universe.scratch_dir
    monkeypatch.setattr(universe, "scratch_dir", lambda spark, label: made.append((label, scratch(spark, label))) or made[-1][1])
    seen = []

    def counted(stream_lines, stream, handler, dlq, counts, checkpoint):
        kept = [x for label, x in made if label != "counts" and os.path.isdir(x)]
        files = [f for f in os.listdir(kept[0]) if not f.startswith((".", "_"))]
        size = sum(os.path.getsize(f"{kept[0]}/{f}") for f in files)
        whole = spark.read.text(kept[0]).selectExpr("sum(length(value) + 1)").first()[0]
        done = run_counted(stream_lines, stream, handler, dlq, counts, checkpoint)
        seen.append((stream, len(kept), len(files) > 8, size < whole, mg.published_counts(spark, counts).count() > 1))
        return done

    monkeypatch.setattr(mg, "run_counted", counted)
    found = {r.stream: (r.published, r.dead) for r in QUERIES["stream_counts"](spark, folder).collect()}
    assert found == {"macro": (n, 3 * n), "options": (n, 0), "options/implied_volatility": (n // 4, 0)}
    assert seen == [(x, 1, True, True, True) for x in ("macro", "options")]
    assert [label for label, x in made if os.path.isdir(x)] == ["counts", "counts"]


def _features(spark, n: int):
    """Few values, many values, mostly zeros, a constant; the label depends on some."""
    cells = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(m)) / d for i, (m, d) in enumerate([(7, 2.0), (100_003, 100.0), (50, 1.0), (1, 1.0)])]
    rows = spark.range(n).select("id", *[c.alias(f"c{i}") for i, c in enumerate(cells)])
    rows = rows.withColumn("c2", F.when(F.col("id") % 3 == 0, F.col("c2")).otherwise(0.0))
    noise = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(1000))
    return rows.withColumn("label", (F.col("c0") * 100 + F.col("c1") + F.col("c2") * 10 + noise > 1300).cast("double"))


def test_binned_fits_are_those_of_mllib(spark, tmp_path):
    _features(spark, 12_000).select("label", array_to_vector(F.array("c0", "c1", "c2", "c3")).alias("features")).repartition(3).write.parquet(str(tmp_path / "m"))
    matrix = spark.read.parquet(str(tmp_path / "m"))
    binned = BinnedRows(matrix, rm.SEED)
    for params in (
        {"maxDepth": 3, "stepSize": 0.2, "maxIter": 4, "minInstancesPerNode": 20, "subsamplingRate": 0.7},
        {"maxDepth": 2, "stepSize": 0.1, "maxIter": 2, "minInstancesPerNode": 1, "subsamplingRate": 1.0},
    ):
        fitted = (GBTClassifier(seed=rm.SEED, **params).fit(matrix), binned.model(binned.fit(params), params))
        old, new = (
            np.array([r[0] for r in m.transform(matrix).select(vector_to_array("probability")[1]).collect()]) for m in fitted
        )
        assert np.abs(old - new).max() < 1e-12 and len(np.unique(new)) > 3
    with pytest.raises(ValueError, match="maxBins"):
        binned.fit({"maxBins": 8})
    with pytest.raises(ValueError, match="labels"):
        BinnedRows(matrix.withColumn("label", F.lit(2.0)), rm.SEED)


def test_searched_settings_share_their_passes(spark, monkeypatch):
    rows = _features(spark, 600).select(F.col("id").cast("string").alias("ticker"), (F.col("id") % 4 + 2020).cast("int").alias("fiscal_year"), F.col("label").cast("int").alias("label"), F.col("c1").alias("revenue"), F.col("c0").alias("net_margin"))
    fit, held = rows.where("fiscal_year < 2022"), rows.where("fiscal_year >= 2022")
    grid = [{"maxDepth": d, "stepSize": 0.1, "maxIter": 2, "minInstancesPerNode": 1, "subsamplingRate": 0.9} for d in (1, 2, 3, 3)]
    passes, shared = [], BinnedRows._pass
    monkeypatch.setattr(BinnedRows, "_pass", lambda self, fits: passes.append(len(fits)) or shared(self, fits))
    _, results = rm.tune(fit, held, ["revenue", "net_margin"], grid)
    assert [p for p, _ in results] == grid and min(auc for _, auc in results) > 0.6
    # 18 levels in all, six of the deepest fit; the first pass may begin before all fits are there.
    assert sum(passes) <= 18 and len(passes) <= 10 and max(passes) >= 3
