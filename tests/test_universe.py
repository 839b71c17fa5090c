"""Versioned loads, resumable runs, merged tables, late rows, counted and bounded runs."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwing.contracts import catalogue_drift, contract
from ledgerwing.operators.loads import create_raw_tables, read_keyed
from ledgerwing.operators.quality import bounds, checks_sql, not_null, relationship, run_checks, unique
from ledgerwing.operators.versions import VersionedTables
from ledgerwing.plans import revenue_model as rm
from ledgerwing.plans import universe as un
from ledgerwing.session import drop_folders, recorded, scratch_dir, written
from ledgerwing.streaming import events as ev
from ledgerwing.streaming import merge as mg


# --- versions -----------------------------------------------------------------------
def rows_of(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_a_load_that_fails_leaves_the_last_one(spark):
    tables = VersionedTables(spark, scratch_dir(spark, "versions"))
    assert tables.version()[0] == 0 and tables.read_all() == {}
    with pytest.raises(KeyError):
        tables.read("a")
    assert tables.publish({"a": rows_of(spark, 1), "b": rows_of(spark, 2)}, "versioned_test") == 1
    held = tables.read("a")
    broken = rows_of(spark, 3).withColumn("v", F.raise_error(F.lit("gone")).cast("int"))
    with pytest.raises(PySparkException):
        tables.publish({"a": rows_of(spark, 9), "b": broken}, "versioned_test")
    assert [r.v for r in tables.read("a").collect()] == [1] and tables.version()[0] == 1
    assert spark.table("versioned_test.a").first().v == 1
    assert tables.publish({"a": rows_of(spark, 4), "c": rows_of(spark)}, "versioned_test") == 2
    assert held.first().v == 1, "a reader stays with its version"
    assert spark.table("versioned_test.a").first().v == 4
    assert set(tables.read_all()) == {"a", "c"} and tables.read("c").count() == 0
    gone = tables.vacuum(keep=1)
    assert len(gone) == 1 and tables.read("a").first().v == 4
    with pytest.raises(Exception):  # noqa: B017 - its files are gone
        held.collect()


def test_scratch_folders_are_recorded_and_dropped(spark):
    with recorded() as made:
        kept = written(rows_of(spark, 1), "kept")
    assert len(made) == 1 and kept.count() == 1
    scratch_dir(spark, "outside")
    assert len(made) == 1
    drop_folders(spark, [*made, "file:/tmp/no-such-folder-of-ledgerwing"])
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(made[0])


# --- resumable runs -------------------------------------------------------------------
def test_an_interrupted_run_goes_on(spark):
    members = spark.createDataFrame([(f"m{i}", i) for i in range(20)] + [(None, 99)], "ticker string, n int")
    source = spark.createDataFrame([(f"m{i}", k) for i in range(20) for k in range(i % 4)], "ticker string, k int")
    ledger = un.RunLedger(spark, scratch_dir(spark, "ledger"))
    path = scratch_dir(spark, "rows")
    calls = []

    def load(batch):
        calls.append(sorted(str(r.ticker) for r in batch.collect()))
        own = source.join(batch.select("ticker"), "ticker", "left_semi")
        if len(calls) == 2:
            own = own.withColumn("k", F.raise_error(F.lit("lost")).cast("int"))
        n = batch.select("ticker").join(own.groupBy("ticker").count(), "ticker", "left")
        return un.Loaded({"rows": own}, n.where("coalesce(count, 0) = 0").select("ticker", F.lit("no rows").alias("reason")))

    with pytest.raises(PySparkException):
        un.run_batches(members.where("ticker IS NOT NULL"), "ticker", ledger, load, {"rows": path}, 5)
    first = ledger.status().groupBy("state").count().collect()
    assert {r.state for r in first} == {"claimed", "done", "dropped"}
    done = set(calls[0])
    assert un.run_batches(members.where("ticker IS NOT NULL"), "ticker", ledger, load, {"rows": path}, 5) >= 2
    again = {m for c in calls[2:] for m in c}
    assert not done & again and done | again == {f"m{i}" for i in range(20)}
    status = {r.member: r for r in ledger.status().collect()}
    for i in range(20):
        r = status[f"m{i}"]
        assert (r.state, r.reason) == (("dropped", "no rows") if i % 4 == 0 else ("done", None))
        assert r.counts == (None if i % 4 == 0 else {"rows": i % 4})
    stored = read_keyed(spark, path, "ticker", ["ticker", "k"], source.schema)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, source.collect()))
    assert un.run_batches(members.where("ticker IS NOT NULL"), "ticker", ledger, load, {"rows": path}, 5) == 0


# --- merged tables ----------------------------------------------------------------------
ROW = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("at", T.TimestampType())]
)


def batch_of(spark, *rows):
    return spark.createDataFrame([(k, v, datetime(2024, 1, 1, h)) for k, v, h in rows], ROW)


def test_latest_rows_after_replays_late_and_repeated_batches(spark):
    table = mg.LatestTable(spark, scratch_dir(spark, "latest"), ROW, ["k"], "at", buckets=8)
    batches = [
        batch_of(spark, ("a", 1, 5), ("b", 1, 5), (None, 1, 5), ("c", 1, 5)),
        batch_of(spark, ("a", 2, 3), ("b", 2, 7), ("b", 2, 7)),
        batch_of(spark),
        batch_of(spark, ("a", 3, 5), ("d", 3, 1)),
    ]
    for i, rows in enumerate(batches):
        table.merge(rows, i)
        assert table.merge(batch_of(spark, ("a", 99, 23)), i) == [], "a batch is merged once"
    got = sorted((str(r.k), r.v, r.at.hour) for r in table.read().collect())
    assert got == [("None", 1, 5), ("a", 3, 5), ("b", 2, 7), ("c", 1, 5), ("d", 3, 1)]
    assert table.read().schema == ROW


def test_untouched_buckets_are_neither_read_nor_written(spark):
    table = mg.LatestTable(spark, scratch_dir(spark, "latest"), ROW, ["k"], "at", buckets=16)
    table.merge(batch_of(spark, *[(f"k{i}", 0, 1) for i in range(200)]), 0)
    before = table.state()[1]
    read = []
    stored = table._stored
    table._stored = lambda folders, only=None: read.append(only) or stored(folders, only)
    touched = table.merge(batch_of(spark, ("k7", 1, 2)), 1)
    after = table.state()[1]
    assert len(touched) == 1 and read == [touched]
    files = stored(before, touched).inputFiles()
    assert files and all(f"_bucket={touched[0]}/" in f for f in files)
    assert {b for b in after if after[b] != before[b]} == set(touched)
    assert table.read().count() == 200 and table.read().where("v = 1").count() == 1
    assert table.vacuum() == [] and table.read().count() == 200


def test_vacuum_drops_folders_that_no_bucket_names(spark):
    table = mg.LatestTable(spark, scratch_dir(spark, "latest"), ROW, ["k"], "at", buckets=2)
    for i in range(3):
        table.merge(batch_of(spark, *[(f"k{j}", i, i) for j in range(20)]), i)
    assert len(table.vacuum()) == 2 and table.read().where("v = 2").count() == 20


def test_late_rows_go_to_the_side(spark):
    table = mg.DailySignals(spark, scratch_dir(spark, "daily"), delay="1 day", buckets=4)
    mentions = "ticker string, score int, num_comments int, created_at timestamp"

    def events(*rows):
        data = [(t, s, 1, datetime(2024, 1, d, 12)) for t, s, d in rows]
        return mg.signal_events(mentions=spark.createDataFrame(data, mentions))

    table.merge(events(("A", 1, 5), ("A", 2, 5), ("B", 3, 9)), 0)
    table.merge(events(("A", 10, 5), ("B", 20, 9), ("C", 30, 8)), 1)  # the 5th ended before the 8th, 12:00
    table.merge(events(("A", 99, 5)), 1)
    days = {(r.ticker, r.day): (r.mention_count, r.total_score) for r in table.read().collect()}
    assert days == {("A", date(2024, 1, 5)): (2, 3), ("B", date(2024, 1, 9)): (2, 23), ("C", date(2024, 1, 8)): (1, 30)}
    assert [(r.ticker, r.total_score) for r in table.late_rows().collect()] == [("A", 10)]
    assert table.state()[2] == datetime(2024, 1, 8, 12)
    table.merge(events(), 2)
    assert table.state()[0] == 2 and table.state()[2] == datetime(2024, 1, 8, 12)


def test_bounded_runs_stop_and_go_on(spark):
    path, landed, counts, checkpoint = (scratch_dir(spark, n) for n in ("lines", "landed", "counts", "checkpoint"))
    for part in range(5):
        lines = [
            (f'{{"series_id":"S","observation_date":"2024-01-0{k + 1}","value":{part}.5,"ingested_at":"2024-01-01T00:00:00"}}',)
            for k in range(4)
        ] + [("broken",), ("",)]
        spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)

    def run(limit):
        lines = ev.read_lines(spark, path, files_per_trigger=1)
        handler = ev.landing_handler("macro", landed)
        return mg.run_counted(lines, "macro", handler, scratch_dir(spark, "dlq"), counts, checkpoint, max_messages=limit)

    with pytest.raises(mg.NotPublished):
        mg.published_counts(spark, counts)
    assert run(0) == 0 and run(5) == 8 and run(4) == 4 and run(None) == 8 and run(None) == 0
    found = mg.published_counts(spark, counts).orderBy("batch_id").collect()
    assert [(r.published, r.dead) for r in found] == [(4, 1)] * 5
    assert ev.read_landed(spark, landed, contract("raw_macro_observations")).count() == 20


def test_a_failing_handler_is_not_taken_for_the_bound(spark):
    path = scratch_dir(spark, "lines")
    spark.createDataFrame([("x",)], "value string").write.text(path)

    def handler(records, batch_id):
        records.count()
        raise RuntimeError("handler is broken")

    with pytest.raises(Exception, match="handler is broken"):
        mg.run_counted(
            ev.read_lines(spark, path), "macro", handler, scratch_dir(spark, "dlq"), scratch_dir(spark, "counts"),
            scratch_dir(spark, "checkpoint"), max_messages=1,
        )


# --- catalogue and rules ------------------------------------------------------------------
def test_fresh_tables_do_not_drift(spark):
    create_raw_tables(spark, "fresh_tables_test", scratch_dir(spark, "fresh"))
    create_raw_tables(spark, "fresh_tables_test")
    assert catalogue_drift(spark, "fresh_tables_test").count() == 0


def test_compiled_rules_count_what_the_rules_count(spark):
    import duckdb

    data = [(1, "a", 5.0), (1, None, -1.0), (2, "x", None), (None, "b", 50.0)]
    rules = [unique("k"), not_null("name"), bounds("v", 0, 10, where="k = 1"), relationship("name", "parents", "name")]
    df = spark.createDataFrame(data, "k int, name string, v double")
    parents = {"parents": spark.createDataFrame([("a",), (None,)], "name string")}
    got = {r.rule: r.failures for r in run_checks("m", df, rules, parents).collect()}
    source = "SELECT * FROM (VALUES (1, 'a', 5.0), (1, NULL, -1.0), (2, 'x', NULL), (NULL, 'b', 50.0)) t(k, name, v)"
    sql = checks_sql("m", source, rules, {"parents": "SELECT 'a' AS name UNION ALL SELECT NULL"})
    want = {r[1]: r[2] for r in duckdb.sql(sql).fetchall()}
    assert got == want == {"unique(k)": 1, "not_null(name)": 1, "bounds(v)": 1, "relationships(name)": 2}


# --- importance -----------------------------------------------------------------------------
def test_permuted_features_lose_what_they_told(spark):
    n = 400
    rows = [(f"T{i}", 2000, int(i % 5 < 2), float(i % 5 < 2) + (i % 7) / 10, float(i % 3), None) for i in range(n)]
    df = spark.createDataFrame(rows, "ticker string, fiscal_year int, label int, revenue double, net_margin double, cpi_yoy double")
    columns = ["revenue", "net_margin", "cpi_yoy"]
    plain = rm.Scaling({c: 0.0 for c in columns}, {c: 0.0 for c in columns}, {c: 1.0 for c in columns})
    model = rm.FittedModel("m", columns, plain, rm.LinearScorer([4.0, 0.0, 1.0], 0.5), False)
    got = {r.feature: r for r in rm.permutation_importance(model, df, permuted_rows=100).collect()}
    again = {r.feature: r for r in rm.permutation_importance(model, df, permuted_rows=100).collect()}
    assert got == again and set(got) == set(columns)
    assert got["revenue"].importance > 0.2 and got["net_margin"].importance == 0 and got["cpi_yoy"].importance == 0
    assert abs(got["revenue"].auc - 0.5) < 0.15


def test_copies_with_a_permuted_feature_are_scored_once(spark):
    scored = spark.sparkContext.accumulator(0)

    def counted(x):
        scored.add(1)
        return x

    class Counting(rm.LinearScorer):
        def transform(self, df):
            seen = F.udf(counted, "array<double>")(vector_to_array("probability"))
            return super().transform(df).withColumn("probability", array_to_vector(seen))

    n, columns = 200, ["revenue", "net_margin"]
    rows = [(f"T{i}", 2000, int(i % 5 < 2), float(i % 7), float(i % 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "ticker string, fiscal_year int, label int, revenue double, net_margin double")
    plain = rm.Scaling({c: 0.0 for c in columns}, {c: 0.0 for c in columns}, {c: 1.0 for c in columns})
    model = rm.FittedModel("m", columns, plain, Counting([4.0, 1.0], 0.5), False)
    assert rm.permutation_importance(model, df, permuted_rows=50).count() == 2
    assert scored.value == n * (len(columns) + 1)


def test_the_logistic_fit_ends_where_no_slope_is_left(spark):
    rows = [(f"T{i}", 2000, int((i * 7) % 11 < 5), float(i % 13), float((i * 5) % 17)) for i in range(300)]
    df = spark.createDataFrame(rows, "ticker string, fiscal_year int, label int, revenue double, net_margin double")
    model = rm.logistic_baseline(df, ["revenue", "net_margin"])
    slopes = {r.feature: abs(r.slope) for r in rm.gradient(model, df).collect()}
    assert set(slopes) == {"revenue", "net_margin", "(intercept)"} and max(slopes.values()) < 1e-5
    stored = rm.FittedModel("s", model.columns, model.scaling, rm.linear_scorer(model), False)
    a = {r.ticker: r.predicted_score for r in model.score(df).collect()}
    b = {r.ticker: r.predicted_score for r in stored.score(df).collect()}
    assert all(abs(a[t] - b[t]) < 1e-12 for t in a)


# --- universe loads -------------------------------------------------------------------------
def test_bodies_of_filings_are_not_broadcast(spark):
    url = "https://www.sec.gov/Archives/edgar/data/1/F1/main.htm"
    listed = '{"name": "One", "filings": {"recent": {"accessionNumber": ["F-1"], "form": ["10-K"],' \
        ' "filingDate": ["2020-01-02"], "primaryDocument": ["main.htm"]}}}'
    bodies = written(spark.createDataFrame([(url, "<p>Item 7. Results</p><p>up</p>")], "document_url string, body string"), "bodies")
    sources = un.Sources(
        tickers=spark.createDataFrame([("one", 1, "One")], "ticker string, cik_str long, title string"),
        submissions=spark.createDataFrame([("one", "0000000001", listed)], "ticker string, cik string, payload string"),
        archives=spark.createDataFrame([], "cik string, name string, payload string"),
        bodies=bodies.select("document_url", F.repeat("body", F.lit(2)).alias("body")),
        facts=spark.createDataFrame([], "cik string, payload string"),
        macro=spark.createDataFrame([], "series_id string, payload string"),
    )
    filings = un.universe_tables(sources, date(2024, 1, 20), datetime(2024, 2, 1))["raw_filings"]
    assert [(r.ticker, r.document_url) for r in filings.collect()] == [("ONE", url)]
    plan = filings._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [document_url" in plan and "BroadcastHashJoin [document_url" not in plan
