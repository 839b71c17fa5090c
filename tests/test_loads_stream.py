"""Contracts, idempotent loads, dead letters and streams."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwing import contracts
from ledgerwing.operators import loads
from ledgerwing.session import recorded
from ledgerwing.sources import tables
from ledgerwing.streaming import events as ev


def test_conform(spark):
    df = spark.createDataFrame([("X", 1.5)], "Series_ID string, VALUE double")
    out = contracts.conform(df, "RAW_MACRO_OBSERVATIONS")
    assert out.columns == contracts.RAW_TABLES["raw_macro_observations"].names
    assert out.first()["observation_date"] is None
    with pytest.raises(KeyError, match="columns not in"):
        contracts.conform(df.withColumn("extra", F.lit(1)), "raw_macro_observations")
    with pytest.raises(KeyError, match="unknown landing table"):
        contracts.conform(df, "raw_nothing")
    assert contracts.schema_drift(out, "raw_macro_observations") == []
    assert contracts.schema_drift(df, "raw_macro_observations")


def test_create_tables(spark):
    names = loads.create_raw_tables(spark, "raw_contract_test")
    assert len(names) == 8 and loads.create_raw_tables(spark, "raw_contract_test") == names
    spark.sql("DROP DATABASE raw_contract_test CASCADE")


def test_replace_keys_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("0012", 1), ("B", 2), ("B", 3)], "ticker string, v int")
    loads.replace_keys(rows, path, "ticker")
    newer = spark.createDataFrame([("B", 9)], "ticker string, v int")
    for _ in range(2):
        loads.replace_keys(newer, path, "ticker")
        got = loads.read_keyed(spark, path, "ticker", ["ticker", "v"], rows.schema).collect()
        assert sorted(map(tuple, got)) == [("0012", 1), ("B", 9)]


def test_new_keys_leave_the_stored_files_alone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    schema = "ticker string, v int"

    def load(*rows):
        loads.replace_keys(spark.createDataFrame(list(rows), schema), path, "ticker", buckets=2)
        got = loads.read_keyed(spark, path, "ticker", ["ticker", "v"], spark.createDataFrame([], schema).schema)
        return sorted(map(repr, map(tuple, got.collect()))), {str(f) for f in (tmp_path / "t").rglob("*.parquet")}

    first, files = load(*[(f"k{i}", i) for i in range(20)])
    more, grown = load(("n1", 1), ("n1", 2), (None, 3))
    assert files < grown, "rows of new keys are added, the others are not rewritten"
    assert more == sorted([*first, "('n1', 1)", "('n1', 2)", "(None, 3)"])
    # A key that is there again, NULL too, is replaced as ever, also beside new ones.
    again, _ = load(("k3", 33), (None, 4), ("n2", 5))
    assert again == sorted([*(x for x in more if "k3" not in x and "None" not in x), "('k3', 33)", "(None, 4)", "('n2', 5)"])
    rows = spark.createDataFrame([("k0",), ("absent",)], "ticker string")
    loads.delete_keys(rows, path, "ticker", spark.createDataFrame([], schema).schema, buckets=2)
    left, held = load(("n3", 6))
    assert left == sorted([*(x for x in again if "'k0'" not in x), "('n3', 6)"])
    monkeypatch.setattr(loads, "FILES_PER_BUCKET", 1)
    last, merged = load(("n4", 7), *[(f"m{i}", 0) for i in range(9)])
    assert len(last) == len(left) + 10 and len(merged) <= len(held), "many small files are put together"


def test_a_load_does_not_copy_the_kept_rows_first(spark, tmp_path):
    path = str(tmp_path / "t")
    loads.replace_keys(spark.createDataFrame([("a", 1), ("b", 2)], "ticker string, v int"), path, "ticker")
    with recorded() as made:
        loads.replace_keys(spark.createDataFrame([("a", 9)], "ticker string, v int"), path, "ticker")
    assert not [f for f in made if "kept-rows" in f]


def test_a_small_load_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(f"k{i}", i) for i in range(64)], "ticker string, v int")
    loads.replace_keys(rows, path, "ticker")
    tasks = {f.name.split("-")[1] for f in (tmp_path / "t").rglob("*.parquet")}
    assert len(tasks) > 1
    hot = str(tmp_path / "hot")
    loads.replace_keys(rows.withColumn("ticker", F.lit("one")), hot, "ticker")
    assert len({f.name for f in (tmp_path / "hot").rglob("*.parquet")}) > 1, "a hot key is split over tasks"
    assert loads.read_keyed(spark, hot, "ticker", ["ticker", "v"], rows.schema).count() == 64
    mapped = rows.withColumn("m", F.create_map("ticker", "v"))
    loads.replace_keys(mapped, str(tmp_path / "maps"), "ticker")
    assert loads.read_keyed(spark, str(tmp_path / "maps"), "ticker", ["m"], mapped.schema).count() == 64


def test_ledger_and_reports(spark, tmp_path):
    row = {"model": "m", "agent_name": "a", "ticker": None, "input_tokens": 5, "cost_usd": 0.5}
    path = str(tmp_path / "ledger")
    df = spark.read.schema(tables.LEDGER).json(spark.sparkContext.parallelize([json.dumps(row)]))
    for _ in range(2):
        tables.append_ledger(df, path)
    assert tables.read_ledger(spark, path).count() == 2
    (tmp_path / "r.md").write_text("| honesty | 4/5 |\n")
    assert tables.read_reports(spark, str(tmp_path / "r.md")).first()["report"].startswith("| honesty")


def macro(series, value, at="2024-01-01T00:00:00", day="2024-01-01"):
    return json.dumps({"series_id": series, "observation_date": day, "value": value, "ingested_at": at})


LINES = [macro("A", 1.0), "not json", macro("A", "not-a-float"), json.dumps({"series_id": "A"}), "", macro("B", 99.0),
         macro("A", 2.0, "2024-01-02T00:00:00")]


def write(tmp_path, name, lines):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_poison_goes_to_dead_letters_and_the_stream_goes_on(spark, tmp_path):
    source, dlq, out, ck = write(tmp_path, "a.txt", LINES), str(tmp_path / "dlq"), str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        ev.run_stream(ev.read_lines(spark, source), "macro", lambda df, b: ev.land(df, out, b), dlq, ck,
                      {"too large": F.col("record.value") > 50}).awaitTermination()

    run()
    schema = contracts.EVENT_STREAMS["macro"]
    landed = ev.read_landed(spark, out, schema)
    assert sorted(r.value for r in landed.collect()) == [1.0, 2.0]
    dead = spark.read.parquet(dlq).collect()
    assert sorted((r.error_type, r.context["stage"]) for r in dead) == [
        ("CorruptRecord", "deserialization"), ("CorruptRecord", "deserialization"),
        ("MissingField", "deserialization"), ("Rejected", "handler")]
    assert {r.source_topic for r in dead} == {"macro.raw"}
    # A restart reads only what is new; a second copy replaces the first.
    write(tmp_path, "b.txt", [macro("A", 7.0, "2024-02-01T00:00:00"), macro("C", 3.0)])
    run()
    latest = ev.latest_view(ev.read_landed(spark, out, schema), ["series_id", "observation_date"])
    assert sorted((r.series_id, r.value) for r in latest.collect()) == [("A", 7.0), ("C", 3.0)]
    first = ev.compact(spark, ev.read_landed(spark, out, schema), ["series_id", "observation_date"], "ingested_at", str(tmp_path / "c1"))
    again = ev.compact(spark, ev.read_landed(spark, out, schema).where("batch_id > 0"), ["series_id", "observation_date"],
                       "ingested_at", str(tmp_path / "c2"), previous=first)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.0)], "series_id string, value double")
    for _ in range(2):
        ev.land(df, str(tmp_path / "o"), 3)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_serialisation_failures(spark):
    df = spark.createDataFrame([("k", None, None)], "series_id string, value double, observation_date date")
    df = df.withColumn("ingested_at", F.current_timestamp())
    good, dead = ev.serialise(df, "macro", "series_id")
    assert good.count() == 0
    row = dead.first()
    assert row.context["stage"] == "serialization" and row.payload_b64 is None
    assert row.error_message == "missing: observation_date, value"


SAMPLES = {
    "filing": {"accession_number": "1", "cik": "1", "company_name": "n", "form_type": "10-K", "filing_date": "2024-01-01",
               "document_url": "u", "raw_text": "t", "sections": {"mdna": "x"}, "ingested_at": "2024-01-01T00:00:00"},
    "macro": json.loads(macro("A", 1.0)),
    "options": {"underlying": "A", "contract_ticker": "O", "contract_type": "call", "strike": 1.0, "expiration": "2024-01-01",
                "day_volume": 1, "open_interest": 2, "volume_oi_ratio": 0.5, "detected_at": "2024-01-01T00:00:00"},
    "sentiment": {"post_id": "p", "subreddit": "s", "title": "t", "body": "b", "score": 1, "num_comments": 2,
                  "tickers": ["A"], "created_at": "2024-01-01T00:00:00", "ingested_at": "2024-01-01T00:00:00"},
    "transcript": {"company_name": "c", "url": "u", "segments": [{"speaker": "s", "section": "qa", "text": "t"}],
                   "ingested_at": "2024-01-01T00:00:00"},
}


@pytest.mark.parametrize("stream", sorted(SAMPLES))
def test_each_stream_round_trips(spark, stream):
    lines = spark.createDataFrame([("k", json.dumps(SAMPLES[stream]))], "key string, value string")
    good, dead = ev.route_dead_letters(lines, stream)
    assert dead.count() == 0
    key = contracts.EVENT_STREAMS[stream].names[0]
    messages, failed = ev.serialise(good, stream, key)
    assert failed.count() == 0
    back, dead = ev.route_dead_letters(messages, stream)
    assert dead.count() == 0 and back.collect() == good.collect()


def test_daily_counts_drop_late_rows_and_first_copies(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("t", T.TimestampType()), T.StructField("v", T.DoubleType())])
    source = str(tmp_path / "src")

    def add(*rows):
        spark.createDataFrame([(k, t, v) for k, t, v in rows], "k string, t string, v double").withColumn(
            "t", F.col("t").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        counts = ev.daily_counts(stream, "k", "t", "v", "2 days")
        return ev.run_daily_counts(spark, counts, "k", str(tmp_path / "o"), str(tmp_path / "ck"))

    add(("a", "2024-01-10 01:00:00", 1.0), ("a", "2024-01-20 01:00:00", 2.0))
    run()
    add(("a", "2024-01-20 02:00:00", 5.0), ("a", "2024-01-10 02:00:00", 9.0))
    got = {str(r.day): (r.n, r.total) for r in run().collect()}
    assert got == {"2024-01-10": (1, 1.0), "2024-01-20": (2, 7.0)}
    stream = ev.first_copies(spark.readStream.schema(schema).parquet(source), ["k"], "t", "100 days")
    query = stream.writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("firsts").count() == 1
