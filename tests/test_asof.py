"""As-of joins and prefix sums against brute force, with hot keys and ties."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerwing.operators.asof import asof_join, in_force, next_within
from ledgerwing.operators.metrics import roc_auc
from ledgerwing.operators.ranked import exact_quantile, prefix_sums, running_total
from ledgerwing.operators.shifts import year_neighbours, year_pairs

DAY0 = date(2000, 1, 1)


def rows(seed, n, span):
    rng = random.Random(seed)
    # A third of the rows share one key, and many share one day.
    return [
        (i, "hot" if rng.random() < 0.34 else rng.choice("abc"),
         DAY0 + timedelta(days=500 if rng.random() < 0.1 else rng.randrange(span)))
        for i in range(n)
    ]


def brute(left, right, direction, exact, tolerance):
    out = {}
    for i, k, t in left:
        best = None
        for j, rk, rt in right:
            if rk != k:
                continue
            gap = (t - rt).days if direction == "backward" else (rt - t).days
            if gap < 0 or (gap == 0 and not exact) or (tolerance is not None and gap > tolerance):
                continue
            rank = (gap, -j if direction == "backward" else j)
            if best is None or rank < best[0]:
                best = (rank, j)
        out[i] = best[1] if best else None
    return out


@pytest.mark.parametrize("direction,exact,tolerance", [
    ("backward", True, None), ("backward", False, None), ("forward", False, 180), ("forward", True, 3), ("backward", True, 40)])
@pytest.mark.parametrize("bucket", [1, 16, 4096])
def test_asof_matches_brute_force(spark, direction, exact, tolerance, bucket):
    left, right = rows(1, 300, 1200), rows(2, 150, 1200)
    l = spark.createDataFrame(left, "id int, k string, t date")
    r = spark.createDataFrame(right, "seen int, k string, rt date")
    got = asof_join(l, r, "t", "rt", by=["k"], payload=["seen"], direction=direction, allow_exact=exact,
                    tolerance=tolerance, bucket=bucket, prefer="max" if direction == "backward" else "min")
    assert {x.id: x.seen for x in got.collect()} == brute(left, right, direction, exact, tolerance)


def test_asof_keeps_duplicate_and_null_rows(spark):
    l = spark.createDataFrame([(1, "a", DAY0), (2, "a", DAY0), (3, None, DAY0), (4, "a", None)], "id int, k string, t date")
    r = spark.createDataFrame([("a", DAY0, None), (None, DAY0, 1)], "k string, rt date, v int")
    got = {x.id: x.v for x in asof_join(l, r, "t", "rt", by=["k"], payload=["v"]).collect()}
    assert got == {1: None, 2: None, 3: None, 4: None}


def test_asof_on_timestamps_across_buckets(spark):
    l = spark.sql("select 1 id, timestamp'2024-01-02 00:00:00' t union all select 2, timestamp'2024-01-01 00:00:01'")
    r = spark.sql("select timestamp'2024-01-01 00:00:02' rt, 7 v")
    got = {x.id: x.v for x in asof_join(l, r, "t", "rt", payload=["v"]).collect()}
    assert got == {1: 7, 2: None}


def test_next_within_is_strict(spark):
    l = spark.createDataFrame([(1, "a", date(2024, 12, 31))], "id int, ticker string, period_end date")
    def found(*days):
        r = spark.createDataFrame([("a", d, str(d)) for d in days], "ticker string, filed date, acc string")
        return next_within(l, r, "period_end", "filed", ["ticker"], ["acc"], 180).first()["acc"]
    assert found(date(2024, 12, 31)) is None
    assert found(date(2025, 6, 29)) == "2025-06-29" and found(date(2025, 6, 30)) is None
    assert found(date(2025, 3, 1), date(2025, 2, 1)) == "2025-02-01"


def test_in_force_equals_range_join(spark):
    rng = random.Random(3)
    obs = [(s, DAY0 + timedelta(days=d), (None if rng.random() < 0.1 else float(d)))
           for s in "xy" for d in sorted(rng.sample(range(400), 25))]
    anchors = [(i, DAY0 + timedelta(days=rng.randrange(-20, 600))) for i in range(200)] + [(200, None), (201, None)]
    got = in_force(spark.createDataFrame(anchors, "id int, at date"),
                   spark.createDataFrame(obs, "s string, d date, v double"), {"x": "vx", "y": "vy"}, "s", "d", "v", "at")
    for r in got.collect():
        for s in "xy":
            before = [o for o in obs if o[0] == s and r.at is not None and o[1] <= r.at]
            assert r[f"v{s}"] == (max(before, key=lambda o: o[1])[2] if before else None)


def test_prefix_sums_and_auc_on_skewed_scores(spark):
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.5 else "b", round(rng.random() ** 6, 3), rng.randrange(2)) for _ in range(800)]
    df = spark.createDataFrame(data, "g string, predicted_score double, actual_direction int")
    def auc(part):
        pos = [s for _, s, y in part if y == 1]
        neg = [s for _, s, y in part if y == 0]
        return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert roc_auc(df).first()["auc"] == pytest.approx(auc(data), abs=1e-12)
    for r in roc_auc(df, by=["g"]).collect():
        assert r.auc == pytest.approx(auc([d for d in data if d[0] == r.g]), abs=1e-12)
    counts = df.groupBy("predicted_score").agg(F.count("*").alias("n"))
    total = 0
    for r in prefix_sums(counts, "predicted_score", ["n"]).orderBy("predicted_score").collect():
        assert r.before_n == total
        total += r.n


def test_auc_edge_cases(spark):
    def auc(*pairs):
        return roc_auc(spark.createDataFrame(list(pairs), "predicted_score double, actual_direction int")).first()["auc"]
    assert auc((0.1, 0), (0.9, 1)) == 1.0 and auc((0.5, 0), (0.5, 1)) == 0.5 and auc((0.5, 1), (0.7, 1)) is None


def test_exact_quantile(spark):
    import statistics
    rng = random.Random(5)
    a = [float(rng.choice([1, 1, 1, 2, 3])) for _ in range(101)]
    b = [rng.gauss(1e6, 10) if rng.random() > 0.2 else None for _ in range(101)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double")
    got = {r.feature: r.quantile for r in exact_quantile(df, ["a", "b"]).collect()}
    assert got["a"] == statistics.median(a)
    assert got["b"] == pytest.approx(statistics.median([x for x in b if x is not None]))


def test_running_total_blocks(spark):
    df = spark.createDataFrame([("r", i, float(i)) for i in range(200)], "run string, seq int, v double")
    for r in running_total(df, ["run"], "seq", "v", "sofar", block=7).collect():
        assert r.sofar == r.seq * (r.seq + 1) / 2


def test_running_total_keeps_rows_with_missing_keys(spark):
    rows = [(None, 1, 1.0), (None, 20, 2.0), ("r", None, 4.0), ("r", 1, 8.0), ("r", 9, None), ("r", 30, 16.0)]
    df = spark.createDataFrame(rows, "run string, seq int, v double")
    got = {(r.run, r.seq): (r.sofar, r.before) for r in running_total(df, ["run"], "seq", "v", "sofar", 7, "before").collect()}
    assert got == {(None, 1): (1, 0), (None, 20): (3, 1), ("r", None): (4, 0), ("r", 1): (12, 4), ("r", 9): (12, 12), ("r", 30): (28, 12)}


def test_year_neighbours_gaps_and_fan_out(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2021, 2.0), ("a", 2021, 3.0), ("a", 2023, 4.0), ("b", 2022, None),
                                ("a", None, 5.0), ("a", None, 6.0), (None, 2020, 7.0), (None, 2021, 8.0)],
                               "ticker string, fiscal_year int, revenue double")
    got = year_neighbours(df, ["ticker"], "fiscal_year", "revenue", {"nxt": 1, "prv": -1})
    self_join = spark.sql("""select c.ticker, c.fiscal_year, c.revenue, n.revenue nxt, p.revenue prv from {t} c
        left join {t} n on n.ticker = c.ticker and n.fiscal_year = c.fiscal_year + 1
        left join {t} p on p.ticker = c.ticker and p.fiscal_year = c.fiscal_year - 1""", t=df)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, self_join.collect()), key=key)


def test_rows_without_a_key_or_year_are_no_group(spark):
    n = 6000
    df = spark.range(n).select(
        F.when(F.col("id") < 6, F.lit("a")).alias("ticker"),
        (2000 + F.col("id") % 3).cast("int").alias("fiscal_year"),
        F.col("id").cast("double").alias("revenue"),
        F.create_map(F.lit("k"), "id").alias("extra"),
    )
    got = year_neighbours(df, ["ticker"], "fiscal_year", "revenue", {"nxt": 1})
    assert got.where("ticker IS NULL AND nxt IS NULL").count() == n - 6
    assert got.where("ticker = 'a'").count() == 10 and got.where("nxt IS NOT NULL").count() == 8
    one = df.where("ticker IS NULL OR revenue < 3")
    pairs = year_pairs(one, ["ticker"], "fiscal_year", ["revenue"])
    assert pairs.count() == n - 3 and pairs.where("prior_revenue IS NOT NULL").count() == 2
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for rows in (got, pairs):
            sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) < n / 2, "rows without a key are spread over the tasks"
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
