"""Universe loads, resumable batches, merged streams and counted runs on the driver tables."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import contract
from ..operators.loads import read_keyed
from ..operators.versions import VersionedTables
from ..plans import universe as un
from ..session import drop_folders, file_stamp, scratch_dir, written
from ..streaming import events as ev
from ..streaming import merge as mg
from . import standins as s
from .feeds import _HISTORY, _HISTORY_COLUMNS, macro_documents
from .models import ntz, rounded
from .quality_loads import _EVENT, _STATUS, _messages, event_lines
from .registry import query

# --- the small universe -------------------------------------------------------------
AS_OF = date(2024, 1, 20)
STAMP = datetime(2024, 2, 1, tzinfo=timezone.utc)
_WORDS = 60


def _submissions(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as companies, their orders as filings of one recent block each."""
    order = F.struct(
        s.text_of("F-", F.col("o_orderkey")).alias("accessionNumber"),
        F.when(F.col("o_orderkey") % 3 == 0, "10-K").otherwise("4").alias("form"),
        F.to_date("o_orderdate").cast("string").alias("filingDate"),
        F.lit("main.htm").alias("primaryDocument"),
    )
    lists = s.table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(order).alias("l"))
    fields = ("accessionNumber", "form", "filingDate", "primaryDocument")
    recent = F.struct(*[F.coalesce(F.col(f"l.{f}"), F.array()).alias(f) for f in fields])
    customers = s.table(spark, sf, "customer").join(lists, F.col("c_custkey") == F.col("o_custkey"), "left")
    payload = F.struct(
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") < 12, "2834").otherwise("7372").alias("sic"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).otherwise("").alias("sicDescription"),
        F.struct(recent.alias("recent")).alias("filings"),
    )
    return customers.select(
        s.text_of("c", F.col("c_custkey")).alias("ticker"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("cik"),
        F.to_json(payload).alias("payload"),
    )


def _bodies(spark: SparkSession, sf: str) -> DataFrame:
    """The page of every order's filing: two long sections between short ones."""
    key = F.col("o_orderkey")
    page = s.text_of(
        "<html><head><style>p{}</style></head><body><p>Item 1A. Risks</p><p>", F.repeat(s.text_of("risk ", key, " "), F.lit(_WORDS)),
        "</p><p>Item 2. Short</p><p>Item 7. Results</p><p>", F.repeat(s.text_of("profit &amp; loss ", key, " "), F.lit(_WORDS)),
        "</p><p>Item 8. Statements</p></body></html>",
    )
    url = s.text_of("https://www.sec.gov/Archives/edgar/data/", F.col("o_custkey"), "/F", key, "/main.htm")
    return s.table(spark, sf, "orders").select(url.alias("document_url"), page.alias("body"))


def _fact_documents(spark: SparkSession, sf: str) -> DataFrame:
    """All facts of a company as one nested document, lists in filing order."""
    entry = F.struct(
        "pos", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"),
        "val", F.year("end").alias("fy"), "fp", "form", F.col("filed").cast("string").alias("filed"),
    )
    lists = s.facts(spark, sf).groupBy("cik", "taxonomy", "concept", "unit").agg(
        F.sort_array(F.collect_list(entry)).alias("l")
    )
    units = F.struct(F.create_map(F.col("unit"), F.col("l")).alias("units"))
    concepts = lists.groupBy("cik", "taxonomy").agg(
        F.map_from_entries(F.collect_list(F.struct("concept", units))).alias("c")
    )
    nested = concepts.groupBy("cik").agg(F.map_from_entries(F.collect_list(F.struct("taxonomy", "c"))).alias("d"))
    return nested.select("cik", F.to_json("d").alias("payload"))


def _sources(spark: SparkSession, sf: str) -> un.Sources:
    customers = s.table(spark, sf, "customer")
    return un.Sources(
        tickers=customers.select(
            s.text_of("c", F.col("c_custkey")).alias("ticker"), F.col("c_custkey").alias("cik_str"), F.col("c_name").alias("title")
        ),
        submissions=_submissions(spark, sf),
        archives=spark.createDataFrame([], "cik string, name string, payload string"),
        bodies=_bodies(spark, sf),
        facts=_fact_documents(spark, sf),
        macro=macro_documents(spark, sf),
    )


_SECTION = "rtrim(repeat('{word} ' || {key} || ' ', 60))"


@query(
    "small_universe",
    f"""SELECT 'raw_companies' AS table_name, 'C' || c_custkey AS ticker, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS item,
            CAST(NULL AS DATE) AS day, c_name || '|' || CASE WHEN c_nationkey < 12 THEN 'Manufacturing' ELSE 'Services' END
                || '|' || CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment ELSE 'Unknown' END AS body, CAST(NULL AS DOUBLE) AS value
        FROM customer
        UNION ALL SELECT 'raw_filings', 'C' || o_custkey, 'F-' || o_orderkey, CAST(o_orderdate AS DATE),
            'Results' || chr(10) || {_SECTION.format(word="profit & loss", key="o_orderkey")} || '|Risks' || chr(10)
                || {_SECTION.format(word="risk", key="o_orderkey")}, NULL
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, 'F-' || o_orderkey) AS rn
              FROM orders WHERE o_orderkey % 3 = 0) WHERE rn <= 2
        UNION ALL SELECT 'raw_fundamentals', 'C' || CAST(cik AS BIGINT), CAST(fiscal_year AS VARCHAR), period_end_date, NULL, revenue
        FROM (SELECT {_HISTORY_COLUMNS}, row_number() OVER (PARTITION BY cik ORDER BY period_end_date DESC) AS rn FROM ({_HISTORY})) WHERE rn = 1
        UNION ALL SELECT 'raw_macro_observations', NULL, CASE event_type WHEN 'error' THEN 'FEDFUNDS' WHEN 'click' THEN 'T10Y2Y'
            WHEN 'view' THEN 'UNRATE' WHEN 'purchase' THEN 'CPIAUCSL' ELSE 'GDP' END, CAST(ts AS DATE), NULL, value
        FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
)
def _small_universe(spark: SparkSession, sf: str) -> DataFrame:
    """One load, then one that fails after its first tables: readers still see the first."""
    target = VersionedTables(spark, scratch_dir(spark, "universe-load"))
    tables = un.universe_tables(_sources(spark, sf), AS_OF, STAMP, lookback_days=10)
    target.publish(tables)
    broken = target.read("raw_companies").withColumn("ticker", F.raise_error(F.lit("lost source")).cast("string"))
    try:
        target.publish({"raw_macro_observations": target.read("raw_macro_observations"), "raw_companies": broken})
    except PySparkException:
        pass
    else:
        raise AssertionError("the broken load went through")
    now = target.read_all()
    none = F.lit(None)
    parts = {
        "raw_companies": ("ticker", F.col("cik"), none, F.concat_ws("|", "company_name", "sector", "industry"), none),
        "raw_filings": ("ticker", F.col("accession_number"), F.col("filing_date"), F.concat_ws("|", "mdna_text", "risk_factors_text"), none),
        "raw_fundamentals": ("ticker", F.col("fiscal_year").cast("string"), F.col("period_end_date"), none, F.col("revenue")),
        "raw_macro_observations": (none, F.col("series_id"), F.col("observation_date"), none, F.col("value")),
    }
    out = None
    for name, (ticker, item, day, body, value) in parts.items():
        ticker = F.col(ticker) if isinstance(ticker, str) else ticker
        one = now[name].select(
            F.lit(name).alias("table_name"), ticker.cast("string").alias("ticker"), item.alias("item"),
            day.cast("date").alias("day"), body.cast("string").alias("body"), value.cast("double").alias("value"),
        )
        out = one if out is None else out.unionByName(one)
    return out


# --- resumable batches ----------------------------------------------------------------
MIN_YEARS = 2


class _Interrupted(Exception):
    pass


@query(
    "resumable_run",
    f"""SELECT ticker AS member, CASE WHEN drop_reason IS NULL THEN 'done' ELSE 'dropped' END AS state, drop_reason AS reason,
            CASE WHEN drop_reason IS NULL THEN CAST(n_years AS BIGINT) END AS n_years, CASE WHEN drop_reason IS NULL THEN CAST(n_filings AS BIGINT) END AS n_filings,
            CASE WHEN drop_reason IS NULL THEN CAST(n_years AS BIGINT) ELSE 0 END AS stored_years,
            CASE WHEN drop_reason IS NULL THEN CAST(n_filings AS BIGINT) ELSE 0 END AS stored_filings FROM ({_STATUS})""",
)
def _resumable(spark: SparkSession, sf: str) -> DataFrame:
    """A run that is interrupted twice, once between its writes, and then goes on to the end.

    Per member its final state, the counts of the ledger and the rows that the tables hold.
    """
    members = s.companies(spark, sf).select("ticker")
    years = s.raw_fundamentals(spark, sf)
    annual = s.filing_facts(spark, sf).where("form_type = '10-K'").select("ticker", "accession_number", "filing_date")
    annual = written(annual, "annual-filings")
    ledger = un.RunLedger(spark, scratch_dir(spark, "run-ledger"))
    paths = {n: scratch_dir(spark, f"run-{n}") for n in ("fundamentals", "filings")}
    broken = {"batches": 1}

    def load(batch: DataFrame) -> un.Loaded:
        own = {
            "fundamentals": years.join(batch, "ticker", "left_semi"),
            "filings": annual.join(batch, "ticker", "left_semi"),
        }
        per = batch
        for name, column in (("fundamentals", F.countDistinct("fiscal_year")), ("filings", F.count(F.lit(1)))):
            per = per.join(own[name].groupBy("ticker").agg(column.alias(name)), "ticker", "left")
        n, f = F.coalesce("fundamentals", F.lit(0)), F.coalesce("filings", F.lit(0))
        reason = F.when(n < MIN_YEARS, F.concat(F.lit("too few annual years: "), n.cast("string"))).when(
            f == 0, F.lit("no annual filing in the window")
        )
        if broken["batches"] == 0:
            broken["batches"] = -1
            own["filings"] = own["filings"].withColumn("accession_number", F.raise_error(F.lit("lost")).cast("string"))
        elif broken["batches"] > 0:
            broken["batches"] -= 1
        return un.Loaded(own, per.select("ticker", reason.alias("reason")).where("reason IS NOT NULL"))

    size = max(1, members.count() // 3)
    try:
        un.run_batches(members, "ticker", ledger, load, paths, size)
    except PySparkException:
        pass
    un.run_batches(members, "ticker", ledger, load, paths, size, max_batches=1)
    un.run_batches(members, "ticker", ledger, load, paths, size)
    out = ledger.status()
    for name, table in (("years", "fundamentals"), ("filings", "filings")):
        source = years if table == "fundamentals" else annual
        stored = read_keyed(spark, paths[table], "ticker", ["ticker"], source.schema)
        found = stored.groupBy(F.col("ticker").alias("member")).agg(F.count(F.lit(1)).alias(f"stored_{name}"))
        out = out.join(found, "member", "left").withColumn(f"stored_{name}", F.coalesce(f"stored_{name}", F.lit(0)))
    return out.select(
        "member", "state", "reason",
        F.col("counts")["fundamentals"].alias("n_years"), F.col("counts")["filings"].alias("n_filings"),
        "stored_years", "stored_filings",
    )


# --- merged streams -------------------------------------------------------------------
_LATEST_KEYS = ["series_id", "observation_date"]


def _event_files(spark: SparkSession, sf: str, parts: int = 3) -> str:
    """Event messages as three groups of line files, the newest third first, the middle one repeated."""
    path = scratch_dir(spark, "lines")
    lines = event_lines(spark, sf).where("value is not null")
    for wanted in (2, 1, 0, 1):
        lines.where(F.col("event_id") % parts == wanted).select("value").coalesce(1).write.mode("append").text(path)
    return path


@query(
    "stream_incremental_upsert",
    """SELECT series_id, observation_date, value, ingested_at FROM (
        SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date, value, ts AS ingested_at,
            row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""",
)
def _incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Keep-latest by merging each micro-batch into the buckets it touches; a batch is replayed."""
    table = mg.LatestTable(spark, scratch_dir(spark, "latest"), _EVENT, _LATEST_KEYS)

    def handler(records: DataFrame, batch_id: int) -> None:
        table.merge(records, batch_id)
        table.merge(records, batch_id)

    lines = ev.read_lines(spark, _event_files(spark, sf), files_per_trigger=1)
    ev.run_stream(lines, "macro", handler, scratch_dir(spark, "dlq"), scratch_dir(spark, "checkpoint")).awaitTermination()
    return ntz(table.read(), "ingested_at")


@query(
    "stream_daily_signals",
    """SELECT coalesce(o.underlying, m.ticker, f.ticker) AS ticker, coalesce(o.activity_date, m.mention_date, f.filing_date) AS day,
            coalesce(flagged_contracts, 0) AS flagged_contracts, coalesce(total_volume, 0) AS total_volume,
            call_put_volume_ratio, max_volume_oi_ratio, avg_implied_volatility, coalesce(mention_count, 0) AS mention_count,
            coalesce(total_score, 0) AS total_score, coalesce(total_comments, 0) AS total_comments, coalesce(filings_filed, 0) AS filings_filed
        FROM options_flow o FULL JOIN sentiment m ON o.underlying = m.ticker AND o.activity_date = m.mention_date
        FULL JOIN filing_days f ON f.ticker = coalesce(o.underlying, m.ticker) AND f.filing_date = coalesce(o.activity_date, m.mention_date)""",
)
def _daily_signals(spark: SparkSession, sf: str) -> DataFrame:
    """Three streams summed per ticker and day, with rows that come too late in a side table.

    The rows of every seventh day come after all others, so they are late for
    closed days; the daily table and the late rows together are the batch result.
    """
    events = mg.signal_events(s.options(spark, sf), s.mentions(spark, sf), s.filing_facts(spark, sf))
    events = written(events, "signal-events")
    source, checkpoint = scratch_dir(spark, "signal-source"), scratch_dir(spark, "checkpoint")
    table = mg.DailySignals(spark, scratch_dir(spark, "daily"))
    held_back = F.datediff("day", F.lit("1992-01-01").cast("date")) % 7 == 0
    for rows in (events.where(~held_back), events.where(held_back)):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        mg.run_daily_signals(stream, table, checkpoint)
    whole = mg.daily_sums(table.read().unionByName(table.late_rows().drop("event_time")))
    calls, puts = F.col("call_volume"), F.col("put_volume")
    found = whole.select(
        "ticker", "day", "flagged_contracts", "total_volume",
        (calls.cast("double") / F.nullif(puts, F.lit(0))).alias("call_put_volume_ratio"),
        "max_volume_oi_ratio",
        (F.col("iv_sum") / F.nullif(F.col("iv_count"), F.lit(0))).alias("avg_implied_volatility"),
        "mention_count", "total_score", "total_comments", "filings_filed",
    )
    return rounded(found, 8, "avg_implied_volatility")


#: Lines of a compressed file, which one task reads.
LINES_PER_FILE = 100_000
#: Micro-batches of a run, at most.
MICRO_BATCHES = 32


def _line_files(spark: SparkSession, lines: DataFrame, path: str) -> int:
    """Write lines as compressed files; returns how many of them a micro-batch takes.

    A compressed file is not split, so that is one per core, and more where there are very many.
    """
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE).text(path)
    files = sum(1 for name, *_ in file_stamp(spark, path) if name.endswith(".gz"))
    return max(spark.sparkContext.defaultParallelism, -(-files // MICRO_BATCHES))


@query(
    "stream_counts",
    """SELECT 'macro' AS stream, (SELECT count(*) FROM events) AS published, (SELECT 3 * count(*) FROM events) AS dead
        UNION ALL SELECT 'options', count(*), 0 FROM lineitem
        UNION ALL SELECT 'options/implied_volatility', count(*) FILTER (l_tax = 0), 0 FROM lineitem""",
)
def _stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Published, dead-lettered and missing values of all micro-batches, observed while they are written.

    Only the counts are read once a stream has ended; its lines and what it landed are deleted then.
    """
    out = None
    for stream in ("macro", "options"):
        counts = scratch_dir(spark, "counts")
        path, landed, dlq, checkpoint = (scratch_dir(spark, n) for n in ("lines", "landed", "dlq", "checkpoint"))
        if stream == "macro":
            lines = event_lines(spark, sf).where("value is not null").select("value")
        else:
            messages = _messages(spark, sf, stream)
            lines = messages.select(F.to_json(F.struct(*messages.columns)).alias("value"))
        per_trigger = _line_files(spark, lines, path)
        mg.run_counted(
            ev.read_lines(spark, path, files_per_trigger=per_trigger), stream, ev.landing_handler(stream, landed),
            dlq, counts, checkpoint,
        )
        drop_folders(spark, [path, landed, dlq, checkpoint])
        found = mg.published_counts(spark, counts)
        total = found.groupBy("stream").agg(F.sum("published").alias("published"), F.sum("dead").alias("dead"))
        missing = found.select("stream", F.explode("missing").alias("field", "n")).groupBy("stream", "field").agg(F.sum("n").alias("published"))
        missing = missing.select(F.concat_ws("/", "stream", "field").alias("stream"), "published", F.lit(0).cast("long").alias("dead"))
        both = total.unionByName(missing)
        out = both if out is None else out.unionByName(both)
    return out


@query(
    "bounded_runs",
    """SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date, value, 3 AS runs FROM events""",
)
def _bounded(spark: SparkSession, sf: str) -> DataFrame:
    """Runs that stop after a third of the messages and go on from the checkpoint until nothing is left.

    All three handle something and together land every message once.
    """
    path, landed, counts = (scratch_dir(spark, n) for n in ("lines", "landed", "counts"))
    lines = event_lines(spark, sf).where("kind = 0")
    n = lines.count()
    lines.select("value").repartition(9).write.text(path)
    dlq, checkpoint = scratch_dir(spark, "dlq"), scratch_dir(spark, "checkpoint")
    handled = []
    while not handled or handled[-1]:
        handled.append(
            mg.run_counted(
                ev.read_lines(spark, path, files_per_trigger=1), "macro", ev.landing_handler("macro", landed),
                dlq, counts, checkpoint, max_messages=n // 3 + 1,
            )
        )
    runs = sum(1 for h in handled if h)
    rows = ev.read_landed(spark, landed, contract("raw_macro_observations"))
    return rows.select("series_id", "observation_date", "value", F.lit(runs).alias("runs"))
