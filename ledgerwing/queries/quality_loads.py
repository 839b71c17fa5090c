"""Data-quality rules, idempotent loads and event streams on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import conform, contract
from ..operators import loads
from ..operators import quality as q
from ..session import scratch_dir, written
from ..plans.build import MARTS, build_models, check_models
from ..sources.feeds import fetch_sections, index_rows, unusual_activity
from ..streaming import events as ev
from . import standins as s
from .feeds import PAGE_TEXT
from .models import exported, ntz, rounded
from .registry import query


def flawed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with planted faults: shared keys, missing and odd values, bad references."""
    key = F.col("o_orderkey")
    return s.table(spark, sf, "orders").select(
        F.when(key % 50 == 0, F.lit(0)).otherwise(key).alias("row_key"),
        F.when(key % 7 == 0, None).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(key % 11 == 0, F.lit("?")).otherwise(F.col("o_orderstatus")).alias("status_code"),
        (F.col("o_custkey") + F.when(key % 13 == 0, 10_000_000).otherwise(0)).alias("owner"),
        F.col("o_totalprice").alias("ratio"),
        F.when(key % 3 == 0, "pending").otherwise("scored").alias("status"),
        F.when(key % 5 == 0, None).otherwise(F.lit(True)).alias("correct"),
    )


_FLAWED = """(SELECT CASE WHEN o_orderkey % 50 = 0 THEN 0 ELSE o_orderkey END AS row_key,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority,
    CASE WHEN o_orderkey % 11 = 0 THEN '?' ELSE o_orderstatus END AS status_code,
    o_custkey + CASE WHEN o_orderkey % 13 = 0 THEN 10000000 ELSE 0 END AS owner, o_totalprice AS ratio,
    CASE WHEN o_orderkey % 3 = 0 THEN 'pending' ELSE 'scored' END AS status,
    CASE WHEN o_orderkey % 5 <> 0 THEN true END AS correct FROM orders)"""


def owners(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"owners": s.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))}


RULES = {
    "dq_unique": (q.unique("row_key"), f"SELECT row_key, count(*) AS n_rows FROM {_FLAWED} GROUP BY row_key HAVING count(*) > 1"),
    "dq_not_null": (q.not_null("priority"), f"SELECT * FROM {_FLAWED} WHERE priority IS NULL"),
    "dq_accepted_values": (
        q.accepted("status_code", "F", "O", "P"),
        f"SELECT * FROM {_FLAWED} WHERE status_code NOT IN ('F', 'O', 'P')",
    ),
    "dq_relationships": (
        q.relationship("owner", "owners", "id"),
        f"SELECT * FROM {_FLAWED} WHERE owner NOT IN (SELECT c_custkey FROM customer)",
    ),
    "dq_bounds": (
        q.bounds("ratio", 10_000, 400_000, where="status = 'scored'"),
        f"SELECT * FROM {_FLAWED} WHERE status = 'scored' AND (ratio < 10000 OR ratio > 400000)",
    ),
    "dq_invariant": (
        q.invariant("correct_iff_scored", q.PENDING_INVARIANT),
        f"SELECT * FROM {_FLAWED} WHERE (status = 'pending' AND correct IS NOT NULL) OR (status = 'scored' AND correct IS NULL)",
    ),
}


def _rule_query(rule: q.Rule):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return q.offending(flawed(spark, sf), rule, owners(spark, sf))

    return run


for _name, (_rule, _sql) in RULES.items():
    query(_name, _sql)(_rule_query(_rule))


@query(
    "run_checks",
    " UNION ALL ".join(
        f"SELECT 'flawed' AS model, '{rule.label}' AS rule, count(*) AS failures FROM ({sql})"
        for rule, sql in RULES.values()
    ),
)
def _checks(spark: SparkSession, sf: str) -> DataFrame:
    return q.run_checks(
        "flawed", flawed(spark, sf), [r for r, _ in RULES.values()], owners(spark, sf)
    )


@query(
    "model_checks",
    """SELECT 'ml_features' AS model, 'unique(ml_row_id)' AS rule, count(*) AS failures FROM
            (SELECT ml_row_id FROM panel GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'ml_features', 'not_null(fed_funds_rate)', count(*) FROM panel WHERE fed_funds_rate IS NULL
        UNION ALL SELECT 'ml_features', 'accepted_values(label)', count(*) FROM panel WHERE label NOT IN (0, 1)
        UNION ALL SELECT 'ml_features', 'bounds(net_margin)', count(*) FROM panel WHERE net_margin < -20 OR net_margin > 3
        UNION ALL SELECT 'ml_features', 'relationships(ticker)', count(*) FROM panel WHERE ticker NOT IN (SELECT ticker FROM companies)""",
)
def _model_checks(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        q.unique("ml_row_id"),
        q.not_null("fed_funds_rate"),
        q.accepted("label", 0, 1),
        q.bounds("net_margin", -20, 3),
        q.relationship("ticker", "stg_companies", "ticker"),
    ]
    return q.run_checks(
        "ml_features", s.panel(spark, sf), rules, {"stg_companies": s.companies(spark, sf)}
    )


_STATUS = """SELECT c.ticker, coalesce(y.n, 0) AS n_years, coalesce(f.n, 0) AS n_filings, coalesce(f.p, 0) AS n_parsed,
    CASE WHEN coalesce(y.n, 0) < 2 THEN 'too few annual years: ' || coalesce(y.n, 0)
         WHEN coalesce(f.n, 0) = 0 THEN 'no annual filing in the window' END AS drop_reason
    FROM companies c LEFT JOIN (SELECT ticker, count(DISTINCT fiscal_year) AS n FROM fundamentals GROUP BY 1) y USING (ticker)
    LEFT JOIN (SELECT ticker, count(*) AS n, count(*) FILTER (coalesce(mdna_text, '') <> '' OR coalesce(risk_factors_text, '') <> '') AS p
        FROM filings WHERE form_type = '10-K' GROUP BY 1) f USING (ticker)"""


def status(spark: SparkSession, sf: str) -> DataFrame:
    """Load status; the text is reduced to a flag before the deduplication."""
    flag = (F.coalesce("mdna_text", F.lit("")) != "") | (F.coalesce("risk_factors_text", F.lit("")) != "")
    narrow = s.raw_filings(spark, sf).withColumn("mdna_text", F.when(flag, "x")).withColumn(
        "risk_factors_text", F.lit(None).cast("string")
    )
    return loads.backfill_status(
        s.companies(spark, sf), s.fundamentals(spark, sf), s.staging.filings(narrow)
    )


query("backfill_status", _STATUS)(status)


@query(
    "backfill_summary",
    f"""SELECT count(*) FILTER (drop_reason IS NULL) AS loaded, count(*) FILTER (drop_reason IS NOT NULL) AS dropped,
        CAST(sum(n_years) FILTER (drop_reason IS NULL) AS BIGINT) AS fundamentals_rows,
        CAST(sum(n_filings) FILTER (drop_reason IS NULL) AS BIGINT) AS filing_rows,
        CAST(sum(n_parsed) FILTER (drop_reason IS NULL) AS BIGINT) AS sections_parsed,
        CAST(sum(n_parsed) FILTER (drop_reason IS NULL) AS DOUBLE) / sum(n_filings) FILTER (drop_reason IS NULL) AS parse_rate
        FROM ({_STATUS})""",
)
def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return loads.backfill_summary(status(spark, sf))


@query(
    "pending_members",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
)
def _pending(spark: SparkSession, sf: str) -> DataFrame:
    members = s.table(spark, sf, "customer").select("c_custkey", "c_name")
    done = s.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("c_custkey")
    )
    return loads.pending_members(members, done, "c_custkey")


@query(
    "conform_append",
    """SELECT series_id, observation_date, value, CAST(NULL AS TIMESTAMP) AS ingested_at
        FROM macro CROSS JOIN (VALUES (0), (1)) v(i)""",
)
def _append(spark: SparkSession, sf: str) -> DataFrame:
    """Appended twice, with shouting column names and one column missing."""
    path = scratch_dir(spark, "append")
    rows = s.macro(spark, sf).select(
        F.col("value").alias("VALUE"), F.col("series_id").alias("Series_ID"), "observation_date"
    )
    loads.append_rows(rows, "raw_macro_observations", path)
    loads.append_rows(rows, "RAW_MACRO_OBSERVATIONS", path)
    table = spark.read.schema(contract("raw_macro_observations")).parquet(path)
    return ntz(table, "ingested_at")


@query(
    "overwrite",
    "SELECT series_id, observation_date, value FROM macro",
)
def _overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "overwrite")
    loads.replace_table(s.macro(spark, sf).drop("macro_observation_id"), "raw_macro_observations", path)
    again = s.macro(spark, sf).drop("macro_observation_id")
    loads.replace_table(again, "raw_macro_observations", path)
    return spark.read.parquet(path).drop("ingested_at")


@query(
    "replace_keys",
    """SELECT l_orderkey, l_quantity + CASE WHEN l_returnflag = 'R' THEN 1000 ELSE 0 END AS l_quantity, l_returnflag FROM lineitem""",
)
def _replace(spark: SparkSession, sf: str) -> DataFrame:
    """Load all keys, then replace one key twice; the others stay."""
    path = scratch_dir(spark, "keyed")
    rows = s.table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    loads.replace_keys(rows, path, "l_returnflag")
    newer = rows.where("l_returnflag = 'R'").withColumn("l_quantity", F.col("l_quantity") + 1000)
    loads.replace_keys(newer, path, "l_returnflag")
    loads.replace_keys(newer, path, "l_returnflag")
    return loads.read_keyed(spark, path, "l_returnflag", rows.columns, rows.schema)


@query(
    "delete_keys",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey % 4 <> 0""",
)
def _delete(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth customer is deleted, no rows replace theirs."""
    path = scratch_dir(spark, "keyed")
    rows = s.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    loads.replace_keys(rows, path, "o_custkey")
    loads.delete_keys(rows.where("o_custkey % 4 = 0"), path, "o_custkey", rows.schema)
    return loads.read_keyed(spark, path, "o_custkey", rows.columns, rows.schema)


@query(
    "merged_by_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW')
        UNION ALL SELECT o_custkey, o_orderkey, -o_totalprice FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def _merged(spark: SparkSession, sf: str) -> DataFrame:
    orders = s.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    current = orders.drop("o_orderpriority")
    incoming = orders.where("o_orderpriority = '5-LOW'").select(
        "o_custkey", "o_orderkey", (-F.col("o_totalprice")).alias("o_totalprice")
    )
    return loads.merged_by_key(current, incoming, "o_custkey")


@query(
    "load_counts",
    """SELECT 'companies' AS table_name, count(*) AS n_rows FROM companies UNION ALL
        SELECT 'fundamentals', count(*) FROM fundamentals UNION ALL SELECT 'macro', count(*) FROM macro""",
)
def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return loads.load_counts(
        {
            "companies": s.companies(spark, sf),
            "fundamentals": s.fundamentals(spark, sf),
            "macro": s.macro(spark, sf),
        }
    )


@query(
    "snapshot_round_trip",
    "SELECT ticker, fiscal_year, predicted_score AS score, status FROM panel_outcomes",
)
def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "predictions")
    exported(spark, sf).write.parquet(path)
    return spark.read.parquet(path).select("ticker", "fiscal_year", "score", "status")


@query(
    "filing_ingest",
    f"""SELECT 'F-' || page_id AS accession_number, lpad(CAST(page_id AS VARCHAR), 10, '0') AS cik, 'T' || (page_id % 50) AS ticker,
            url AS company_name, '10-K' AS form_type, DATE '2024-01-31' AS filing_date,
            'https://www.sec.gov/Archives/edgar/data/' || page_id || '/F' || page_id || '/main.htm' AS document_url,
            CASE WHEN length(t) >= 200 THEN t END AS mdna_text, CAST(NULL AS VARCHAR) AS risk_factors_text,
            TIMESTAMP '2024-02-01 00:00:00' AS ingested_at
        FROM (SELECT *, regexp_replace('Discussion' || chr(10) || {PAGE_TEXT}, '^\\s+|\\s+$', '', 'g') AS t FROM pages)""",
)
def _ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Index rows, page text, sections, landing table replaced by ticker, loaded twice."""
    pages = s.table(spark, sf, "pages")
    index = pages.select(
        F.lpad(F.col("page_id").cast("string"), 10, "0").alias("cik"),
        s.text_of("T", F.col("page_id") % 50).alias("ticker"),
        F.col("url").alias("company_name"),
        "html",
        F.struct(
            F.array(s.text_of("F-", F.col("page_id"))).alias("accessionNumber"),
            F.array(F.lit("10-K")).alias("form"),
            F.array(F.lit("2024-01-31")).alias("filingDate"),
            F.array(F.lit("main.htm")).alias("primaryDocument"),
        ).alias("block"),
    )
    filings = index_rows(index, "block", keep=["cik", "ticker", "company_name", "html"])
    parsed = fetch_sections(
        filings.withColumn("body", F.concat(F.lit("<p>Item 7. Discussion</p>"), "html"))
    )
    stamp = F.lit("2024-02-01 00:00:00").cast("timestamp")
    landed = parsed.withColumns(
        {"mdna_text": F.col("mdna"), "risk_factors_text": F.col("risk_factors"), "ingested_at": stamp}
    )
    rows = conform(landed.select(*contract("raw_filings").names), "raw_filings")
    path = scratch_dir(spark, "raw_filings")
    loads.replace_keys(rows, path, "ticker")
    loads.replace_keys(rows, path, "ticker")
    return ntz(loads.read_keyed(spark, path, "ticker", rows.columns, rows.schema), "ingested_at")


def built(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    raw = {
        "raw_companies": s.raw_companies(spark, sf),
        "raw_filings": s.raw_filings(spark, sf),
        "raw_fundamentals": s.raw_fundamentals(spark, sf),
        "raw_macro_observations": s.raw_macro(spark, sf),
        "raw_options_activity": unusual_activity(s.contracts(spark, sf)),
        "raw_sentiment_mentions": s.raw_mentions(spark, sf),
        "raw_model_predictions": s.predictions(spark, sf),
    }
    return build_models(
        spark, raw, scratch_dir(spark, "marts"), s.KEYWORDS, s.EXCLUDED, train_through=s.TRAIN_THROUGH
    )


_BUILT = {
    "company_profile": "profiles",
    "filing_history": "(SELECT * FROM filings JOIN companies USING (ticker))",
    "signal_history": "signals",
    "sector_summary": "(SELECT DISTINCT sector FROM companies)",
    "ml_training_set": "(SELECT * FROM panel WHERE label IS NOT NULL)",
    "ml_inference_set": "(SELECT * FROM panel WHERE label IS NULL)",
    "prediction_outcomes": "panel_outcomes",
}


@query(
    "build_models",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}" for name, source in _BUILT.items()
    ),
)
def _build(spark: SparkSession, sf: str) -> DataFrame:
    """The whole transform graph, written mart by mart; rows per mart."""
    models = built(spark, sf)
    return loads.load_counts({name: models[name] for name in MARTS})


#: Each model as SQL, with the columns that its rules name.
_MODELS = {
    "stg_companies": "SELECT ticker, cik, sector FROM companies",
    "stg_filings": "SELECT accession_number, ticker, filing_date, form_type FROM filings",
    "stg_fundamentals": "SELECT fundamental_id, ticker, revenue FROM fundamentals",
    "stg_macro_observations": "SELECT macro_observation_id, value, series_id FROM macro",
    "stg_options_activity": "SELECT contract_ticker || '|' || detected_at AS activity_id, volume_oi_ratio, contract_type FROM options",
    "stg_sentiment_mentions": "SELECT mention_id, subreddit FROM mentions",
    "stg_model_predictions": "SELECT ticker, fiscal_year, predicted_score, predicted_direction FROM predictions",
    "int_financial_ratios": "SELECT fundamental_id, sector, pe_ratio, debt_to_equity, net_margin, gross_margin FROM ratios",
    "int_filing_language_features": "SELECT accession_number, risk_word_total FROM language",
    "int_options_flow_daily": "SELECT underlying || '|' || activity_date AS flow_id, total_volume FROM options_flow",
    "int_sentiment_daily": "SELECT ticker || '|' || mention_date AS sentiment_id, mention_count FROM sentiment",
    "company_profile": "SELECT ticker, sector, pe_ratio FROM profiles",
    "filing_history": "SELECT f.accession_number, f.ticker, f.filing_date FROM filings f JOIN companies c ON c.ticker = f.ticker",
    "signal_history": "SELECT signal_id, ticker, composite_signal_score FROM signals",
    "sector_summary": "SELECT sector, count(*) AS company_count FROM companies GROUP BY sector",
    "ml_training_set": "SELECT ml_row_id, label, ticker, fiscal_year, sector, revenue, fed_funds_rate, yield_curve_spread FROM panel WHERE label IS NOT NULL",
    "ml_inference_set": "SELECT ml_row_id, ticker, revenue FROM panel WHERE label IS NULL",
    "prediction_outcomes": "SELECT prediction_id, ticker, fiscal_year, predicted_direction, actual_direction, status, data_split, correct FROM panel_outcomes",
}
_OUTSIDE = f"sector is null or sector != '{s.EXCLUDED}'"


_ALL_CHECKS = " UNION ALL ".join(
    q.checks_sql(m, sql, q.model_rules(_OUTSIDE)[m], _MODELS) for m, sql in _MODELS.items()
)


@query("check_models", _ALL_CHECKS)
def _check_models(spark: SparkSession, sf: str) -> DataFrame:
    """Failures of every rule of every model."""
    return written(check_models(built(spark, sf), _OUTSIDE), "rule-failures")


_SHOWN = (
    ("company_profile", "bounds(pe_ratio)"),
    ("filing_history", "unique(accession_number)"),
    ("int_financial_ratios", "bounds(debt_to_equity)"),
    ("int_financial_ratios", "bounds(net_margin)"),
    ("ml_training_set", "not_null(fed_funds_rate)"),
    ("prediction_outcomes", "invariant(correct_iff_scored)"),
    ("signal_history", "relationships(ticker)"),
    ("stg_options_activity", "unique(activity_id)"),
)


@query(
    "rule_lookup",
    f"SELECT * FROM ({_ALL_CHECKS}) WHERE " + " OR ".join(f"model = '{m}' AND rule = '{r}'" for m, r in _SHOWN),
)
def _rule_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Some rules by model and label, looked up in the failures of all of them."""
    wanted = [(F.col("model") == m) & (F.col("rule") == r) for m, r in _SHOWN]
    return _check_models(spark, sf).where(reduce(Column.__or__, wanted))


# --- events ---------------------------------------------------------------------
_EVENT = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("observation_date", T.DateType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as macro messages, each followed by faulty ones of every kind."""
    good = F.to_json(
        F.struct(
            F.col("event_type").alias("series_id"),
            F.to_date("ts").cast("string").alias("observation_date"),
            "value",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingested_at"),
        )
    )
    values = F.array(
        good,
        F.lit("not json"),
        F.replace(good, F.lit('"value":'), F.lit('"value":"not-a-float","was":')),
        F.replace(good, F.lit('"value":'), F.lit('"other":')),
        F.lit(""),
        F.lit(None).cast("string"),
    )
    rows = s.table(spark, sf, "events").select("event_id", F.posexplode(values).alias("kind", "value"))
    return rows.select(F.concat_ws("/", "event_id", "kind").alias("key"), "value", "event_id", "kind")


@query(
    "dead_letters",
    """SELECT 'macro.raw' AS source_topic, event_id || '/' || k AS key,
        CASE k WHEN 3 THEN 'MissingField' WHEN 0 THEN 'Rejected' ELSE 'CorruptRecord' END AS error_type,
        CASE k WHEN 3 THEN 'missing: value' WHEN 0 THEN 'too large' ELSE 'value is not a record of the expected type' END AS error_message,
        CASE k WHEN 0 THEN 'handler' ELSE 'deserialization' END AS stage,
        to_base64(encode(CASE k WHEN 0 THEN j WHEN 1 THEN 'not json' WHEN 2 THEN replace(j, '"value":', '"value":"not-a-float","was":')
            ELSE replace(j, '"value":', '"other":') END)) AS payload
        FROM (SELECT *, '{"series_id":"' || event_type || '","observation_date":"' || CAST(ts AS DATE) || '","value":' || value
            || ',"ingested_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS j FROM events)
        CROSS JOIN (VALUES (0), (1), (2), (3)) v(k) WHERE k > 0 OR value > 60""",
)
def _dead(spark: SparkSession, sf: str) -> DataFrame:
    lines = event_lines(spark, sf).select("key", "value")
    _, dead = ev.route_dead_letters(lines, "macro", {"too large": F.col("record.value") > 60})
    return dead.select(
        "source_topic",
        "key",
        "error_type",
        "error_message",
        F.col("context")["stage"].alias("stage"),
        F.col("payload_b64").alias("payload"),
    )


@query(
    "good_records",
    """SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date, value, ts AS ingested_at FROM events""",
)
def _good(spark: SparkSession, sf: str) -> DataFrame:
    good, _ = ev.route_dead_letters(event_lines(spark, sf).select("key", "value"), "macro")
    return ntz(good, "ingested_at")


@query(
    "serialisation_failures",
    """SELECT event_id || '' AS key, 'missing: value' AS error_message FROM events WHERE value > 50""",
)
def _unserialisable(spark: SparkSession, sf: str) -> DataFrame:
    rows = s.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("message_key"),
        F.col("event_type").alias("series_id"),
        F.to_date("ts").alias("observation_date"),
        F.when(F.col("value") <= 50, F.col("value")).alias("value"),
        F.col("ts").alias("ingested_at"),
    )
    _, dead = ev.serialise(rows, "macro", "message_key")
    return dead.select("key", "error_message")


def write_lines(spark: SparkSession, sf: str) -> str:
    """Event messages as text files for a file stream, faults included."""
    path = scratch_dir(spark, "lines")
    # Line files hold no NULL; the tombstones stay as empty lines.
    event_lines(spark, sf).where("value is not null").select("value").write.text(path)
    return path


@query(
    "stream_dead_letters",
    """SELECT error_type, count(*) AS n FROM (SELECT CASE k WHEN 3 THEN 'MissingField' ELSE 'CorruptRecord' END AS error_type
        FROM events CROSS JOIN (VALUES (1), (2), (3)) v(k)) GROUP BY 1
        UNION ALL SELECT 'none', count(*) FROM events""",
)
def _stream_dead(spark: SparkSession, sf: str) -> DataFrame:
    """A file stream: good rows land, faulty ones go to the dead letters."""
    landed, dlq = scratch_dir(spark, "landed"), scratch_dir(spark, "dlq")
    lines = ev.read_lines(spark, write_lines(spark, sf))
    run = ev.run_stream(
        lines,
        "macro",
        lambda df, batch_id: ev.land(df, landed, batch_id),
        dlq,
        scratch_dir(spark, "checkpoint"),
    )
    run.awaitTermination()
    dead = spark.read.parquet(dlq).select("error_type")
    good = ev.read_landed(spark, landed, _EVENT).select(F.lit("none").alias("error_type"))
    return dead.unionByName(good).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_upsert",
    """SELECT series_id, observation_date, value, ingested_at FROM (
        SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date, value, ts AS ingested_at,
            row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""",
)
def _stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Keep-latest table of a stream, compacted to a new folder."""
    landed = scratch_dir(spark, "landed")
    lines = ev.read_lines(spark, write_lines(spark, sf))
    run = ev.run_stream(
        lines,
        "macro",
        lambda df, batch_id: ev.land(df, landed, batch_id),
        scratch_dir(spark, "dlq"),
        scratch_dir(spark, "checkpoint"),
    )
    run.awaitTermination()
    table = ev.compact(
        spark,
        ev.read_landed(spark, landed, _EVENT),
        ["series_id", "observation_date"],
        "ingested_at",
        scratch_dir(spark, "latest"),
    )
    return ntz(table, "ingested_at")


_STAMP = "2024-01-31T00:00:00"


def _messages(spark: SparkSession, sf: str, stream: str) -> DataFrame:
    """One record of the stream per row of a driver table, as JSON."""
    stamp = F.lit(_STAMP).alias("ingested_at")
    day = F.lit("2024-01-31")
    if stream == "filing":
        doc = F.col("doc_id")
        sections = F.map_filter(
            F.create_map(F.lit("mdna"), F.col("text"), F.lit("risk_factors"), F.when(doc % 3 == 0, F.col("source"))),
            lambda k, v: v.isNotNull(),
        )
        return s.table(spark, sf, "documents").select(
            s.text_of("A", doc).alias("accession_number"), s.text_of(doc % 99).alias("cik"),
            F.when(doc % 2 == 0, "T").alias("ticker"), F.col("source").alias("company_name"), F.lit("10-K").alias("form_type"),
            day.alias("filing_date"), s.text_of("doc/", doc).alias("document_url"), F.col("source").alias("raw_text"),
            sections.alias("sections"), stamp,
        )
    if stream == "sentiment":
        event = F.col("event_id")
        tickers = F.when(event % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("AA"), F.col("event_type")))
        return s.table(spark, sf, "events").select(
            s.text_of("e", event).alias("post_id"), F.lit("stocks").alias("subreddit"), F.col("event_type").alias("title"),
            F.lit("").alias("body"), F.floor("value").cast("int").alias("score"), (event % 50).cast("int").alias("num_comments"),
            tickers.alias("tickers"), F.lit(_STAMP).alias("created_at"), stamp,
        )
    if stream == "transcript":
        turn = F.struct(
            F.col("role").alias("speaker"), F.lit("r").alias("role"), F.lit("qa").alias("section"), F.col("text").alias("text")
        )
        return s.table(spark, sf, "conversations").select(
            F.lit("Co").alias("company_name"), F.when(F.col("turn") % 2 == 0, "T").alias("ticker"), F.lit(2).alias("quarter"),
            F.lit(2024).alias("fiscal_year"), s.text_of(F.col("conv_id"), "/", F.col("turn")).alias("url"),
            F.array(turn, turn).alias("segments"), stamp,
        )
    if stream == "options":
        return s.table(spark, sf, "lineitem").select(
            s.text_of("C", F.col("l_partkey")).alias("underlying"),
            s.text_of("O", F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("contract_ticker"), F.lit("put").alias("contract_type"),
            F.col("l_extendedprice").alias("strike"), day.alias("expiration"), F.col("l_quantity").cast("long").alias("day_volume"),
            F.col("l_linenumber").cast("long").alias("open_interest"), F.col("l_tax").alias("volume_oi_ratio"),
            F.when(F.col("l_tax") > 0, F.col("l_discount")).alias("implied_volatility"), F.lit(_STAMP).alias("detected_at"),
        )
    return s.table(spark, sf, "events").select(
        F.col("event_type").alias("series_id"), F.to_date("ts").cast("string").alias("observation_date"), "value", stamp
    )


_AT = "TIMESTAMP '2024-01-31 00:00:00'"
_LANDED = {
    "filing": f"""SELECT 'A' || doc_id AS accession_number, CAST(doc_id % 99 AS VARCHAR) AS cik, CASE WHEN doc_id % 2 = 0 THEN 'T' END AS ticker,
        source AS company_name, '10-K' AS form_type, DATE '2024-01-31' AS filing_date, 'doc/' || doc_id AS document_url, text AS mdna_text,
        CASE WHEN doc_id % 3 = 0 THEN source END AS risk_factors_text, {_AT} AS ingested_at FROM documents""",
    "sentiment": f"""SELECT 'e' || event_id AS post_id, 'stocks' AS subreddit, CASE i WHEN 0 THEN 'AA' ELSE event_type END AS ticker,
        event_type AS title, CAST(floor(value) AS INTEGER) AS score, CAST(event_id % 50 AS INTEGER) AS num_comments, {_AT} AS created_at,
        {_AT} AS ingested_at FROM events CROSS JOIN (VALUES (0), (1)) v(i) WHERE event_id % 3 <> 0""",
    "transcript": f"""SELECT conv_id || '/' || turn AS url, CASE WHEN turn % 2 = 0 THEN 'T' END AS ticker, 'Co' AS company_name,
        2024 AS fiscal_year, 2 AS fiscal_quarter, i AS segment_index, role AS speaker, 'r' AS role, 'qa' AS section, text, {_AT} AS ingested_at
        FROM conversations CROSS JOIN (VALUES (1), (2)) v(i)""",
    "options": f"""SELECT 'C' || l_partkey AS underlying, 'O' || l_orderkey || '-' || l_linenumber AS contract_ticker, 'put' AS contract_type,
        CAST(l_extendedprice AS DOUBLE) AS strike, DATE '2024-01-31' AS expiration, CAST(l_quantity AS BIGINT) AS day_volume,
        CAST(l_linenumber AS BIGINT) AS open_interest, CAST(l_tax AS DOUBLE) AS volume_oi_ratio,
        CASE WHEN l_tax > 0 THEN CAST(l_discount AS DOUBLE) END AS implied_volatility, {_AT} AS detected_at FROM lineitem""",
    "macro": f"""SELECT event_type AS series_id, CAST(ts AS DATE) AS observation_date, value, {_AT} AS ingested_at FROM events""",
}


def _landed(stream: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        """A file stream of a stream's records into its landing table."""
        lines, landed = scratch_dir(spark, "lines"), scratch_dir(spark, "landed")
        messages = _messages(spark, sf, stream)
        messages.select(F.to_json(F.struct(*messages.columns)).alias("value")).write.text(lines)
        handler = ev.landing_handler(stream, landed)
        query_ = ev.run_stream(
            ev.read_lines(spark, lines), stream, handler, scratch_dir(spark, "dlq"), scratch_dir(spark, "checkpoint"),
            writes_once=True,
        )
        query_.awaitTermination()
        schema = contract(ev.LANDING[stream])
        rows = ev.read_landed(spark, landed, schema).drop("batch_id")
        return ntz(rows, *[f.name for f in schema.fields if isinstance(f.dataType, T.TimestampType)])

    return run


for _stream, _sql in _LANDED.items():
    query(f"stream_land_{_stream}", _sql)(_landed(_stream))


@query(
    "stream_daily_counts",
    """SELECT CAST(ts AS DATE) AS day, event_type AS series_id, count(*) AS n, round(sum(value), 4) AS total
        FROM events GROUP BY ALL""",
)
def _stream_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Tumbling days over a stream; equals the batch result when nothing is late."""
    source = scratch_dir(spark, "events")
    rows = s.table(spark, sf, "events").select(
        F.col("event_type").alias("series_id"),
        F.to_date("ts").alias("observation_date"),
        "value",
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )
    rows.write.parquet(source)
    stream = spark.readStream.schema(_EVENT).parquet(source)
    counts = ev.daily_counts(stream, "series_id", "ingested_at", "value")
    final = ev.run_daily_counts(
        spark, counts, "series_id", scratch_dir(spark, "daily"), scratch_dir(spark, "checkpoint")
    )
    return rounded(final, 4, "total")


@query(
    "incremental_lookback",
    """SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - 7""",
)
def _recent(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2024-01-30").cast("date")
    pulled = ev.recent(s.table(spark, sf, "events"), "ts", 7, now)
    twice = pulled.unionByName(pulled)
    return ev.dedup_latest(twice, ["event_id"], "ts").select("event_id", "event_type")
