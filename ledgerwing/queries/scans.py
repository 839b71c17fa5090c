"""Scans with damaged records, the catalogue's contract and the written snapshot, on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import catalogue_drift, conform
from ..operators import loads
from ..plans import serving
from ..plans.evaluation import calibration_report
from ..session import scratch_dir, written
from ..sources import tables
from . import standins as s
from .evaluation import _auc, _stat
from .registry import query


# --- damaged records ------------------------------------------------------------------
@query(
    "csv_scan",
    """SELECT 'A' || doc_id AS accession_number, CASE WHEN doc_id % 10 NOT IN (3, 4, 5) THEN DATE '2024-01-31' END AS filing_date,
        CASE WHEN doc_id % 10 NOT IN (3, 4, 5) THEN '"' || lang || '", two' || chr(10) || 'lines, ' || doc_id END AS mdna_text,
        doc_id % 10 IN (3, 4, 5) AS damaged FROM documents""",
)
def _csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Filings as CSV records with quotes, commas and line breaks; three in ten are damaged.

    Damaged are records with a field too many, a wrong type, or too few fields.
    """
    doc = F.col("doc_id")
    text = s.text_of('"""', F.col("lang"), '"", two\nlines, ', doc, '"')
    day = F.when(doc % 10 == 4, "no day").otherwise("2024-01-31")
    fields = [
        s.text_of("A", doc), F.lit("7"), F.lit("T"), F.lit('"Firm, Inc."'), F.lit("10-K"), day,
        F.lit("url"), text, F.lit('""'), F.lit("2024-01-31 00:00:00"),
    ]
    whole = F.concat_ws(",", *fields)
    record = F.when(doc % 10 == 3, F.concat(whole, F.lit(",more"))).when(
        doc % 10 == 5, F.concat_ws(",", *fields[:3])
    ).otherwise(whole)
    path = scratch_dir(spark, "csv")
    s.table(spark, sf, "documents").select(record.alias("value")).write.text(path)
    good, damaged = tables.good_and_damaged(tables.scan_csv(spark, "raw_filings", path, header=False))
    first = F.substring_index(tables.DAMAGED, ",", 1)
    return good.select("accession_number", "filing_date", "mdna_text", F.lit(False).alias("damaged")).unionByName(
        damaged.select(
            first.alias("accession_number"), F.lit(None).cast("date").alias("filing_date"),
            F.lit(None).cast("string").alias("mdna_text"), F.lit(True).alias("damaged"),
        )
    )


@query(
    "ledger_scan",
    """SELECT ticker, agent_name, CAST(input_tokens AS BIGINT) AS input_tokens, CAST(NULL AS VARCHAR) AS damaged
        FROM ledger WHERE (run_id + seq) % 9 > 1
        UNION ALL SELECT NULL, NULL, NULL, CASE (run_id + seq) % 9 WHEN 0 THEN '{"ticker":"' || ticker
            ELSE '{"ticker":"' || ticker || '","input_tokens":"many"}' END FROM ledger WHERE (run_id + seq) % 9 <= 1""",
)
def _ledger_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Metered calls as JSON lines; some lines are torn, some hold a wrong type."""
    kind = (F.col("run_id") + F.col("seq")) % 9
    torn = s.text_of('{"ticker":"', F.col("ticker"))
    line = F.when(kind == 0, torn).when(kind == 1, F.concat(torn, F.lit('","input_tokens":"many"}')))
    whole = F.to_json(F.struct("model", "agent_name", "ticker", "input_tokens", "output_tokens"))
    path = scratch_dir(spark, "ledger")
    s.ledger(spark, sf).select(line.otherwise(whole).alias("value")).write.text(path)
    good, damaged = tables.good_and_damaged(tables.scan_ledger(spark, path))
    return good.select("ticker", "agent_name", "input_tokens", F.lit(None).cast("string").alias("damaged")).unionByName(
        damaged.select(F.col(tables.DAMAGED).alias("damaged")), allowMissingColumns=True
    )


# --- the catalogue ---------------------------------------------------------------------
@query(
    "catalogue_drift",
    """SELECT * FROM (VALUES
        ('raw_companies', 'sector', 'missing', 'string', NULL), ('raw_companies', 'rank', 'unknown', NULL, 'bigint'),
        ('raw_macro_observations', 'value', 'type', 'double', 'string'),
        ('raw_sentiment_mentions', 'post_id', 'position', '1', '2'), ('raw_sentiment_mentions', 'subreddit', 'position', '2', '1'),
        ('raw_model_predictions', NULL, 'no table', NULL, NULL)) v(table_name, column_name, problem, wanted, found)
        LEFT JOIN (SELECT 'raw_companies' AS table_name, count(*) AS n_rows FROM companies
            UNION ALL SELECT 'raw_macro_observations', count(*) FROM raw_macro
            UNION ALL SELECT 'raw_sentiment_mentions', 2 * count(*) FROM mentions) n USING (table_name)""",
)
def _drift(spark: SparkSession, sf: str) -> DataFrame:
    """Landing tables made from the contracts and loaded; four of them have drifted since."""
    database = f"drift_{uuid.uuid4().hex}"
    loads.create_raw_tables(spark, database, scratch_dir(spark, "catalogue"))
    swapped = conform(s.raw_mentions(spark, sf), "raw_sentiment_mentions")
    swapped = swapped.select("subreddit", "post_id", *swapped.columns[2:])
    drifted = {
        "raw_companies": s.raw_companies(spark, sf).drop("sector").withColumn("rank", F.lit(1).cast("long")),
        "raw_macro_observations": s.raw_macro(spark, sf).withColumn("value", F.col("value").cast("string")),
        "raw_sentiment_mentions": swapped,
    }
    for name, rows in drifted.items():
        rows.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
    spark.sql(f"DROP TABLE {database}.raw_model_predictions")
    found = catalogue_drift(spark, database)
    counts = loads.load_counts({n: spark.table(f"{database}.{n}") for n in drifted})
    return found.join(counts, "table_name", "left")


@query(
    "catalogue_append",
    """SELECT 'raw_companies' AS table_name, 2 * (SELECT count(*) FROM companies) AS n_rows
        UNION ALL SELECT 'raw_macro_observations', 2 * (SELECT count(*) FROM raw_macro)""",
)
def _catalogue_append(spark: SparkSession, sf: str) -> DataFrame:
    """Contract appends into catalogue tables that were made from the contracts, which do not drift by it."""
    database = f"landing_{uuid.uuid4().hex}"
    loads.create_raw_tables(spark, database, scratch_dir(spark, "catalogue"))
    sources = {"raw_companies": s.raw_companies(spark, sf), "raw_macro_observations": s.raw_macro(spark, sf)}
    for name, rows in sources.items():
        for _ in range(2):
            conform(rows, name).write.mode("append").saveAsTable(f"{database}.{name}")
    if catalogue_drift(spark, database).count():
        raise AssertionError("tables drifted from their contracts")
    return loads.load_counts({n: spark.table(f"{database}.{n}") for n in sources})


# --- the snapshot ------------------------------------------------------------------------
_TEST = "(SELECT * FROM panel_outcomes WHERE data_split = 'test')"


@query(
    "snapshot_views",
    f"""SELECT 'screen' AS part, ticker, CAST(fiscal_year AS BIGINT) AS fiscal_year, predicted_score AS a, CAST(NULL AS DOUBLE) AS b, CAST(NULL AS DOUBLE) AS c
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM panel_outcomes) WHERE rn = 1
        UNION ALL SELECT 'meta', ticker, fiscal_year, round(net_margin, 4), round(debt_to_equity, 4), round(revenue_growth_1y, 4)
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY fiscal_year DESC) AS rn FROM panel) WHERE rn = 1
        UNION ALL SELECT 'calibration', NULL, n, round(accuracy, 4), round(ci_high, 4), (SELECT round(auc, 4) FROM ({_auc(_TEST)}))
        FROM ({_stat(_TEST)})
        UNION ALL SELECT 'bin', NULL, bin, round(avg(predicted_score), 9), round(avg(actual_direction), 9), CAST(count(*) AS DOUBLE)
        FROM (SELECT *, 1 + CAST(len(list_filter([1, 2, 3, 4, 5, 6, 7, 8, 9], lambda i: predicted_score >= lo + i * w)) AS BIGINT) AS bin
            FROM {_TEST}, (SELECT min(predicted_score) AS lo, (max(predicted_score) - min(predicted_score)) / 10 AS w, count(*) AS rows,
                max(predicted_score) AS hi FROM {_TEST}) e WHERE rows >= 100 AND hi > lo) GROUP BY bin""",
)
def _snapshot_views(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot as it is written, and the views that read nothing else."""
    # The export and each figure of the report read the outcomes: they are joined once.
    outcomes, panel = written(s.panel_outcomes(spark, sf), "outcomes"), s.panel(spark, sf)
    path = scratch_dir(spark, "snapshot")
    serving.write_snapshot(path, outcomes, panel, s.companies(spark, sf), calibration_report(outcomes))
    snapshot = serving.read_snapshot(spark, path)
    none = F.lit(None).cast("double")

    def part(name: str, df: DataFrame, ticker, year, a, b, c) -> DataFrame:
        cells = {"ticker": ticker, "fiscal_year": year, "a": a, "b": b, "c": c}
        kinds = {"ticker": "string", "fiscal_year": "long"}
        return df.select(F.lit(name).alias("part"), *[x.cast(kinds.get(k, "double")).alias(k) for k, x in cells.items()])

    nobody = F.lit(None).cast("string")
    report, bins = serving.calibration_view(snapshot)
    return (
        part("screen", serving.ranked_screen(snapshot.predictions), F.col("ticker"), F.col("fiscal_year"), F.col("score"), none, none)
        .unionByName(part("meta", snapshot.company_meta, F.col("ticker"), F.col("fiscal_year"), F.col("net_margin"), F.col("debt_to_equity"), F.col("revenue_growth_1y")))
        .unionByName(part("calibration", report, nobody, F.col("out_of_sample_n"), F.col("accuracy"), F.col("ci_high"), F.col("realized_auc")))
        .unionByName(part("bin", bins, nobody, F.col("bin"), F.round("mean_predicted_score", 9), F.round("actual_rate", 9), F.col("n")))
    )
