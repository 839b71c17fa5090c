"""Landing-table and event-stream contracts, and conformance to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRING, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DOUBLE, _DATE, _TS = T.DoubleType(), T.DateType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


#: Raw table name -> ordered columns and types.
RAW_TABLES: dict[str, T.StructType] = {
    "raw_companies": _struct(
        ("ticker", _STRING),
        ("cik", _STRING),
        ("company_name", _STRING),
        ("sector", _STRING),
        ("industry", _STRING),
    ),
    "raw_filings": _struct(
        ("accession_number", _STRING),
        ("cik", _STRING),
        ("ticker", _STRING),
        ("company_name", _STRING),
        ("form_type", _STRING),
        ("filing_date", _DATE),
        ("document_url", _STRING),
        ("mdna_text", _STRING),
        ("risk_factors_text", _STRING),
        ("ingested_at", _TS),
    ),
    "raw_fundamentals": _struct(
        ("ticker", _STRING),
        ("fiscal_year", _INT),
        ("fiscal_quarter", _INT),
        ("period_end_date", _DATE),
        ("revenue", _DOUBLE),
        ("cost_of_revenue", _DOUBLE),
        ("net_income", _DOUBLE),
        ("total_assets", _DOUBLE),
        ("total_liabilities", _DOUBLE),
        ("total_equity", _DOUBLE),
        ("total_debt", _DOUBLE),
        ("shares_outstanding", _DOUBLE),
        ("close_price", _DOUBLE),
    ),
    "raw_macro_observations": _struct(
        ("series_id", _STRING),
        ("observation_date", _DATE),
        ("value", _DOUBLE),
        ("ingested_at", _TS),
    ),
    "raw_options_activity": _struct(
        ("underlying", _STRING),
        ("contract_ticker", _STRING),
        ("contract_type", _STRING),
        ("strike", _DOUBLE),
        ("expiration", _DATE),
        ("day_volume", _LONG),
        ("open_interest", _LONG),
        ("volume_oi_ratio", _DOUBLE),
        ("implied_volatility", _DOUBLE),
        ("detected_at", _TS),
    ),
    "raw_sentiment_mentions": _struct(
        ("post_id", _STRING),
        ("subreddit", _STRING),
        ("ticker", _STRING),
        ("title", _STRING),
        ("score", _INT),
        ("num_comments", _INT),
        ("created_at", _TS),
        ("ingested_at", _TS),
    ),
    "raw_transcript_segments": _struct(
        ("url", _STRING),
        ("ticker", _STRING),
        ("company_name", _STRING),
        ("fiscal_year", _INT),
        ("fiscal_quarter", _INT),
        ("segment_index", _INT),
        ("speaker", _STRING),
        ("role", _STRING),
        ("section", _STRING),
        ("text", _STRING),
        ("ingested_at", _TS),
    ),
    "raw_model_predictions": _struct(
        ("ticker", _STRING),
        ("fiscal_year", _INT),
        ("predicted_score", _DOUBLE),
        ("predicted_direction", _INT),
        ("model_artifact", _STRING),
        ("scored_at", _TS),
    ),
}

_SEGMENT = _struct(("speaker", _STRING), ("role", _STRING), ("section", _STRING), ("text", _STRING))

#: Event stream -> record type.
EVENT_STREAMS: dict[str, T.StructType] = {
    "filing": _struct(
        ("accession_number", _STRING),
        ("cik", _STRING),
        ("ticker", _STRING),
        ("company_name", _STRING),
        ("form_type", _STRING),
        ("filing_date", _DATE),
        ("document_url", _STRING),
        ("raw_text", _STRING),
        ("sections", T.MapType(_STRING, _STRING)),
        ("ingested_at", _TS),
    ),
    "macro": _struct(
        ("series_id", _STRING), ("observation_date", _DATE), ("value", _DOUBLE), ("ingested_at", _TS)
    ),
    "options": _struct(
        ("underlying", _STRING),
        ("contract_ticker", _STRING),
        ("contract_type", _STRING),
        ("strike", _DOUBLE),
        ("expiration", _DATE),
        ("day_volume", _LONG),
        ("open_interest", _LONG),
        ("volume_oi_ratio", _DOUBLE),
        ("implied_volatility", _DOUBLE),
        ("detected_at", _TS),
    ),
    "sentiment": _struct(
        ("post_id", _STRING),
        ("subreddit", _STRING),
        ("title", _STRING),
        ("body", _STRING),
        ("score", _INT),
        ("num_comments", _INT),
        ("tickers", T.ArrayType(_STRING)),
        ("created_at", _TS),
        ("ingested_at", _TS),
    ),
    "transcript": _struct(
        ("company_name", _STRING),
        ("ticker", _STRING),
        ("quarter", _INT),
        ("fiscal_year", _INT),
        ("url", _STRING),
        ("segments", T.ArrayType(_SEGMENT)),
        ("ingested_at", _TS),
    ),
}

#: Fields of each stream that may be NULL; all others are required.
NULLABLE_FIELDS: dict[str, frozenset[str]] = {
    "filing": frozenset({"ticker"}),
    "macro": frozenset(),
    "options": frozenset({"implied_volatility"}),
    "sentiment": frozenset(),
    "transcript": frozenset({"ticker", "quarter", "fiscal_year"}),
}


def required_fields(stream: str) -> list[str]:
    """Names of the fields a record of ``stream`` must carry."""
    return [n for n in EVENT_STREAMS[stream].names if n not in NULLABLE_FIELDS[stream]]


def contract(table: str) -> T.StructType:
    """Contract of a landing table; unknown tables are refused."""
    try:
        return RAW_TABLES[table.lower()]
    except KeyError:
        raise KeyError(f"unknown landing table {table!r}") from None


def unknown_columns(df: DataFrame, table: str) -> list[str]:
    """Columns of ``df`` that the contract does not name (case-insensitive)."""
    return sorted({c.lower() for c in df.columns} - set(contract(table).names))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast and order ``df`` to a landing contract.

    Names match case-insensitively, missing columns become NULL and unknown
    ones raise. A pure projection: no data is moved.
    """
    schema = contract(table)
    extra = unknown_columns(df, table)
    if extra:
        raise KeyError(f"columns not in {table}: {extra}")
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(present[f.name]) if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def schema_drift(df: DataFrame, table: str) -> list[str]:
    """Differences between ``df`` and the contract: names, order and types."""
    want, have = contract(table), df.schema
    problems = []
    if [n.lower() for n in have.names] != want.names:
        problems.append(f"columns {have.names} differ from {want.names}")
    for field in want.fields:
        match = [f for f in have.fields if f.name.lower() == field.name]
        if match and match[0].dataType != field.dataType:
            problems.append(f"{field.name}: {match[0].dataType} is not {field.dataType}")
    return problems


DRIFT = "table_name string, column_name string, problem string, wanted string, found string"


def catalogue_drift(spark: SparkSession, database: str) -> DataFrame:
    """One row per column of the catalogue's landing tables that is not as its contract says.

    Problems: ``no table``, ``missing``, ``unknown``, ``type`` and ``position`` (counted among
    the columns that both sides have, from 1). Only the catalogue is read, no table.
    """
    rows: list[tuple] = []
    for table, schema in RAW_TABLES.items():
        name = f"{database}.{table}"
        if not spark.catalog.tableExists(name):
            rows.append((table, None, "no table", None, None))
            continue
        have = {c.name.lower(): c.dataType for c in spark.catalog.listColumns(name)}
        want = {f.name: f.dataType.simpleString() for f in schema.fields}
        rows += [(table, c, "missing", want[c], None) for c in want if c not in have]
        rows += [(table, c, "unknown", None, have[c]) for c in have if c not in want]
        common = [c for c in want if c in have]
        rows += [(table, c, "type", want[c], have[c]) for c in common if want[c] != have[c]]
        order = [c for c in have if c in want]
        rows += [
            (table, c, "position", str(i), str(order.index(c) + 1))
            for i, c in enumerate(common, 1)
            if order.index(c) + 1 != i
        ]
    return spark.createDataFrame(rows, DRIFT)
