"""Typed table readers and snapshot writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import contract
from ..session import written

LEDGER = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("agent_name", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("input_tokens", T.LongType()),
        T.StructField("output_tokens", T.LongType()),
        T.StructField("cache_creation_input_tokens", T.LongType()),
        T.StructField("cache_read_input_tokens", T.LongType()),
        T.StructField("cost_usd", T.DoubleType()),
    ]
)


#: Name of the column that holds a damaged record's text; NULL for good records.
DAMAGED = "damaged_record"


def _with_damaged(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())])


def scan_csv(spark: SparkSession, table: str, path: str, header: bool = True) -> DataFrame:
    """Landing table from CSV as :func:`read_raw_csv`, with the text of damaged records beside them.

    A record is damaged if it has too few or too many fields or one of the wrong type;
    what could be read of it stands in the other columns. One pass gives both kinds.
    """
    return (
        spark.read.schema(_with_damaged(contract(table)))
        .option("header", header)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", DAMAGED)
        .csv(path)
    )


def scan_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Call ledger from JSON lines, with the text of torn or mistyped lines beside them.

    A writer that is killed leaves half a line at the end of its file, which must not hide the rest.
    """
    return (
        spark.read.schema(_with_damaged(LEDGER))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", DAMAGED)
        .json(path)
    )


def good_and_damaged(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, texts of damaged ones) of a scan, parsed once into a table of the shared folder."""
    kept = written(scanned, "scanned")
    good = kept.where(F.col(DAMAGED).isNull()).drop(DAMAGED)
    return good, kept.where(F.col(DAMAGED).isNotNull()).select(DAMAGED)


def read_raw_csv(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Landing table from CSV with a header, quoted commas and line breaks."""
    return (
        spark.read.schema(contract(table))
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def read_raw(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Landing table from parquet, with the schema of its contract."""
    return spark.read.schema(contract(table)).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Call ledger from JSON lines."""
    return spark.read.schema(LEDGER).json(path)


def append_ledger(df: DataFrame, path: str) -> None:
    """Append calls to the ledger as JSON lines."""
    df.select(*LEDGER.names).write.mode("append").json(path)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Whole report files with their names."""
    return (
        spark.read.text(path, wholetext=True)
        .withColumn("file", F.input_file_name())
        .withColumnRenamed("value", "report")
    )


def write_json_rounded(df: DataFrame, path: str, digits: int = 4) -> None:
    """JSON-lines snapshot with doubles rounded for size."""
    df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema.fields
        ]
    ).write.mode("overwrite").json(path)
