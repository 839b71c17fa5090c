"""Idempotent loads: contract appends, replaces, key replaces, resumable batches."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import RAW_TABLES, conform
from ..session import written


def create_raw_tables(spark: SparkSession, database: str = "raw", location: str | None = None) -> list[str]:
    """Create every landing table that does not exist yet; returns their names.

    The database lies in the warehouse folder unless a ``location`` is given.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    names = []
    for table, schema in RAW_TABLES.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet")
        names.append(f"{database}.{table}")
    return names


def append_rows(df: DataFrame, table: str, path: str) -> None:
    """Append rows that conform to a landing contract."""
    conform(df, table).write.mode("append").parquet(path)


def replace_table(df: DataFrame, table: str, path: str) -> None:
    """Replace all rows of a landing table."""
    conform(df, table).write.mode("overwrite").parquet(path)


#: Directories of a keyed table; a load rewrites those that its keys fall into.
KEY_BUCKETS = 256
#: Files per directory, on average, from which a load of new keys rewrites what it touches.
FILES_PER_BUCKET = 32
_BUCKET, _LIVE = "_bucket", "_live"


def _bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(_BUCKET)


def replace_keys(df: DataFrame, path: str, key: str, buckets: int = KEY_BUCKETS) -> None:
    """Delete-then-insert by key: keys present in ``df`` are replaced, others kept.

    Keys are hashed to ``buckets`` directories, so millions of keys do not make
    millions of files. Keys that the table does not hold yet are added as new files,
    and what is there stays as it is; otherwise the directories of incoming keys are
    rewritten, from their kept rows and the new ones. A repeated load changes nothing.
    A large bucket is split over tasks. NULL is a key like any other. ``buckets`` is
    part of a table's layout and must stay the same.
    """
    _rewrite(df.sparkSession, path, key, df.select(key), df, buckets)


def delete_keys(keys: DataFrame, path: str, key: str, schema: T.StructType, buckets: int = KEY_BUCKETS) -> None:
    """Delete the rows of all keys in ``keys(key)``, without new rows for them."""
    spark = keys.sparkSession
    _rewrite(spark, path, key, keys.select(key), spark.createDataFrame([], schema), buckets)


def _rewrite(
    spark: SparkSession, path: str, key: str, keys: DataFrame, incoming: DataFrame, buckets: int
) -> None:
    rows = incoming.withColumns({_BUCKET: _bucket_of(key, buckets), _LIVE: F.lit(True)})
    gone = keys.groupBy(F.col(key), _bucket_of(key, buckets)).agg(F.count(F.lit(1)).alias("n"))
    gone = written(gone, "replaced-keys")
    sizes = dict(gone.groupBy(_BUCKET).agg(F.sum("n")).collect())
    mode = "append"
    if _exists(spark, path):
        current = spark.read.schema(rows.schema).parquet(path).where(_LIVE)
        old = gone.select(F.col(key).alias("_gone"))
        same = F.col(key).eqNullSafe(F.col("_gone"))
        many = len(current.inputFiles()) >= FILES_PER_BUCKET * buckets
        if many or not current.select(key).join(old, same, "left_semi").isEmpty():
            mode, touched = "overwrite", list(sizes)
            current = current.where(F.col(_BUCKET).isin(touched))
            for bucket, n in current.groupBy(_BUCKET).agg(F.count(F.lit(1))).collect():
                sizes[bucket] += n
            # A marker row keeps a directory that has lost its last row from staying as it was.
            marks = spark.createDataFrame([(b,) for b in touched], f"{_BUCKET} int").withColumn(_LIVE, F.lit(False))
            # The folders that are read are replaced when all tasks have ended, so nothing is copied before.
            kept = current.join(old, same, "left_anti")
            rows = rows.unionByName(marks, allowMissingColumns=True).unionByName(kept)
    (
        _dealt(rows, sizes)
        .write.mode(mode)
        .partitionBy(_BUCKET)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def _dealt(rows: DataFrame, sizes: Mapping[int, int]) -> DataFrame:
    """Rows dealt by bucket over all tasks; a bucket with more than a task's share goes to several of them.

    Small tables too: most of their time is the making of files, one per bucket.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, math.ceil(sum(sizes.values()) / tasks))
    slots = F.lit(1)
    for bucket, n in sizes.items():
        if n > share:
            slots = F.when(F.col(_BUCKET) == bucket, math.ceil(n / share)).otherwise(slots)
    # Maps have no hash.
    hashed = [f.name for f in rows.schema if not re.search("map<|variant", f.dataType.simpleString())]
    return rows.repartition(tasks, F.col(_BUCKET), F.pmod(F.xxhash64(*hashed), slots))


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def read_keyed(spark: SparkSession, path: str, key: str, columns: Sequence[str], schema: T.StructType) -> DataFrame:
    """Read a table written by :func:`replace_keys` with its original columns."""
    stored = T.StructType([*schema.fields, T.StructField(_LIVE, T.BooleanType())])
    return spark.read.schema(stored).parquet(path).where(_LIVE).select(*columns)


def merged_by_key(current: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Result of a key replace as a table: kept rows plus incoming rows."""
    kept = current.join(incoming.select(key).distinct(), key, "left_anti")
    return kept.unionByName(incoming)


def pending_members(members: DataFrame, status: DataFrame, key: str) -> DataFrame:
    """Members with no status row yet, neither done nor dropped."""
    return members.join(status.select(key).distinct(), key, "left_anti")


def backfill_status(
    members: DataFrame, fundamentals: DataFrame, filings: DataFrame, min_years: int = 2
) -> DataFrame:
    """Status of each member: row counts when loaded, a reason when dropped."""
    years = fundamentals.groupBy("ticker").agg(F.countDistinct("fiscal_year").alias("n_years"))
    parsed = (F.coalesce(F.col("mdna_text"), F.lit("")) != "") | (
        F.coalesce(F.col("risk_factors_text"), F.lit("")) != ""
    )
    counts = (
        filings.where(F.col("form_type") == "10-K")
        .select("ticker", parsed.alias("parsed"))
        .groupBy("ticker")
        .agg(F.count(F.lit(1)).alias("n_filings"), F.count_if("parsed").alias("n_parsed"))
    )
    zero = F.lit(0).cast("long")
    joined = members.select("ticker").join(years, "ticker", "left").join(counts, "ticker", "left")
    joined = joined.select(
        "ticker",
        F.coalesce("n_years", zero).alias("n_years"),
        F.coalesce("n_filings", zero).alias("n_filings"),
        F.coalesce("n_parsed", zero).alias("n_parsed"),
    )
    reason = F.when(
        F.col("n_years") < min_years,
        F.concat(F.lit("too few annual years: "), F.col("n_years").cast("string")),
    ).when(F.col("n_filings") == 0, F.lit("no annual filing in the window"))
    return joined.withColumn("drop_reason", reason)


def backfill_summary(status: DataFrame) -> DataFrame:
    """Totals over the loaded members, the drop count and the section parse rate."""
    done = F.col("drop_reason").isNull()
    return status.agg(
        F.count_if(done).alias("loaded"),
        F.count_if(~done).alias("dropped"),
        F.sum(F.when(done, F.col("n_years"))).alias("fundamentals_rows"),
        F.sum(F.when(done, F.col("n_filings"))).alias("filing_rows"),
        F.sum(F.when(done, F.col("n_parsed"))).alias("sections_parsed"),
    ).withColumn(
        "parse_rate",
        F.col("sections_parsed").cast("double") / F.nullif(F.col("filing_rows").cast("double"), F.lit(0.0)),
    )


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each loaded table, for the after-load non-empty check."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
