"""Event streams: parsing, dead letters, landing, keep-latest, daily counts.

A stream is a DataFrame with ``key`` and ``value`` string columns, whatever the
transport: a text-file source here, ``format("kafka")`` with a cast on a cluster
that has the connector. Checkpoints and outputs belong in shared storage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..contracts import EVENT_STREAMS, conform, required_fields
from ..operators.dedup import dedup_latest
from ..operators.once import once
from ..sources.feeds import explode_mentions, explode_segments

#: Topic of each stream.
TOPICS = {
    "filing": "filings.raw",
    "transcript": "transcripts.raw",
    "macro": "macro.raw",
    "options": "options.unusual_activity",
    "sentiment": "sentiment.raw",
}
DLQ_SUFFIX = ".dlq"
#: Landing table of each stream.
LANDING = {
    "filing": "raw_filings",
    "transcript": "raw_transcript_segments",
    "macro": "raw_macro_observations",
    "options": "raw_options_activity",
    "sentiment": "raw_sentiment_mentions",
}
_CORRUPT = "_corrupt_record"

Handler = Callable[[DataFrame, int], None]


def read_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of JSON lines; every file is read once, from the oldest on."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(F.lit(None).cast("string").alias("key"), "value")


def read_kafka(spark: SparkSession, servers: str, stream: str) -> DataFrame:
    """Stream of one topic from its earliest offset (needs the Kafka connector)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", TOPICS[stream])
        .option("startingOffsets", "earliest")
        .load()
        .select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    )


def decode(
    lines: DataFrame,
    schema: T.StructType,
    required: Sequence[str],
    reject_when: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Parse values and name what is wrong with each record.

    Adds ``record``, ``error_type``, ``error_message`` and ``stage``. Empty and
    NULL values are tombstones and are dropped. A record is bad when it is not
    JSON or has a wrong type (stage deserialization), lacks a required field
    (deserialization), or meets a ``reject_when`` condition over its fields
    (stage handler).
    """
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    parsed = once(
        lines.where(F.col("value").isNotNull() & (F.trim("value") != "")),
        record=F.from_json(
            "value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        ),
    )
    record = F.col("record")
    missing = F.array_compact(
        F.array(*[F.when(record[c].isNull(), F.lit(c)) for c in required], F.lit(None).cast("string"))
    )
    corrupt = record.isNull() | record[_CORRUPT].isNotNull()
    rejected: Column = F.lit(None).cast("string")
    for name, condition in (reject_when or {}).items():
        rejected = F.when(F.coalesce(condition, F.lit(False)), F.lit(name)).otherwise(rejected)
    error = (
        F.when(corrupt, "CorruptRecord")
        .when(F.size(missing) > 0, "MissingField")
        .when(rejected.isNotNull(), "Rejected")
    )
    message = (
        F.when(corrupt, "value is not a record of the expected type")
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
        .when(rejected.isNotNull(), rejected)
    )
    return parsed.select(
        *lines.columns,
        F.struct(*[record[f.name].alias(f.name) for f in schema.fields]).alias("record"),
        error.alias("error_type"),
        message.alias("error_message"),
        F.when(error == "Rejected", "handler").when(error.isNotNull(), "deserialization").alias("stage"),
    )


def good_records(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.col("error_type").isNull()).select("record.*")


def dead_letters(decoded: DataFrame, topic: str) -> DataFrame:
    """Bad records in the dead-letter layout."""
    return decoded.where(F.col("error_type").isNotNull()).select(
        F.lit(topic).alias("source_topic"),
        "key",
        # Spark breaks base64 into lines; a payload is one.
        F.replace(F.base64(F.encode("value", "UTF-8")), F.lit("\r\n"), F.lit("")).alias("payload_b64"),
        "error_type",
        "error_message",
        F.current_timestamp().alias("failed_at"),
        F.create_map(F.lit("stage"), F.col("stage")).alias("context"),
    )


def route_dead_letters(
    lines: DataFrame, stream: str, reject_when: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(good records, dead letters) of a batch or a stream."""
    decoded = decode(lines, EVENT_STREAMS[stream], required_fields(stream), reject_when)
    return good_records(decoded), dead_letters(decoded, TOPICS[stream])


def serialise(records: DataFrame, stream: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(key/value messages, dead letters) of records to publish.

    A record without a required field cannot be serialised; its dead letter has
    stage serialization and no payload.
    """
    required = required_fields(stream)
    missing = F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required], F.lit(None).cast("string"))
    )
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT_STREAMS[stream].fields]
    good = records.where(F.size(missing) == 0).select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )
    dead = records.where(F.size(missing) > 0).select(
        F.lit(TOPICS[stream]).alias("source_topic"),
        F.col(key).cast("string").alias("key"),
        F.lit(None).cast("string").alias("payload_b64"),
        F.lit("MissingField").alias("error_type"),
        F.concat(F.lit("missing: "), F.array_join(missing, ", ")).alias("error_message"),
        F.current_timestamp().alias("failed_at"),
        F.create_map(F.lit("stage"), F.lit("serialization")).alias("context"),
    )
    return good, dead


def landing_rows(records: DataFrame, stream: str) -> DataFrame:
    """Records of a stream as rows of its landing table.

    A filing gives its two sections, a post a row per mentioned ticker and a
    transcript a row per speaker turn; posts without a ticker and transcripts
    without turns give none.
    """
    if stream == "filing":
        sections = F.col("sections")
        records = records.withColumns(
            {"mdna_text": sections["mdna"], "risk_factors_text": sections["risk_factors"]}
        ).drop("raw_text", "sections")
    elif stream == "sentiment":
        records = explode_mentions(records)
    elif stream == "transcript":
        records = explode_segments(records.withColumnRenamed("quarter", "fiscal_quarter"))
    return conform(records, LANDING[stream])


def landing_handler(stream: str, path: str) -> Handler:
    """A handler that lands a stream's micro-batches in the layout of its raw table."""
    return lambda records, batch_id: land(landing_rows(records, stream), path, batch_id)


def land(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch under its own id; a replay overwrites itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All landed micro-batches, with their ``batch_id``."""
    wide = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(wide).parquet(path)


def route_once(decoded: DataFrame, stream: str, handler: Handler, dlq_path: str, batch_id: int) -> int:
    """Give the good records to a handler that writes them all, once; land and count the bad ones.

    The pass of the good records counts the bad ones on its way, so a batch is parsed
    again only if it has any, and decoded rows are never kept.
    """
    told = Observation(f"decoded-{uuid.uuid4().hex}")
    bad = F.count_if(F.col("error_type").isNotNull()).alias("bad")
    handler(good_records(decoded.observe(told, bad)), batch_id)
    dead, n = dead_letters(decoded, TOPICS[stream]), told.get["bad"]
    land(dead if n else dead.limit(0), dlq_path, batch_id)
    return n


def run_stream(
    lines: DataFrame,
    stream: str,
    handler: Handler,
    dlq_path: str,
    checkpoint: str,
    reject_when: Mapping[str, Column] | None = None,
    available_now: bool = True,
    writes_once: bool = False,
) -> StreamingQuery:
    """Feed good records to ``handler`` and land bad ones in the dead-letter table.

    Offsets are committed after both writes, so a lost executor or a restart
    replays the batch; writes keyed by batch id make the replay harmless. A
    handler that raises stops the query for a retry, record-level failures are
    expressed through ``reject_when``. ``writes_once`` says that the handler writes all
    records it is given in one pass: then nothing is cached, see :func:`route_once`.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch, EVENT_STREAMS[stream], required_fields(stream), reject_when)
        if writes_once:
            route_once(decoded, stream, handler, dlq_path, batch_id)
            return
        decoded = decoded.persist()
        try:
            handler(good_records(decoded), batch_id)
            land(dead_letters(decoded, TOPICS[stream]), dlq_path, batch_id)
        finally:
            decoded.unpersist()

    writer = lines.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def latest_view(landed: DataFrame, keys: Sequence[str], order: str = "ingested_at") -> DataFrame:
    """Keep-latest table over everything landed so far.

    Equal times fall back to the later micro-batch.
    """
    return dedup_latest(landed, keys, order, tie="batch_id").drop("batch_id")


def compact(
    spark: SparkSession,
    landed: DataFrame,
    keys: Sequence[str],
    order: str,
    target: str,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Write the keep-latest table to a new folder and read it back.

    With the ``previous`` table only the batches landed since need reading. The
    old folder stays valid until readers move to the new one.
    """
    if previous is not None:
        landed = landed.unionByName(previous.withColumn("batch_id", F.lit(-1).cast("long")))
    latest_view(landed, keys, order).write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target)


def first_copies(stream: DataFrame, keys: Sequence[str], time: str, lateness: str = "1 day") -> DataFrame:
    """Only the first copy of each key, remembered within the watermark."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def daily_counts(stream: DataFrame, key: str, time: str, value: str, lateness: str = "2 days") -> DataFrame:
    """Tumbling-day aggregates; rows later than the watermark are dropped."""
    return (
        stream.withWatermark(time, lateness)
        .groupBy(F.window(time, "1 day").alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(F.to_date("w.start").alias("day"), key, "n", "total")
    )


def run_daily_counts(
    spark: SparkSession, counts: DataFrame, key: str, path: str, checkpoint: str
) -> DataFrame:
    """Run a daily aggregate to the end of its input; returns the final table.

    Every trigger lands the days that changed; the last landed state of a day
    and key is its result.
    """
    query = (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda df, batch_id: land(df, path, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    landed = read_landed(spark, path, counts.schema)
    return dedup_latest(landed, ["day", key], "batch_id").drop("batch_id")


def recent(df: DataFrame, time: str, days: int, now: Column | None = None) -> DataFrame:
    """Rows of an overlapping look-back window, to be deduplicated downstream."""
    until = now if now is not None else F.current_date()
    return df.where(F.to_date(time) >= F.date_sub(until, days))
