"""Tables that micro-batches are merged into, and runs that count and stop.

A merged table lies in key buckets. A micro-batch reads and rewrites the buckets that
its keys fall into, into a new folder, and then appends a manifest: one file that
names the folder of every bucket. Readers go by the newest manifest, so they never see
half of a batch; a batch whose manifest is there is not merged again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import EVENT_STREAMS, required_fields
from ..operators.dedup import dedup_latest, row_hash
from ..operators.versions import append_row, folder_exists
from ..session import drop_folders, written
from .events import Handler, decode, land, route_once

#: Buckets of a merged table; part of its layout.
KEY_BUCKETS = 64
_BUCKET, _BATCH = "_bucket", "_batch"
_MANIFEST = "batch bigint, folders map<int,string>, watermark timestamp"


class MergedTable:
    """A table in key buckets with a manifest per merged micro-batch."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = KEY_BUCKETS
    ):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.schema = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])

    def _manifests(self) -> DataFrame | None:
        path = f"{self.path}/manifest"
        return self.spark.read.schema(_MANIFEST).parquet(path) if folder_exists(self.spark, path) else None

    def state(self) -> tuple[int, dict[int, str], object]:
        """The last merged batch, the folder of each bucket and the watermark after it."""
        manifests = self._manifests()
        last = None if manifests is None else manifests.orderBy(F.desc("batch")).first()
        return (-1, {}, None) if last is None else (last["batch"], dict(last["folders"]), last["watermark"])

    def _stored(self, folders: Mapping[int, str], only: Sequence[int] | None = None) -> DataFrame:
        paths = [f"{f}/{_BUCKET}={b}" for b, f in folders.items() if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._stored(self.state()[1]).drop(_BATCH)

    def rewrite(
        self, rows: DataFrame, batch: int, merged: Callable[[DataFrame, DataFrame], DataFrame], watermark=None
    ) -> list[int]:
        """Merge rows into the buckets of their keys; returns these buckets.

        ``merged(old, new)`` gives the rows that the touched buckets hold afterwards.
        A batch that was merged already changes nothing.
        """
        last, folders, mark = self.state()
        if batch <= last:
            return []
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        new = rows.withColumn(_BATCH, F.lit(batch).cast("long")).select(self.schema.names)
        new = written(new, "merge-batch")
        touched = sorted(r[0] for r in new.select(bucket.alias("b")).distinct().collect())
        if touched:
            folder = f"{self.path}/data/batch-{batch}-{uuid.uuid4().hex}"
            out = merged(self._stored(folders, touched), new).withColumn(_BUCKET, bucket)
            out.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(folder)
            folders |= {b: folder for b in touched}
        mark = watermark if watermark is not None else mark
        append_row(self.spark, (batch, folders, mark), _MANIFEST, f"{self.path}/manifest")
        return touched

    def vacuum(self) -> list[str]:
        """Delete the batch folders that the newest manifest does not name; returns them.

        Readers of an older manifest must have ended.
        """
        manifests = self._manifests()
        if manifests is None:
            return []
        named = {f for r in manifests.select(F.explode(F.map_values("folders")).alias("f")).distinct().collect() for f in r}
        gone = sorted(named - set(self.state()[1].values()))
        drop_folders(self.spark, gone)
        return gone


class LatestTable(MergedTable):
    """The latest row of every key, by ``order``; equal times go to the later micro-batch."""

    def __init__(self, spark, path, schema, keys, order: str = "ingested_at", buckets: int = KEY_BUCKETS):
        super().__init__(spark, path, schema, keys, buckets)
        self.order = order

    def merge(self, rows: DataFrame, batch: int) -> list[int]:
        """Late, repeated and replayed rows are all the same: a key keeps its latest row."""

        def latest(old: DataFrame, new: DataFrame) -> DataFrame:
            both = old.unionByName(new)
            tie = F.struct(F.col(_BATCH), row_hash(both, skip=(_BATCH,)))
            return dedup_latest(both, self.keys, self.order, tie=tie)

        return self.rewrite(rows, batch, latest)


# --- daily sums of several streams -----------------------------------------------
#: Columns of a daily row: sums of counts and volumes, and one largest ratio.
_SUMS = (
    "flagged_contracts", "total_volume", "call_volume", "put_volume", "iv_count",
    "mention_count", "total_score", "total_comments", "filings_filed",
)
DAILY_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("day", T.DateType()),
        *[T.StructField(c, T.LongType()) for c in _SUMS],
        T.StructField("iv_sum", T.DoubleType()),
        T.StructField("max_volume_oi_ratio", T.DoubleType()),
    ]
)
_PARTS = [f.name for f in DAILY_SCHEMA.fields if f.name not in ("ticker", "day")]


def signal_events(
    options: DataFrame | None = None, mentions: DataFrame | None = None, filings: DataFrame | None = None
) -> DataFrame:
    """Rows of the three streams as one: ``ticker``, ``day``, ``event_time`` and what each adds to a day.

    Works on streams and on tables; an absent source adds nothing.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def part(df: DataFrame, ticker: str, time: Column, have: Mapping[str, Column]) -> DataFrame:
        empty = {c: F.lit(None).cast("double") if c in ("iv_sum", "max_volume_oi_ratio") else none for c in _PARTS}
        cells = {**empty, **have}
        return df.select(
            F.col(ticker).alias("ticker"),
            F.to_date(time).alias("day"),
            time.cast("timestamp").alias("event_time"),
            *[cells[c].cast(DAILY_SCHEMA[c].dataType).alias(c) for c in _PARTS],
        )

    found = []
    if options is not None:
        volume = F.coalesce("day_volume", none)
        iv = F.col("implied_volatility")
        found.append(
            part(options, "underlying", F.col("detected_at"), {
                "flagged_contracts": one, "total_volume": volume,
                "call_volume": F.when(F.col("contract_type") == "call", volume).otherwise(0),
                "put_volume": F.when(F.col("contract_type") == "put", volume).otherwise(0),
                "iv_count": iv.isNotNull().cast("long"), "iv_sum": iv,
                "max_volume_oi_ratio": F.col("volume_oi_ratio"),
            })
        )
    if mentions is not None:
        found.append(
            part(mentions, "ticker", F.col("created_at"), {
                "mention_count": one, "total_score": F.col("score"), "total_comments": F.col("num_comments"),
            })
        )
    if filings is not None:
        found.append(part(filings, "ticker", F.col("filing_date").cast("timestamp"), {"filings_filed": one}))
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df)
    return out


def daily_sums(events: DataFrame) -> DataFrame:
    """Event or daily rows summed up per ticker and day; sums of sums are sums again."""
    return events.groupBy("ticker", "day").agg(
        *[(F.max(c) if c == "max_volume_oi_ratio" else F.sum(c)).alias(c) for c in _PARTS]
    )


class DailySignals(MergedTable):
    """Daily sums of the signal streams under one watermark.

    The watermark is the latest event time of earlier micro-batches less ``delay``, kept in
    the manifest. Rows of days that ended before it are late: their day is closed, so
    they go to the side table ``late`` under the batch's id and change no sum.
    """

    def __init__(self, spark, path, delay: str = "2 days", buckets: int = KEY_BUCKETS):
        super().__init__(spark, path, DAILY_SCHEMA, ["ticker", "day"], buckets)
        self.delay, self.late_path = delay, f"{path.rstrip('/')}/late"

    def merge(self, events: DataFrame, batch: int) -> None:
        last, _, mark = self.state()
        if batch <= last:
            return
        day_end = F.date_add("day", 1).cast("timestamp")
        is_late = F.lit(False) if mark is None else day_end <= F.lit(mark)
        # Late rows, day sums and the watermark come from one pass over the source.
        rows = written(events.withColumn("is_late", F.coalesce(is_late, F.lit(False))), "daily-events")
        land(rows.where("is_late").drop("is_late"), self.late_path, batch)
        newest = rows.agg(F.max(F.col("event_time") - F.expr(f"INTERVAL {self.delay}"))).first()[0]
        marks = [m for m in (mark, newest) if m is not None]
        summed = daily_sums(rows.where("NOT is_late"))
        self.rewrite(summed, batch, self._added, max(marks) if marks else None)

    @staticmethod
    def _added(old: DataFrame, new: DataFrame) -> DataFrame:
        both = old.unionByName(new)
        parts = [(F.max(c) if c == "max_volume_oi_ratio" else F.sum(c)).alias(c) for c in _PARTS]
        return both.groupBy("ticker", "day").agg(*parts, F.max(_BATCH).alias(_BATCH))

    def late_rows(self) -> DataFrame:
        """All late rows so far."""
        events = T.StructType([*DAILY_SCHEMA.fields[:2], T.StructField("event_time", T.TimestampType()), *DAILY_SCHEMA.fields[2:]])
        if not folder_exists(self.spark, self.late_path):
            return self.spark.createDataFrame([], events)
        return self.spark.read.schema(events).parquet(self.late_path).select(events.names)


def run_daily_signals(events: DataFrame, table: DailySignals, checkpoint: str) -> None:
    """Merge a stream of :func:`signal_events` to the end of its input."""
    query = (
        events.writeStream.foreachBatch(table.merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


# --- runs that count and stop -----------------------------------------------------
_COUNTS = "stream string, published bigint, dead bigint, missing map<string,bigint>"


class NotPublished(ValueError):
    """A load that reported no count."""


class _Enough(Exception):
    """Raised before a micro-batch that a bounded run is not to handle."""


_ENOUGH = "ledgerwing: the run has handled enough messages"


def run_counted(
    lines: DataFrame,
    stream: str,
    handler: Handler,
    dlq_path: str,
    counts_path: str,
    checkpoint: str,
    max_messages: int | None = None,
    reject_when: Mapping[str, Column] | None = None,
) -> int:
    """Handle a stream's records to the end of its input, or until ``max_messages`` are handled.

    Each micro-batch reports what it published, what it dead-lettered and how often each
    optional field is missing, observed in the very passes that write, under its
    id in ``counts_path``. A run that has handled ``max_messages`` good records takes no further
    micro-batch: the next run goes on there. Batches are never split, so the
    source's limit per trigger says how far a run can go beyond its bound. The
    handler must write the records it is given, once, as that pass is what is observed.
    Returns the number of records handled by this run.
    """
    required = required_fields(stream)
    fields = [f.name for f in EVENT_STREAMS[stream].fields if f.name not in required]
    handled = 0

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        nonlocal handled
        if max_messages is not None and handled >= max_messages:
            raise _Enough(_ENOUGH)
        decoded = decode(batch, EVENT_STREAMS[stream], required, reject_when)
        seen = Observation(f"good-{uuid.uuid4().hex}")
        nulls = [F.count_if(F.col(c).isNull()).alias(f"missing_{i}") for i, c in enumerate(fields)]

        def counted(good: DataFrame, batch_id: int) -> None:
            handler(good.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), batch_id)

        dead = route_once(decoded, stream, counted, dlq_path, batch_id)
        missing = {f: seen.get[f"missing_{i}"] for i, f in enumerate(fields)}
        row = (stream, seen.get["rows"], dead, missing)
        land(batch.sparkSession.createDataFrame([row], _COUNTS).coalesce(1), counts_path, batch_id)
        handled += seen.get["rows"]

    query = (
        lines.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException as ended:
        if _ENOUGH not in str(ended):
            raise
    return handled


def published_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """The counts of all micro-batches; a load that reported none is an error."""
    if not folder_exists(spark, counts_path):
        raise NotPublished(f"no publish count under {counts_path}")
    return spark.read.schema(f"{_COUNTS}, batch_id bigint").parquet(counts_path)
