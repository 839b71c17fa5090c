"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RECORDS: list[list[str]] = []


def build_session(app: str = "ledgerwing", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the settings every job here relies on.

    Only semantics (UTC) and adaptive execution are fixed; sizes such as
    ``spark.sql.shuffle.partitions`` belong to the cluster or to the caller.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Bytes of an Arrow batch that goes to a Python worker, unless the session says otherwise.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python workers in batches of ``BATCH_BYTES``; a limit that is set stays.

    Spark counts rows, and 10,000 texts are held outside the heap of an executor as well as by its workers.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(BATCH_BYTES))


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder of the cluster.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it is unset,
    a session that runs in this one process sets a temporary folder of its own;
    on a cluster that would lose the executors' files, so it is an error there.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", ""
    )
    if not root:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ledgerwing-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for record in _RECORDS:
        record.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The scratch folders that are named inside the block, to be dropped when nothing reads them."""
    record: list[str] = []
    _RECORDS.append(record)
    try:
        yield record
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not record]


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete scratch folders; one that is not there is passed over."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(*tables: DataFrame) -> None:
    """Delete the folders that tables of :func:`written` lie in; tables without files are left."""
    for table in tables:
        found = {re.match(r"(.*-[0-9a-f]{32})/", f) for f in table.inputFiles()}
        drop_folders(table.sparkSession, sorted({m[1] for m in found if m}))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage durably: an executor that is lost later costs no more than
    the tasks it was running.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_stamp(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Names, sizes and times of a table's files, from the file system's listing."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found))
