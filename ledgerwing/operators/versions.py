"""Groups of tables that change together: a load is visible whole or not at all.

Every load writes all its tables into a folder of its own and then appends one row
to the commit table. That row is one file, which appears under its name in one step;
readers resolve every table through the newest row, so a load that fails half way
leaves what they read as it was. One loader at a time may publish to a root.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_folders

_COMMITS = "version long, folder string, tables array<string>"


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder is there and has files."""
    try:
        spark.read.format("text").load(path).limit(0).count()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def append_row(spark: SparkSession, values: tuple, schema: str, path: str) -> None:
    """Append one row as one file."""
    spark.createDataFrame([values], schema).coalesce(1).write.mode("append").parquet(path)


class VersionedTables:
    """The tables under one root, as of the newest load that was published."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> DataFrame | None:
        path = f"{self.root}/commits"
        if not folder_exists(self.spark, path):
            return None
        return self.spark.read.schema(_COMMITS).parquet(path)

    def version(self) -> tuple[int, str, list[str]]:
        """Number, folder and table names of the newest load; number 0 before the first."""
        commits = self._commits()
        last = None if commits is None else commits.orderBy(F.desc("version")).first()
        return (0, "", []) if last is None else (last["version"], last["folder"], list(last["tables"]))

    def publish(self, tables: Mapping[str, DataFrame], database: str | None = None) -> int:
        """Write every table, then make them the current version; returns its number.

        With a ``database`` its views are pointed at the new version afterwards.
        """
        folder = f"{self.root}/load-{uuid.uuid4().hex}"
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}")
        number = self.version()[0] + 1
        append_row(self.spark, (number, folder, sorted(tables)), _COMMITS, f"{self.root}/commits")
        if database is not None:
            self.point_views(database)
        return number

    def read(self, name: str) -> DataFrame:
        """A table of the current version; the DataFrame stays with that version."""
        number, folder, names = self.version()
        if name not in names:
            raise KeyError(f"version {number} has no table {name!r}")
        return self.spark.read.parquet(f"{folder}/{name}")

    def read_all(self) -> dict[str, DataFrame]:
        """All tables of one and the same version."""
        _, folder, names = self.version()
        return {n: self.spark.read.parquet(f"{folder}/{n}") for n in names}

    def point_views(self, database: str) -> list[str]:
        """Point a view per table at the current version; returns their names."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        _, folder, names = self.version()
        for name in names:
            source = f"SELECT * FROM parquet.`{folder}/{name}`"
            self.spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS {source}")
        return [f"{database}.{n}" for n in names]

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the folders of all but the newest ``keep`` versions; returns them."""
        commits = self._commits()
        if commits is None:
            return []
        folders = [r["folder"] for r in commits.orderBy(F.desc("version")).collect()]
        drop_folders(self.spark, folders[keep:])
        return folders[keep:]
