"""Versions of a set of tables: replaced in one step, kept while a reader may need them."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import remove

#: The published versions: when, the folder, and the schema of each of its tables.
_LOG = "written long, version string, schemas map<string, string>"


class Versions:
    """Folders under ``root``, one per version, and a log of those that are complete.

    Readers take the version that was published last. A new one becomes that by one row added to
    the log, so readers never see half of it, and a write that fails changes nothing. Readers of an
    older version go on: its files stay until ``keep`` newer ones are published.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> list:
        """Newest first."""
        rows = self.spark.read.schema(_LOG).parquet(f"{self.root}/current")
        return rows.orderBy(F.desc("written"), "version").collect()

    @contextmanager
    def writing(self, keep: int = 2) -> Iterator[NewVersion]:
        """A new version, published when the block ends well and removed when it does not.

        ``keep`` versions stay, the new one included; a run that reads one of them is safe.
        """
        if keep < 1:
            raise ValueError("keep the version that is written")
        new = NewVersion(self, f"version-{uuid.uuid4().hex[:12]}")
        try:
            yield new
            row = self.spark.createDataFrame([(time.time_ns(), new.name, new.schemas)], _LOG)
            row.coalesce(1).write.mode("append").parquet(f"{self.root}/current")
        except BaseException:
            remove(self.spark, new.folder)
            raise
        for old in self._log()[keep:]:
            remove(self.spark, f"{self.root}/{old.version}")

    def read(self, *names: str) -> list[DataFrame]:
        """Tables of the newest version, all of the same one."""
        log = self._log()
        if not log:
            raise FileNotFoundError(f"nothing has been published under {self.root}")
        newest = log[0]
        return [_read(self.spark, f"{self.root}/{newest.version}/{n}", newest.schemas[n]) for n in names]


class NewVersion:
    """The tables of a version that is being written."""

    def __init__(self, versions: Versions, name: str):
        self.versions, self.name = versions, name
        self.folder = f"{versions.root}/{name}"
        self.schemas: dict[str, str] = {}

    def put(self, name: str, df: DataFrame, by: list[str]) -> DataFrame:
        """Write a table, partitioned by the columns ``by``, and read it back.

        The rebalance hint gathers each partition into few files and splits one that outweighs the
        others, so that a market with a third of all rows is not written by one task.
        """
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{self.folder}/{name}")
        self.schemas[name] = df.schema.json()
        return _read(self.versions.spark, f"{self.folder}/{name}", self.schemas[name])


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    kind = T.StructType.fromJson(json.loads(schema))
    return spark.read.schema(kind).parquet(path).select(*kind.names)
