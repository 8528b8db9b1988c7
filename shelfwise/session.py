"""Session settings and stage tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession


class Stage(Protocol):
    """Takes an intermediate relation, possibly stored; ``by`` are columns its readers filter on."""

    def __call__(self, name: str, df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame: ...


# Join strategy is left to Spark, so that only a side whose size has been measured is broadcast:
# adaptive execution compares the finished shuffle's bytes with the broadcast threshold and falls
# back to a shuffle join, and it splits the hot partitions of such a join.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort where every partition of the build side was measured to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Shuffled bytes of a merged partition. They are packed; as rows to sort they are several times as
    # many, and a task sorts more than one side.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the jobs rely on. Memory and partition counts stay yours, as
    does the time zone: dates are compared as dates only."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def stage_root(spark: SparkSession) -> str:
    """Shared folder for stage tables: ``spark.checkpoint.dir`` where the cluster names one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root()


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="shelfwise-")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def lazy(_name: str, df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """A stage that stays part of one lazy plan."""
    return df


class table_stage:  # noqa: N801  used like a function
    """Stages written as parquet tables of this run, in a folder of its own.

    A stage table is computed once however many steps read it, outlives lost executors, lets each
    reader prune columns and ``by`` values, and gives the planner a true size for the joins that
    follow. The folder stays until ``drop``; results read it when they are computed.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.folder = f"{(root or stage_root(spark)).rstrip('/')}/run-{uuid.uuid4().hex[:12]}"

    def __call__(self, name: str, df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.mode("overwrite").partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def drop(self) -> None:
        remove(self.spark, self.folder)


@contextmanager
def run_stages(spark: SparkSession, root: str | None = None) -> Iterator[table_stage]:
    """Stages for one run, whose folder goes at the end of the block, also after a failure. Write
    or collect the result inside the block."""
    stage = table_stage(spark, root)
    try:
        yield stage
    finally:
        stage.drop()
