"""Helpers shared by the operators: stage tables, words, Arrow plumbing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import remove

#: A word, in Java's and in Python's syntax. ``bytes.split()`` splits at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="llm-stages-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only for a one-process session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


class Stages:
    """Tables of one run in the shared folder. A stage is computed once, survives lost executors
    and cuts lineage. ``drop`` deletes tables that nothing will read again."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex[:12]}"
        self.paths: dict[str, str] = {}
        self.made = 0

    def put(self, name: str, df: DataFrame) -> DataFrame:
        self.made += 1
        path = self.paths[name] = f"{self.root}/{self.made:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete the tables of these names, or all of them."""
        for path in [self.paths.pop(n) for n in names] if names else [self.root]:
            remove(self.spark, path)


def text_key(text: Column) -> Column:
    """128-bit digest of a text, as 16 bytes; a null text has the digest of the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


#: Bits of a sieve; it has at most 2 ** (SIEVE - 15) rows of 4 KB, so 1 MB in all.
SIEVE = 23


def _sieve_place(value: str) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(1 << SIEVE))


def sieve(wanted: DataFrame, value: str) -> DataFrame:
    """The values of a column as bits, for ``sifted``."""
    at = _sieve_place(value)
    return wanted.groupBy(F.shiftright(at, 15).alias("_page")).agg(
        F.bitmap_construct_agg(at.bitwiseAND(32767)).alias("_bits")
    )


def sifted(rows: DataFrame, value: str, bits: DataFrame) -> DataFrame:
    """``rows`` without those whose value is certainly not among the wanted ones.

    Some others stay, the more the more values are wanted; so a join with them has to follow, but
    shuffles little of what it would drop. The sieve may be broadcast, as its size is bounded.
    """
    at = _sieve_place(value)
    byte = F.conv(F.hex(F.substr("_bits", F.shiftright(at.bitwiseAND(32767), 3) + 1, F.lit(1))), 16, 10)
    mask = F.element_at(F.array(*(F.lit(1 << i) for i in range(8))), (at.bitwiseAND(7) + 1).cast("int"))
    return (
        rows.join(F.broadcast(bits), F.shiftright(at, 15) == F.col("_page"))
        .where(byte.cast("int").bitwiseAND(mask) > 0).drop("_page", "_bits")
    )


def _slices(batch: pa.RecordBatch, texts: list[int], step: int, most: int | None) -> Iterator[pa.RecordBatch]:
    """Runs of at most ``step`` rows and about ``most`` bytes of texts; a longer row is a run of its own."""
    if not most:
        yield from (batch.slice(at, step) for at in range(0, batch.num_rows, step))
        return
    ends = np.zeros(batch.num_rows, np.int64)
    for i in texts:
        ends += pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(ends), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        end = min(max(int(np.searchsorted(ends, before + most, "right")), at + 1), at + step)
        yield batch.slice(at, end - at)
        at = end


def map_rows(
    df: DataFrame, fn: Callable[[list[list]], list[list]], keep: list[str], read: list[str],
    out: str, step: int = 2048, most: int | None = None,
) -> DataFrame:
    """Columns ``keep`` unchanged, with the columns ``out`` (DDL) that ``fn`` makes of ``read``.

    ``fn`` gets one Python list per column of ``read`` and returns one list or Arrow array per column
    of ``out``. It gets ``step`` rows at most, with ``most`` of about so many bytes of texts at once;
    then all columns of ``read`` are texts. A column that is kept and read is sent once.
    """
    added = T.StructType.fromDDL(out)
    schema = T.StructType([*df.select(*keep).schema, *added])
    n, mark = len(keep), "_read"
    while any(c.startswith(mark) for c in keep):
        mark = "_" + mark
    more = [c for c in read if c not in keep]
    places = [keep.index(c) if c in keep else n + more.index(c) for c in read]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(added)
        for batch in batches:
            for part in _slices(batch, places, step, most):
                made = fn([part.column(i).to_pylist() for i in places])
                arrays = [
                    v.cast(t.type) if isinstance(v, pa.Array) else pa.array(v, t.type)
                    for v, t in zip(made, types)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(n)] + arrays, names=[f.name for f in schema]
                )

    taken = [F.col(c).alias(f"{mark}_{i}") for i, c in enumerate(more)]
    return df.select(*keep, *taken).mapInArrow(run, schema)
