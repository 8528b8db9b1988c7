"""Merkle manifest of a table: every row's leaf, its witness up to the root, and its check.

Leaves are appended in order to trees of two children a node, one tree per group, whose roots are
the leaves of one tree more. A block of consecutive leaves is one unit of work: its leaves are
appended one after another, every open subtree keeps its leaves' partial witnesses, and whenever a
later sibling completes, both sides' witnesses are extended by the other one's root. The blocks'
roots are appended to the tree above in the same way, so no task holds more than a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import Stages, map_rows

#: Leaves of a block, as a power of two: the height of the subtree that one block builds.
HEIGHT = 10

LONE, LEFT, RIGHT = b"\x00", b"\x01", b"\x02"  # a witness' steps: no sibling, or where it stands


def field(value: Column) -> Column:
    """A value as leaves hold it: ``-`` if null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(*values: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, values)), 256))


def parent(*digests: bytes) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


class Frontier:
    """Open subtrees of an aligned run of leaves, and the witness of each leaf so far."""

    def __init__(self) -> None:
        self.witnesses: list[bytearray] = []
        self.open: list[tuple[int, int, bytes]] = []  # height, first leaf, root; heights fall

    def append(self, digest: bytes) -> None:
        self.open.append((0, len(self.witnesses), digest))
        self.witnesses.append(bytearray())
        while len(self.open) > 1 and self.open[-2][0] == self.open[-1][0]:
            self._merge()

    def close(self, height: int) -> bytes:
        """The root of all leaves at a height; nodes without a sibling are hashed alone."""
        while self.open[-1][0] < height:
            if len(self.open) > 1 and self.open[-2][0] == self.open[-1][0]:
                self._merge()
            else:
                level, first, digest = self.open[-1]
                for witness in self.witnesses[first:]:
                    witness += LONE
                self.open[-1] = level + 1, first, parent(digest)
        return self.open[-1][2]

    def _merge(self) -> None:
        (level, start, left), (_, middle, right) = self.open[-2:]
        for witness in self.witnesses[start:middle]:
            witness += RIGHT + right
        for witness in self.witnesses[middle:]:
            witness += LEFT + left
        self.open[-2:] = [(level + 1, start, parent(left, right))]


def steps(witness: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(where the sibling stands, sibling) from the leaf to the root."""
    at = 0
    while at < len(witness):
        side = witness[at : at + 1]
        size = 0 if side == LONE else 32
        yield side, witness[at + 1 : at + 1 + size]
        at += 1 + size


def fold(digest: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for side, sibling in steps(witness):
        if side == LONE:
            digest = parent(digest)
        else:
            digest = parent(sibling, digest) if side == LEFT else parent(digest, sibling)
    return digest


def proof_digest(witness: bytes) -> str:
    return sha256("".join(s.hex() for _, s in steps(witness)).encode()).hexdigest()


def placed(rows: DataFrame, order: list[str], stages: Stages, name: str) -> DataFrame:
    """``rows`` with pos, the place of a row in its tree from 0, and n, the tree's rows.

    ``order`` starts with tree. Rows are dealt by ranges and sorted there; what a range holds of a
    tree is counted, and the counts before it are added. Equal rows are told apart by where they
    were read, so that they are dealt over several ranges too.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = stages.put(
        f"{name}-ranged",
        tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
        .select("*", F.spark_partition_id().alias("_part"),
                F.monotonically_increasing_id().alias("_row")),
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = ranged.groupBy("tree", "_part").agg(F.min("_row").alias("_low"), F.count("*").alias("_n"))
    runs = runs.select(
        "tree", "_part", F.sum("_n").over(tree).alias("n"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"),
    )
    return (
        ranged.join(runs, ["tree", "_part"])
        .withColumn("pos", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")
    )


def in_blocks(nodes: DataFrame) -> DataFrame:
    """``nodes`` (tree, pos, n, digest, more) with witness and top, up to the root of their block."""
    columns = nodes.columns
    tree, pos, n, digest = (columns.index(c) for c in ("tree", "pos", "n", "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                trees, places, sizes, digests = (
                    batch.column(i).to_pylist() for i in (tree, pos, n, digest)
                )
                at = 0
                for key, same in groupby(zip(trees, (p >> HEIGHT for p in places))):
                    length = sum(1 for _ in same)
                    yield key, sizes[at], digests[at : at + length], batch.slice(at, length)
                    at += length

        for _, same in groupby(parts(), key=lambda part: part[0]):
            frontier, held, size = Frontier(), [], 0
            for _, size, digests, part in same:
                held.append(part)
                for d in digests:
                    frontier.append(d)
            # A tree within one block ends at its own root; other blocks end at one height.
            top = frontier.close(min(HEIGHT, (size - 1).bit_length()))
            witnesses = iter(map(bytes, frontier.witnesses))
            for part in held:
                made = [next(witnesses) for _ in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(made, pa.binary()),
                     pa.array([top] * len(made), pa.binary())],
                    names=[*columns, "witness", "top"],
                )

    schema = nodes.select("*", F.lit(b"").alias("witness"), F.lit(b"").alias("top")).schema
    block = F.shiftright("pos", HEIGHT)
    dealt = nodes.repartition("tree", block).sortWithinPartitions("tree", "pos")
    return dealt.mapInArrow(_joined(run), schema)


def _joined(run):
    """Blocks' parts put together to batches of a useful size."""

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for part in chain(run(batches), [None]):
            if part is not None:
                held.append(part)
                rows += part.num_rows
            if held and (part is None or rows >= 8192):
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0

    return full


def upper(made: DataFrame, largest: int, stages: Stages, name: str) -> DataFrame:
    """tree, block, above, root: the witness from each block's root to the root of its tree."""
    blocks = made.groupBy("tree", F.shiftright("pos", HEIGHT).alias("block")).agg(
        F.min("n").alias("n"), F.min("top").alias("top")
    )
    if largest <= 1 << HEIGHT:
        return blocks.select("tree", "block", F.lit(b"").alias("above"), F.col("top").alias("root"))
    nodes = blocks.select(
        "tree", F.col("block").alias("pos"),
        F.shiftright(F.col("n") + ((1 << HEIGHT) - 1), HEIGHT).alias("n"), F.col("top").alias("digest"),
    )
    made = stages.put(f"{name}-blocks", in_blocks(nodes))
    higher = upper(made, -(-largest >> HEIGHT), stages, f"{name}-up")
    return (
        made.withColumn("block", F.shiftright("pos", HEIGHT)).join(higher, ["tree", "block"])
        .select("tree", F.col("pos").alias("block"), F.concat("witness", "above").alias("above"), "root")
    )


def witnessed(rows: DataFrame, order: list[str], stages: Stages, name: str) -> tuple[DataFrame, DataFrame]:
    """Nodes with the witness inside their block, and what :func:`upper` says of the blocks."""
    nodes = placed(rows, order, stages, name)
    made = stages.put(f"{name}-leaves", in_blocks(nodes))
    largest = made.agg(F.max("n")).first()[0] or 1
    return made, stages.put(f"{name}-upper", upper(made, largest, stages, name))


def manifest(docs: DataFrame, stages: Stages, key: str, group: str, fields: list[str],
             tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """key, leaf, subroot, root, witness, other: one row per row of ``docs``.

    A leaf is the hash of ``fields``; a tree holds the leaves of one ``group`` in order of ``key``
    (nulls first, equal keys by leaf), and the trees' roots in order of the group, null first and
    then bytewise, are the leaves of the last tree. ``other`` is the leaf that a row would have
    with the values of ``tampered``, for the rows of ``where``; null for the others.

    Nulls are values like others. Repeated rows are leaves like others, at places next to each other.
    Texts of any length are hashed as they are read; only digests are dealt out. An empty table gives
    no rows. Other columns are not read.
    """
    change = tampered or {}
    other = leaf(*(change.get(c, F.col(c)) for c in fields))
    leaves = docs.select(
        F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit(":"), F.col(group).cast("string"))).alias("tree"),
        F.col(key).alias("key"), leaf(*map(F.col, fields)).alias("digest"),
        F.when(F.lit(False) if where is None else where, other).alias("other"),
    )
    made, blocks = witnessed(leaves, ["tree", "key", "digest"], stages, "manifest")
    roots = blocks.where("block = 0").select(
        F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("root").alias("digest")
    )
    tops, top = witnessed(roots, ["tree", "group"], stages, "roots")
    tops = (
        tops.withColumn("block", F.shiftright("pos", HEIGHT)).join(top, ["tree", "block"])
        .select(F.col("group").alias("tree"), F.col("digest").alias("subroot"),
                F.concat("witness", "above").alias("last"), F.col("root").alias("whole"))
    )
    blocks = blocks.join(tops, "tree").select(
        "tree", "block", "subroot", "whole", F.concat("above", "last").alias("above")
    )
    return (
        made.withColumn("block", F.shiftright("pos", HEIGHT)).join(blocks, ["tree", "block"])
        .select(F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot",
                F.col("whole").alias("root"), F.concat("witness", "above").alias("witness"), "other")
    )


def verified(made: DataFrame, key: str) -> DataFrame:
    """Rows of :func:`manifest` with the digest of their proof, the root that their leaf (``other``
    where there is one) and witness lead to, and whether it is the root."""

    def check(columns: list[list]) -> list[list]:
        leaves, others, witnesses = columns
        return [
            [proof_digest(w) for w in witnesses],
            [fold(d if o is None else o, w).hex() for d, o, w in zip(leaves, others, witnesses)],
        ]

    checked = map_rows(
        made, check, [key, "leaf", "subroot", "root"], ["leaf", "other", "witness"],
        "proof_sha256 string, folded_root string",
    )
    digests = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root")}
    return checked.withColumns(digests).withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_report(docs: DataFrame, stages: Stages) -> DataFrame:
    """The manifest of ``documents`` by language, checked with every seventh row tampered with:
    where 7 divides the CRC-32 of doc_id, one is added to n_chars. A null doc_id has no CRC-32 and
    a null n_chars stays null, so both verify; see :func:`manifest` for the other cases."""
    more = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    made = manifest(docs, stages, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"],
                    more, F.coalesce(hit, F.lit(False)))
    return verified(made, "doc_id")
