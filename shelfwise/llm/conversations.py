"""Conversations: damage, faults, and the cheapest repair of their structure.

The turns of all conversations are sorted together and dealt by ranges; a segment of a conversation
in one range is a unit of work. It finds the cheapest edits from each state its roles may begin with
to each they may end with, and the segments of a conversation are then put together in order. So a
conversation of any length is worked on by many tasks, and a task holds one segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfwise.llm.audits import Audits, followed, segment, solved
from shelfwise.llm.common import Stages

#: Turns of a segment at most.
SEGMENT = 2048
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"
ORDER = ("turn", "role", "digest")
COUNTS = ("blank", "duplicate", "truncated", "illegal")

MOVES = "array<struct<start int, end int, cost bigint, audit string>>"
SUMMARY = (
    "rows bigint, first_initial string, last_initial string, turns bigint, first_turn bigint, "
    f"last_turn bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, opens boolean, moves {MOVES}"
)


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: what is left of each turn, by the CRC-32 of its place.

    A null counts as one space, but conv_id and turn stay null. ``copies`` is 0 for a dropped turn and
    2 for a repeated one.
    """
    place = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind, text = F.crc32(place) % 20, F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def faults(turns: DataFrame) -> DataFrame:
    """One row per different turn (conv_id, turn, role, digest): copies, initial, blank, truncated,
    and whether role and text were seen at an earlier turn. Texts stay behind."""
    end = F.rtrim("text", F.lit(SPACE))
    single = (
        turns.withColumn("digest", F.unhex(F.sha2("text", 256)))
        .groupBy("conv_id", *ORDER).agg(
            F.sum("copies").alias("copies"), F.min(end == "").alias("blank"),
            F.min(~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        )
    )
    first = (
        single.where("copies > 0").groupBy("conv_id", "role", "digest")
        .agg(F.min("turn").alias("first"), F.max(F.isnull("turn")).alias("unplaced"))
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
                "first", "unplaced")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (
        F.col("digest") == F.col("d"))
    seen = F.col("turn").isNotNull() & (F.col("unplaced") | (F.col("turn") > F.col("first")))
    return single.join(first, same, "left").select(
        "conv_id", *ORDER, "copies", F.substring("role", 1, 1).alias("initial"), "blank", "truncated",
        F.coalesce(seen, F.lit(False)).alias("seen"),
    )


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: T.StructType, size: int = 2048) -> Iterator[pa.RecordBatch]:
    arrow = to_arrow_schema(schema)

    def made(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip(zip(*held), arrow)], schema=arrow
        )

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made(held)
            held = []
    if held:
        yield made(held)


def _summary(turns: list[tuple], opens: bool) -> tuple:
    """What a segment of (turn, initial, copies, blank, truncated, seen) adds to its conversation."""
    counts = dict.fromkeys(COUNTS, 0)
    before, places, plan = None, 0, []
    last = object()
    for turn, initial, copies, blank, truncated, seen in turns:
        gone = blank or seen
        counts["blank"] += copies if blank else 0
        counts["duplicate"] += 0 if blank else copies - (not seen)
        counts["truncated"] += not gone and truncated
        counts["illegal"] += copies - 1 + (before is not None and before + initial not in LEGAL)
        places += turn is not None and turn != last
        before, last = initial, turn
        plan.append((initial, copies, gone, truncated))
    moves = [m for start in ((0,) if opens else range(4)) for m in segment(plan, start)]
    numbers = [t[0] for t in turns if t[0] is not None]
    return (
        sum(t[2] for t in turns), turns[0][1] if turns else None, before, places,
        numbers[0] if numbers else None, numbers[-1] if numbers else None,
        *(int(counts[c]) for c in COUNTS), opens,
        [dict(zip(("start", "end", "cost", "audit"), m)) for m in moves],
    )


def segments(rows: DataFrame, size: int = SEGMENT) -> DataFrame:
    """conv_id, the place of a segment (turn, role, digest), and its summary."""
    schema = T.StructType([
        *rows.select("conv_id", *ORDER).schema, *T.StructType.fromDDL(SUMMARY)
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            at_start = True
            for conv, turns in groupby((r for b in batches for r in _columns(b)), key=lambda r: r[0]):
                place, held, opens = None, [], not at_start
                at_start = False
                for _, turn, role, digest, copies, initial, *marks in turns:
                    place = place or (turn, role, digest)
                    if copies:
                        held.append((turn, initial, copies, *marks))
                    if len(held) == size:
                        yield conv, *place, *_summary(held, opens)
                        place, held, opens = None, [], False
                if place:
                    yield conv, *place, *_summary(held, opens)

        return _batches(made(), schema, 256)

    order = ["conv_id", *ORDER]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema)


def audited(parts: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost and audit, from its segments in order."""
    schema = T.StructType([
        *parts.select("conv_id").schema,
        *T.StructType.fromDDL(
            f"gaps bigint, {', '.join(f'{c} bigint' for c in COUNTS)}, cost bigint, audit string"
        ),
    ])
    names = T.StructType.fromDDL(SUMMARY).names

    def whole(parts: Iterator[tuple]) -> tuple:
        audits, cells = Audits(), [(0, 0), None, None, None]
        counts = dict.fromkeys(COUNTS, 0)
        before = low = high = None
        places = 0
        for part in parts:
            s = dict(zip(names, part[1 + len(ORDER) :]))
            cells = followed(audits, cells, s["moves"])
            if not s["rows"]:
                continue
            for c in COUNTS:
                counts[c] += s[c]
            counts["illegal"] += before is not None and before + s["first_initial"] not in LEGAL
            before = s["last_initial"]
            if s["turns"]:
                places += s["turns"] - (s["first_turn"] == high)
                low, high = s["first_turn"] if low is None else low, s["last_turn"]
        cost, node = solved(audits, cells)
        gaps = 0 if low is None else high - low + 1 - places
        return gaps, *counts.values(), cost, audits.text(node)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = groupby((r for b in batches for r in _columns(b)), key=lambda r: r[0])
        return _batches(((conv, *whole(same)) for conv, same in by), schema)

    return (
        parts.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).mapInArrow(run, schema)
    )


class Repaired:
    """The turns of one conversation under its audit, one after another."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, None

    def _next(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def _added(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            role = self._next()
            self.last = role[0]
            yield role, ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._added()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            role = role if edit == "K" else self._next()
            self.last = role[:1]
            yield role, text

    def end(self) -> Iterator[tuple[str, str]]:
        return self._added()


def repaired_digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``audits`` with repaired_sha256. A conversation's turns pass one task in order, as a digest of
    all its text needs them; they are streamed, and none is kept."""
    schema = T.StructType([*audits.schema, T.StructField("repaired_sha256", T.StringType())])
    columns = audits.columns
    rows = turns.where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"),
        "text", "copies", *(F.lit(None).cast(f.dataType).alias(f"_{f.name}") for f in audits.schema),
    )
    heads = audits.select(
        "conv_id", F.lit(0).alias("kind"),
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[2:7]),
        *(F.col(c).alias(f"_{c}") for c in columns),
    )
    audit = columns.index("audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            head = state = digest = None
            empty = True

            def take(turns):
                nonlocal empty
                for role, text in turns:
                    digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                    empty = False

            def done():
                take(state.end())
                return *head, digest.hexdigest()

            for batch in batches:
                for _, kind, _, role, _, text, copies, *values in _columns(batch):
                    if kind == 0:
                        if head is not None:
                            yield done()
                        head, state = values, Repaired(values[audit])
                        digest, empty = sha256(), True
                    else:
                        for _ in range(copies):
                            take(state.turn(role, text))
            if head is not None:
                yield done()

        return _batches(made(), schema)

    return (
        heads.unionByName(rows).repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", *ORDER).mapInArrow(run, schema)
    )


def repaired(turns: DataFrame, stages: Stages) -> DataFrame:
    """Per conversation of ``turns`` (conv_id, turn, role, text, copies): its gaps and faults, the
    cost and the audit of its cheapest repair, and the digest of the repaired turns.

    Turns are taken in the order of turn (nulls first), role, and digest of the text; so ties have one
    order, and repeated rows stand next to each other. The second and later of them are duplicates. Null
    conv_ids are one conversation. A text is read whole, however long; an empty one is blank. A
    conversation without turns has no faults, an empty audit and the digest of nothing; an empty table
    has no conversations. Other columns are not read.
    """
    parts = stages.put("segments", segments(faults(turns)))
    return repaired_digests(turns, stages.put("audits", audited(parts)))


def repair_report(conversations: DataFrame, stages: Stages) -> DataFrame:
    """:func:`repaired` of the turns that :func:`damaged` leaves, for every conv_id of the table."""
    return repaired(damaged(conversations), stages)
