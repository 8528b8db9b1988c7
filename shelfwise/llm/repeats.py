"""Repeated windows of words or bytes over all documents: the frame of substring deduplication.

A window is a number of consecutive units (words or bytes) of one document. It is routed by its
anchor: of the shorter runs of units (grams) inside it, the one with the smallest hash. Equal
windows have equal anchors, so

1. every document is cut into runs of window starts that share an anchor, and anchors are counted;
2. a run whose anchor occurs once cannot hold a repeated window and is dropped;
3. the texts of the other runs meet by anchor, and a method (doubling for words, a Burrows-Wheeler
   transform for bytes) finds the repeated windows among them, on the texts themselves;
4. an anchor that occurs too often for one task is settled by counting digests of its windows;
5. the answers go back to their documents.

Equal texts are worked on once: in a text that occurs twice, every window does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Stages, map_rows, text_key
from shelfwise.llm.minhash import whole_groups
from shelfwise.llm.words import prefix_sums, span_hashes, word_spans

#: Occurrences of an anchor that meet in one task; more are counted by digest.
TOGETHER = 4096
#: Window starts of a piece; longer runs (periodic text) are cut.
PIECE = 512
#: Bytes of different texts that a method works on at once.
BLOCK = 1_000_000
#: Places that fit beside a hash in one 64-bit key; longer documents are searched in parts.
PLACES = 1 << 24

Finder = Callable[[list[bytes], np.ndarray], list[np.ndarray]]


@dataclass(frozen=True)
class Units:
    """What is counted: ``words`` or else bytes; the window; and the gram that anchors it."""

    words: bool
    window: int
    gram: int

    def canonical(self, text: bytes) -> bytes:
        return b" ".join(text.split()) if self.words else text

    def spans(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        if self.words:
            return word_spans(np.frombuffer(body, np.uint8))
        starts = np.arange(len(body))
        return starts, starts + 1


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchor_runs(body: bytes, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Anchor hash, first window start and weight of each run, and the number of windows.

    The weight is 2 where the anchor stands at two places of the run, which may then repeat within.
    """
    starts, ends = units.spans(body)
    windows = len(starts) - units.window + 1
    if windows < 1:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int8), 0
    sums = prefix_sums(np.frombuffer(body, np.uint8))
    width = units.window - units.gram + 1
    found = []
    for at in range(0, windows, PLACES // 2):
        stop = min(windows, at + PLACES // 2)
        grams = stop - at + width - 1
        hashes = span_hashes(
            sums, starts[at : at + grams], ends[at + units.gram - 1 : at + grams + units.gram - 1]
        )
        keys = hashes & ~np.uint64(PLACES - 1) | np.arange(grams, dtype=np.uint64)
        place = (sliding_min(keys, width) & np.uint64(PLACES - 1)).astype(np.int64)
        chosen = hashes[place]
        new = np.ones(stop - at, bool)
        new[1:] = chosen[1:] != chosen[:-1]
        first = np.flatnonzero(new)
        moved = np.zeros(stop - at, bool)
        moved[1:] = (place[1:] != place[:-1]) & ~new[1:]
        weight = 1 + (np.add.reduceat(moved, first) > 0)
        found.append((chosen[first].view(np.int64), (first + at).astype(np.int32), weight.astype(np.int8)))
    return *(np.concatenate(x) for x in zip(*found)), windows


def window_digests(body: bytes, units: Units) -> np.ndarray:
    """128 bits for each window of a piece, as two columns."""
    starts, ends = units.spans(body)
    n = len(starts) - units.window + 1
    b = np.frombuffer(body, np.uint8)
    one = span_hashes(prefix_sums(b), starts[:n], ends[units.window - 1 :])
    two = span_hashes(prefix_sums(b[::-1]), len(b) - ends[units.window - 1 :], len(b) - starts[:n])
    return np.stack([one, two], 1).view(np.int64)


def covered(windows: np.ndarray, units: Units, n: int) -> np.ndarray:
    """Which of ``n`` units lie in a window that starts at one of ``windows``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, windows, 1)
    np.add.at(edge, windows + units.window, -1)
    return np.cumsum(edge[:-1]) > 0


def body_of(packed: bytes, size: int) -> bytes:
    return pa.decompress(packed, size, "zstd", asbytes=True) if size else b""


def removal(body: bytes, windows: np.ndarray, units: Units) -> tuple[int, int, str]:
    """Units removed, their maximal runs, and the digest of what is kept."""
    starts, ends = units.spans(body)
    gone = covered(windows, units, len(starts))
    spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
    if units.words:
        words = body.split()
        kept = b" ".join([words[i] for i in np.flatnonzero(~gone)])
    else:
        kept = np.frombuffer(body, np.uint8)[~gone].tobytes()
    return int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def repeated_spans(
    docs: DataFrame, stages: Stages, units: Units, finder: Finder, key: str, text: str
) -> DataFrame:
    """key, n_units, n_removed, n_spans and kept_sha256 for every document.

    A null or empty text has no units. What is removed is judged on the input.
    """
    # 1. Anchors of every document, with its result in case nothing is removed.
    def anchors(columns: list[list]) -> list[list]:
        out: list[list] = [[] for _ in range(6)]
        for t in columns[0]:
            body = units.canonical((t or "").encode())
            hashes, lo, weight, windows = anchor_runs(body, units)
            size = len(units.spans(body)[0])
            row = (size, hashlib.sha256(body).hexdigest(), hashes.tobytes(), lo.tobytes(),
                   weight.tobytes(), windows)
            for column, value in zip(out, row):
                column.append(value)
        return out

    rows = docs.select(F.col(key).alias("key"), text_key(F.col(text)).alias("text_key"),
                       F.col(text).alias("body"))
    anchored = map_rows(
        rows, anchors, ["key", "text_key"], ["body"],
        "n_units long, whole_sha256 string, hashes binary, lo binary, weight binary, windows int",
        step=512,
    )
    anchored = stages.put("anchored", anchored.withColumn("uid", F.monotonically_increasing_id()))

    def unpacked(columns: list[str]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                uid, hashes, lo, weight, windows = (batch.column(i).to_pylist() for i in range(5))
                n = [len(w) for w in weight]
                starts = [np.frombuffer(x, np.int32) for x in lo]
                stops = [np.append(s[1:], w).astype(np.int32)[: len(s)] for s, w in zip(starts, windows)]
                made = {
                    "anchor": np.frombuffer(b"".join(hashes), np.int64),
                    "uid": np.repeat(np.array(uid, np.int64), n),
                    "lo": np.concatenate([*starts, np.empty(0, np.int32)]),
                    "hi": np.concatenate([*stops, np.empty(0, np.int32)]),
                    "weight": np.frombuffer(b"".join(weight), np.int8).astype(np.int64),
                }
                yield pa.RecordBatch.from_arrays([pa.array(made[c]) for c in columns], names=columns)

        return run

    packed_runs = anchored.where("windows > 0").select("uid", "hashes", "lo", "weight", "windows")
    counts = packed_runs.mapInArrow(unpacked(["anchor", "weight"]), "anchor long, weight long")
    counts = counts.groupBy("anchor").agg(F.sum("weight").alias("times")).where("times > 1")
    counts = stages.put("anchors", counts)

    # 2. The runs that are left, by text.
    runs = packed_runs.mapInArrow(
        unpacked(["anchor", "uid", "lo", "hi"]), "anchor long, uid long, lo int, hi int"
    ).join(counts, "anchor")
    by_row = runs.groupBy("uid").agg(F.collect_list(F.struct("anchor", "lo", "hi", "times")).alias("runs"))
    texts = (
        by_row.join(anchored.select("uid", "key", "text_key"), "uid").groupBy("text_key")
        .agg(F.count("*").alias("copies"), F.min("key").alias("key"), F.min("uid").alias("uid"),
             F.first("runs").alias("runs"))
    )
    texts = stages.put("texts", texts)

    def pack(columns: list[list]) -> list[list]:
        bodies = [units.canonical((t or "").encode()) for t in columns[0]]
        return [[len(b) for b in bodies], [pa.compress(b, "zstd", asbytes=True) for b in bodies]]

    wanted = texts.select(
        F.col("text_key").alias("wanted"), F.col("key").alias("wanted_key"), "copies", "uid", "runs"
    )
    packed = map_rows(rows, pack, ["key", "text_key"], ["body"], "bytes long, packed binary", step=512)
    bodies = packed.join(
        wanted,
        (F.col("text_key") == F.col("wanted")) & F.col("key").eqNullSafe(F.col("wanted_key")),
    ).select("uid", "text_key", "copies", "runs", "bytes", "packed")
    bodies = stages.put("bodies", bodies)

    # 3. The pieces meet by anchor.
    def pieces(often: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["anchor", "uid", "lo", "copies", "piece"]
            for whole in batches:
                for at in range(0, whole.num_rows, 256):
                    batch = whole.slice(at, 256)
                    out: list[tuple] = []
                    columns = (batch.column(i).to_pylist() for i in range(5))
                    for uid, copies, found, size, packed in zip(*columns):
                        found = [r for r in found if (r["times"] > TOGETHER) == often]
                        if not found:
                            continue
                        body = body_of(packed, size)
                        starts, ends = units.spans(body)
                        for r in found:
                            for lo in range(r["lo"], r["hi"], PIECE):
                                last = min(lo + PIECE, r["hi"]) - 1 + units.window - 1
                                out.append((r["anchor"], uid, lo, copies, body[starts[lo] : ends[last]]))
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out), (
                                pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                            names=names,
                        )

        return run

    shape = "anchor long, uid long, lo int, copies long, piece binary"
    source = bodies.select("uid", "copies", "runs", "bytes", "packed")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["anchor"], rows=4_000):
            uid, lo = table.column("uid").to_numpy(), table.column("lo").to_numpy()
            copies = table.column("copies").to_numpy()
            known: dict[bytes, int] = {}
            which = np.array([known.setdefault(p, len(known)) for p in table.column("piece").to_pylist()])
            times = np.bincount(which, copies, len(known)).astype(np.int64)
            found = finder(list(known), times)
            bits = [np.packbits(f).tobytes() for f in found]
            hit = [i for i in range(len(which)) if found[which[i]].any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid[hit]), pa.array(lo[hit]),
                 pa.array([bits[which[i]] for i in hit], pa.binary())], names=["uid", "lo", "bits"],
            )

    answers = (
        source.mapInArrow(pieces(False), shape).repartition("anchor").sortWithinPartitions("anchor")
        .mapInArrow(settle, "uid long, lo int, bits binary")
    )

    # 4. Anchors that occur too often for that.
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                made = [window_digests(p, units) for p in batch.column(4).to_pylist()]
                n = [len(m) for m in made]
                both = np.concatenate(made)
                lo = np.concatenate([np.arange(k, dtype=np.int32) for k in n])
                yield pa.RecordBatch.from_arrays([
                    pa.array(both[:, 0]), pa.array(both[:, 1]),
                    pa.array(np.repeat(batch.column(1).to_numpy(), n)),
                    pa.array(np.repeat(batch.column(2).to_numpy(), n) + lo),
                    pa.array(np.repeat(batch.column(3).to_numpy(), n)),
                ], names=["one", "two", "uid", "lo", "copies"])

    windows = source.where("exists(runs, r -> r.times > %d)" % TOGETHER).mapInArrow(
        pieces(True), shape
    ).mapInArrow(digests, "one long, two long, uid long, lo int, copies long")
    windows = stages.put("frequent-windows", windows)
    twice = stages.put(
        "frequent-repeats",
        windows.groupBy("one", "two").agg(F.sum("copies").alias("n")).where("n > 1").drop("n"),
    )
    single = windows.join(twice, ["one", "two"]).select(
        "uid", "lo", F.lit(bytes([128])).alias("bits")
    )

    # 5. Back to the documents.
    by_text = answers.unionByName(single).groupBy("uid").agg(
        F.collect_list(F.struct("lo", "bits")).alias("found")
    )
    unique = bodies.where("copies = 1").select("uid", "text_key", "bytes", "packed").join(by_text, "uid")

    def remove(columns: list[list]) -> list[list]:
        out: list[list] = [[], [], []]
        for size, packed, found in zip(*columns):
            at = [
                f["lo"] + np.flatnonzero(np.unpackbits(np.frombuffer(f["bits"], np.uint8)))
                for f in found
            ]
            for column, value in zip(out, removal(body_of(packed, size), np.concatenate(at), units)):
                column.append(value)
        return out

    removed = map_rows(unique, remove, ["text_key"], ["bytes", "packed", "found"],
                       "n_removed long, n_spans long, kept_sha256 string", step=256)
    nothing = hashlib.sha256(b"").hexdigest()
    copied = bodies.where("copies > 1").select("text_key").distinct()
    removed = stages.put("removed", removed.withColumn("all", F.lit(False)).unionByName(
        copied.select("text_key", F.lit(0).cast("long").alias("n_removed"),
                      F.lit(1).cast("long").alias("n_spans"), F.lit(nothing).alias("kept_sha256"),
                      F.lit(True).alias("all"))
    ))
    return anchored.select("key", "text_key", "n_units", "whole_sha256").join(
        removed, "text_key", "left"
    ).select(
        F.col("key").alias(key), "n_units",
        F.when(F.col("all"), F.col("n_units")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
