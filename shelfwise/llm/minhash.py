"""Near-duplicate documents: an inverted join of MinHash signature coordinates."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Stages, map_rows, text_key
from shelfwise.llm.components import components
from shelfwise.llm.words import LOWER, run_hashes, word_hashes

#: Coordinates of a signature; each is kept as one byte.
COORDINATES = 256
#: Chance with which a pair just at the threshold may fail to meet in any posting list.
MISS = 1e-4
#: Documents of one posting list that are compared in one go.
BLOCK = 512

_rng = np.random.default_rng(11)
_FACTORS = _rng.integers(0, 1 << 32, COORDINATES, np.uint32) | np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, COORDINATES, np.uint32)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles; with fewer words, of the whole sequence."""
    return np.unique(run_hashes(word_hashes((text or "").encode().translate(LOWER)), words))


def signature(found: np.ndarray) -> bytes:
    low = (found >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 64):
        values = low[at : at + 64, None] * _FACTORS + _SHIFTS
        np.minimum(least, values.min(0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def run_length(threshold: float) -> int:
    """The longest run of coordinates that still leaves only MISS as the chance that a pair at the
    threshold differs in every run."""
    return max(
        r for r in range(1, 9)
        if r == 1 or (1 - threshold**r) ** (COORDINATES // r) <= MISS
    )


def least_matches(threshold: float) -> int:
    """Coordinates that pairs at the threshold share but for 3.5 standard deviations."""
    return math.floor(
        COORDINATES * threshold - 3.5 * math.sqrt(COORDINATES * threshold * (1 - threshold))
    )


def run_keys(signatures: np.ndarray, run: int) -> np.ndarray:
    """The values of each run of coordinates, as one number."""
    n = COORDINATES // run
    parts = signatures[:, : n * run].reshape(-1, n, run).astype(np.uint64)
    return (parts << (np.arange(run, dtype=np.uint64) * np.uint64(8))).sum(2, dtype=np.uint64)


def _as_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def postings(classes: DataFrame, run: int) -> DataFrame:
    """at, value, id: every class under each of its coordinate runs."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = run_keys(_as_matrix(batch.column(1)), run)
            n = keys.shape[1]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.tile(np.arange(n, dtype=np.int32), len(keys))),
                pa.array(keys.reshape(-1).view(np.int64)),
                pa.array(np.repeat(batch.column(0).to_numpy(), n)),
            ], names=["at", "value", "id"])

    return classes.select("id", "signature").mapInArrow(post, "at int, value long, id long")


UNIT = ["at", "value", "lo", "hi"]


def list_units(classes: DataFrame, stages: Stages, threshold: float) -> DataFrame:
    """UNIT, mine, id: the members of every posting list of two or more classes.

    A list longer than BLOCK is cut in blocks, and each pair of blocks is a unit of work, so no
    list has to fit in a task.
    """
    posted = stages.put("postings", postings(classes, run_length(threshold)))
    lists = posted.groupBy("at", "value").agg(F.count("*").alias("n")).where("n > 1")
    lists = stages.put("lists", lists.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    member = posted.join(lists.select("at", "value", "blocks"), ["at", "value"]).withColumn(
        "mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    return stages.put("units", member.select(
        "at", "value", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
        "mine", "id",
    ))


def matching_pairs(units: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """a, b: each class with its best partner in every unit, by shared coordinates.

    Pairs are compared on whole signatures within a unit: the lists of the other coordinates are
    never merged, and a pair counts only in the first list that both are in. Best partners keep a
    large group to as many pairs as it has members and lists.
    """
    run, least = run_length(threshold), least_matches(threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, UNIT):
            ids = table.column("id").to_numpy()
            best = np.zeros(len(ids), np.int64)
            for i, j, n in _close_pairs(table, ids, run, least):
                np.maximum.at(best, i, n * len(ids) + j)
                np.maximum.at(best, j, n * len(ids) + i)
            some = np.flatnonzero(best)
            found = np.sort(np.stack([some, best[some] % len(ids)], 1), 1)
            found = np.unique(found, axis=0)
            yield _pairs(ids, found[:, 0], found[:, 1])

    marked = units.join(classes.select("id", "signature"), "id")
    dealt = marked.repartition(*UNIT).sortWithinPartitions(*UNIT)
    return dealt.mapInArrow(compare, "a long, b long")


def links_between(
    units: DataFrame, classes: DataFrame, sets: DataFrame, roots: DataFrame, stages: Stages,
    threshold: float, numerator: int, denominator: int,
) -> DataFrame:
    """a, b: linked classes of different roots (id, root). Every matching pair is confirmed on full
    sets where it is found, so that a group of nearly similar classes sends no pairs, only links."""
    run, least = run_length(threshold), least_matches(threshold)
    rooted = units.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = stages.put("rooted-units", rooted)
    open_ = rooted.groupBy(*UNIT).agg(F.min("root").alias("x"), F.max("root").alias("y"))
    open_ = stages.put("open-units", open_.where("x < y").select(*UNIT))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, UNIT, 2_000):
            ids, root = table.column("id").to_numpy(), table.column("root").to_numpy()
            members = [np.frombuffer(m, np.uint64) for m in table.column("members").to_pylist()]
            for i, j, _ in _close_pairs(table, root, run, least):
                linked = [
                    k for k, (x, y) in enumerate(zip(i.tolist(), j.tolist()))
                    if _similar(members[x], members[y], numerator, denominator)
                ]
                yield _pairs(ids, i[linked], j[linked])

    marked = (
        rooted.join(open_, UNIT, "left_semi").join(classes.select("id", "signature"), "id")
        .join(sets, "id")
    )
    dealt = marked.repartition(*UNIT).sortWithinPartitions(*UNIT)
    return dealt.mapInArrow(compare, "a long, b long")


def _close_pairs(
    table: pa.Table, root: np.ndarray, run: int, least: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows i and j of one unit and of different roots that share ``least`` coordinates or more, and
    how many; only in the first list that both are in."""
    at = table.column("at").to_numpy()
    keys = np.stack([table.column(c).to_numpy().astype(np.int64) for c in UNIT], 1)
    mine = table.column("mine").to_numpy()
    inner = keys[:, 2] == keys[:, 3]
    marks = _as_matrix(table.column("signature"))
    new = np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)])
    group = np.cumsum(new)
    first = np.arange(len(mine))
    for shift in range(1, len(mine)):
        first = first[: np.searchsorted(first, len(mine) - shift)]
        first = first[group[first] == group[first + shift]]
        if not len(first):
            break
        second = first + shift
        apart = (inner[first] | (mine[first] != mine[second])) & (root[first] != root[second])
        pairs = np.flatnonzero(apart)
        for lo in range(0, len(pairs), 4096):
            i, j = first[pairs[lo : lo + 4096]], second[pairs[lo : lo + 4096]]
            same = marks[i] == marks[j]
            n = same.sum(1)
            close = np.flatnonzero(n >= least)
            runs = same[close, : COORDINATES // run * run]
            runs = runs.reshape(len(close), COORDINATES // run, run)
            close = close[runs.all(2).argmax(1) == at[i[close]]]
            yield i[close], j[close], n[close]


def _similar(x: np.ndarray, y: np.ndarray, numerator: int, denominator: int) -> bool:
    """Whether two sets, as sorted hashes, are as similar as asked for."""
    small, large = sorted((len(x), len(y)))
    if denominator * small < numerator * large:
        return False
    both = np.sort(np.concatenate([x, y]))
    shared = int((both[1:] == both[:-1]).sum())
    return denominator * shared >= numerator * (len(x) + len(y) - shared)


def _pairs(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
    return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high)], names=["a", "b"])


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000
) -> Iterator[pa.Table]:
    """Tables of about ``rows`` sorted rows; rows of equal keys are never in different tables."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.concat_tables(held).combine_chunks()
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            values = table.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(new)
        cut = int(cuts[-1]) if len(cuts) else 0
        if cut:
            yield table.slice(0, cut)
        held, size = [table.slice(cut)], table.num_rows - cut
    if size:
        yield pa.concat_tables(held).combine_chunks()


def confirmed(
    pairs: DataFrame, sets: DataFrame, numerator: int, denominator: int
) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked for."""
    left = sets.select(F.col("id").alias("a"), F.col("members").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("members").alias("of_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = [
                _similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), numerator, denominator)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(linked, pa.bool_()))

    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "of_a", "of_b").mapInArrow(check, "a long, b long")


def near_duplicates(
    docs: DataFrame, stages: Stages, key: str = "doc_id", text: str = "text", words: int = 5,
    numerator: int = 80, denominator: int = 100,
) -> DataFrame:
    """key, n_shingles, component_id and kept for every document.

    A-Z count as a-z. Documents with equal shingle sets are one class, and only classes are
    compared. Links are confirmed on full sets; ``component_id`` is the smallest key reachable
    (null keys are passed over), and ``kept`` says whether that is the document's own. Documents
    without words are linked with nothing. Of rows with one key in one component, all are kept.
    """
    made = _linked(docs, stages, "key", F.col(key), key, text, words, numerator, denominator)
    return made.select(
        F.col("key").alias(key), "n_shingles", "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def distinct_documents(
    docs: DataFrame, stages: Stages, key: str = "doc_id", text: str = "text", words: int = 5,
    numerator: int = 80, denominator: int = 100,
) -> DataFrame:
    """One document of each component with all its columns: the one of the smallest key, and of
    several rows with that key, the one with the smallest text digest, once."""
    made = _linked(docs, stages, "key", F.col(key), key, text, words, numerator, denominator)
    # Who stays is settled on keys and digests; the documents themselves are shuffled once.
    heads = stages.put("heads", (
        made.where("component IS NOT NULL").where(F.col("key").eqNullSafe(F.col("component_id")))
        .groupBy("component").agg(F.min("text_key").alias("head"), F.min("key").alias("head_key"))
        .drop("component")
    ))
    worded = F.coalesce(F.regexp_like(F.col(text), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    rows = docs.where(worded).select(
        F.struct(*docs.columns).alias("row"), F.col(key).alias("key"),
        text_key(F.col(text)).alias("text_key"),
    )
    picked = rows.join(
        heads, (F.col("text_key") == F.col("head")) & F.col("key").eqNullSafe(F.col("head_key"))
    )
    nth = F.row_number().over(_window("text_key", "key").orderBy(F.xxhash64("row")))
    picked = picked.withColumn("nth", nth).where("nth = 1").select("row.*")
    return docs.where(~worded).unionByName(picked)


def _window(*names):
    from pyspark.sql import Window

    return Window.partitionBy(*names)


def _linked(docs, stages, column, value, key, text, words, numerator, denominator) -> DataFrame:
    threshold = numerator / denominator

    def describe(columns: list[list]) -> list[list]:
        n, keys, marks = [], [], []
        for body in columns[0]:
            found = shingles(body, words)
            n.append(len(found))
            keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if n[-1] else None)
            marks.append(signature(found) if n[-1] else None)
        return [n, keys, marks]

    slim = docs.select(F.col(key).alias("key"), text_key(F.col(text)).alias("text_key"),
                       F.col(text).alias("body"))
    described = stages.put("described", map_rows(
        slim, describe, ["key", "text_key"], ["body"],
        "n_shingles long, set_key binary, signature binary", step=512,
    ))
    classes = described.where("set_key is not null").groupBy("set_key").agg(
        F.min("key").alias("key"), F.min("text_key").alias("text_key"),
        F.max("signature").alias("signature"),
    )
    classes = stages.put("classes", classes.withColumn("id", F.monotonically_increasing_id()))
    units = list_units(classes, stages, threshold)
    # Each class with its best partners: that joins a group of near copies with few pairs.
    pairs = stages.put("best-pairs", matching_pairs(units, classes, threshold).distinct())

    # The full sets of the classes that are in a pair, from their texts.
    used = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    wanted = classes.join(used.distinct(), "id").select("id", F.col("text_key").alias("wanted"))

    def members(columns: list[list]) -> list[list]:
        return [[shingles(body, words).tobytes() for body in columns[0]]]

    bodies = slim.select("text_key", "body").join(wanted, F.col("text_key") == F.col("wanted"))
    sets = map_rows(bodies.dropDuplicates(["id"]), members, ["id"], ["body"], "members binary", step=512)
    sets = stages.put("sets", sets)

    first = stages.put("first-links", confirmed(pairs, sets, numerator, denominator))
    roots = components(first, stages, "first")
    # Then every link between different components. A class without a set is close to no other.
    rest = stages.put("other-links", links_between(
        units, classes, sets, roots, stages, threshold, numerator, denominator))
    roots = components(first.unionByName(rest), stages, "all")

    # The smallest id has no row of its own in roots.
    member = (
        classes.select("id", "set_key", "key").join(roots, "id", "left")
        .withColumn("component", F.coalesce("root", "id"))
    )
    smallest = member.groupBy("component").agg(F.min("key").alias("component_id"))
    member = stages.put(
        "members", member.join(smallest, "component").select("set_key", "component", "component_id")
    )
    rows = described.select("key", "text_key", "n_shingles", "set_key")
    if column == "row":
        rows = rows.drop("n_shingles")
        raise_rows = docs.select(
            value.alias("row"), F.col(key).alias("key"), text_key(F.col(text)).alias("text_key")
        )
        rows = raise_rows.join(rows.select("text_key", "set_key").distinct(), "text_key")
    return rows.join(member, "set_key", "left").withColumn(
        "component_id", F.when(F.col("component").isNull(), F.col("key")).otherwise(F.col("component_id"))
    )
