"""Near-duplicate vectors: exact threshold pairs by dual traversal of cover trees."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Stages, map_rows
from shelfwise.llm.components import components
from shelfwise.llm.minhash import whole_groups

#: Top nodes of the tree: at most so many centres, fitted on at most so many vectors.
CENTRES, FITTED = 256, 4_096
#: Vectors of one node that are worked on together; a larger node is cut in parts.
PART = 8_192
#: A node with fewer vectors is not divided further, and a node has at most so many children.
LEAF, CHILDREN = 1_024, 16
#: Room for rounding when distances are compared; cosines decide in the end.
SLACK = 1e-6


class Node:
    """A ball: its centre, the largest distance from it to a vector below, and those vectors."""

    __slots__ = ("centre", "radius", "rows", "children")

    def __init__(self, centre: np.ndarray, radius: float, rows: np.ndarray):
        self.centre, self.radius, self.rows = centre, radius, rows
        self.children: list[Node] = []


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def cover(vectors: np.ndarray, radius: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres more than ``radius`` apart that cover all vectors, and each vector's nearest one.
    With ``most`` centres the rest is left to the nearest of them."""
    nearest = np.full(len(vectors), np.inf)
    owner = np.zeros(len(vectors), np.int64)
    centres: list[int] = []
    at = 0
    while len(centres) < most and nearest[at] > radius:
        d = distances(vectors, vectors[at : at + 1])[:, 0]
        closer = d < nearest
        nearest[closer], owner[closer] = d[closer], len(centres)
        centres.append(at)
        at = int(nearest.argmax())
    return np.array(centres), owner


def grow(vectors: np.ndarray, rows: np.ndarray, centre: np.ndarray, scale: float, least: float) -> Node:
    """A tree of nested levels, the radius halving from one to the next."""
    node = Node(centre, float(distances(vectors[rows], centre[None]).max()), rows)
    if len(rows) <= LEAF or node.radius <= least:
        return node
    centres, owner = cover(vectors[rows], scale / 2, CHILDREN)
    if len(centres) < 2:
        if scale / 2 > least:
            return grow(vectors, rows, centre, scale / 2, least)
        return node
    for k, c in enumerate(centres):
        own = rows[owner == k]
        node.children.append(grow(vectors, own, vectors[rows[c]], scale / 2, least))
    return node


class Forest:
    """Union-find over positions, in whole arrays: the links that join two components are kept, so
    at most one less than there are positions, and they join what all links do."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.kept: list[np.ndarray] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            # Every root with a link to a smaller one is hung under one such root: no cycles.
            high, first = np.unique(np.maximum(a, b), return_index=True)
            self.kept.append(np.stack([i[first], j[first]], 1))
            self.root[high] = np.minimum(a, b)[first]
            while ((up := self.root[self.root]) != self.root).any():
                self.root = up

    def links(self) -> np.ndarray:
        return np.concatenate(self.kept) if self.kept else np.empty((0, 2), np.int64)


class Join:
    """Counts the links of each vector and keeps a spanning forest of them."""

    def __init__(self, left: np.ndarray, right: np.ndarray, cosine: float, same: bool,
                 left_copies: np.ndarray, right_copies: np.ndarray):
        self.left, self.right, self.cosine, self.same = left, right, cosine, same
        self.reach = math.sqrt(max(2 - 2 * cosine, 0)) + SLACK
        self.copies = left_copies, right_copies
        self.links = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        # Right positions follow the left ones, unless both sides are the same vectors.
        self.offset = 0 if same else len(left)
        self.forest = Forest(self.offset + len(right))

    def run(self, a: Node, b: Node) -> None:
        """Dual traversal. A pair of nodes whose balls are further apart than a link is pruned;
        two leaves are compared vector by vector."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if not a.children and not b.children:
                self.compare(a.rows, b.rows)
                continue
            if self.same and a is b:
                parts = a.children
                apart = distances(*(np.stack([p.centre for p in parts]),) * 2)
                i, j = np.triu_indices(len(parts))
                first, second = parts, parts
            else:
                first, second = (a.children or [a]), (b.children or [b])
                apart = distances(
                    np.stack([p.centre for p in first]), np.stack([p.centre for p in second])
                )
                i, j = (x.ravel() for x in np.indices(apart.shape))
            bound = np.array([p.radius for p in first])[i] + np.array([p.radius for p in second])[j]
            near = apart[i, j] <= bound + self.reach
            stack += [(first[x], second[y]) for x, y in zip(i[near], j[near])]

    def compare(self, rows: np.ndarray, others: np.ndarray) -> None:
        for at in range(0, len(rows), 2048):
            part = rows[at : at + 2048]
            i, j = np.nonzero(self.left[part] @ self.right[others].T >= self.cosine)
            i, j = part[i], others[j]
            if self.same:
                if rows is others or np.array_equal(rows, others):
                    keep = i < j
                    i, j = i[keep], j[keep]
            np.add.at(self.links[0], i, self.copies[1][j])
            np.add.at(self.links[1], j, self.copies[0][i])
            self.forest.add(i, j + self.offset)


def joined(
    left: np.ndarray, right: np.ndarray, cosine: float, same: bool,
    left_copies: np.ndarray, right_copies: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of each left and each right vector (copies counted), and spanning links."""
    join = Join(left, right, cosine, same, left_copies, right_copies)
    least = join.reach / 4
    trees = [grow(x, np.arange(len(x)), x[0], 2.0, least) for x in ((left,) if same else (left, right))]
    join.run(trees[0], trees[-1])
    return join.links[0], join.links[1], join.forest.links() - [0, join.offset]


def near_vectors(
    vectors: DataFrame, stages: Stages, key: str = "vec_id", vector: str = "embedding",
    cosine: float = 0.9,
) -> DataFrame:
    """key, n_links, component_id and kept for every vector.

    Links are pairs of other vectors with a cosine of at least ``cosine`` in double precision.
    Vectors that are null, empty or zero, or have a component that is null or not finite, are
    linked with nothing, and vectors of different lengths are not linked. ``component_id`` is the
    smallest key reachable (null keys are passed over).

    Vectors that are multiples of each other are one node with a count. The top level of the tree
    is fitted on a bounded sample; every vector belongs to the nearest centre, and a vector meets
    the parts of another centre only if it is within that ball's radius and a link's length of it.
    All pairs that may link meet in one unit of work, where trees are grown and traversed.
    """

    def unit(columns: list[list]) -> list[list]:
        out: list[list] = [[], []]
        for values in columns[0]:
            body = None
            if values and None not in values:
                x = np.array(values, np.float64)
                size = np.linalg.norm(x / np.abs(x).max()) * np.abs(x).max() if np.abs(x).max() > 0 else 0
                if np.isfinite(x).all() and size > 0 and np.isfinite(size):
                    body = (x / np.abs(x).max()) / np.linalg.norm(x / np.abs(x).max())
            out[0].append(None if body is None else body.tobytes())
            out[1].append(None if body is None else len(body))
        return out

    rows = map_rows(
        vectors.select(F.col(key).alias("key"), F.col(vector).alias("v")), unit, ["key"], ["v"],
        "unit binary, width int",
    )
    rows = stages.put("units", rows)
    nodes = rows.where("unit is not null").groupBy("unit", "width").agg(
        F.count("*").alias("copies"), F.min("key").alias("key")
    )
    nodes = stages.put("nodes", nodes.withColumn("id", F.monotonically_increasing_id()))

    # The top level, from a bounded sample: about one centre for PART vectors, CENTRES at most.
    total = nodes.count()
    sample = nodes.orderBy(F.xxhash64("unit")).limit(FITTED).select("width", "unit").toPandas()
    top: dict[int, np.ndarray] = {}
    for width, part in sample.groupby("width"):
        x = np.frombuffer(b"".join(part["unit"]), np.float64).reshape(-1, width)
        top[int(width)] = x[cover(x, 0.5, min(CENTRES, math.ceil(total / PART)))[0]]
    context = vectors.sparkSession.sparkContext
    centres = context.broadcast(top)

    def belong(columns: list[list]) -> list[list]:
        out: list[list] = [[], []]
        for body, width in zip(*columns):
            d = distances(np.frombuffer(body, np.float64)[None], centres_of(centres.value, width))[0]
            k = int(d.argmin())
            out[0].append(k)
            out[1].append(float(d[k]))
        return out

    placed = stages.put("placed", map_rows(
        nodes, belong, ["id", "copies", "width", "unit"], ["unit", "width"],
        "centre int, distance double",
    ))
    balls = placed.groupBy("width", "centre").agg(
        F.max("distance").alias("radius"), F.ceil(F.count("*") / PART).cast("int").alias("parts")
    ).toPandas()
    known = context.broadcast({
        (int(r.width), int(r.centre)): (float(r.radius), int(r.parts))
        for r in balls.itertuples(index=False)
    })
    reach = math.sqrt(max(2 - 2 * cosine, 0)) + SLACK
    columns = ["width", "a", "a_part", "b", "b_part", "right", "id", "copies", "unit"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                out: list[tuple] = []
                part = whole.slice(at, 512)
                for id_, copies, width, body, own in zip(*(c.to_pylist() for c in part.columns)):
                    tops = centres_of(centres.value, width)
                    d = distances(np.frombuffer(body, np.float64)[None], tops)[0]
                    mine = (id_ * 0x9E3779B1 >> 16) % known.value[width, own][1]
                    for other in range(len(tops)):
                        radius, parts = known.value.get((width, other), (0.0, 0))
                        if other != own and d[other] > radius + reach:
                            continue
                        for p in range(parts):
                            here, there = (own, mine), (other, p)
                            right = here > there
                            unit = (*there, *here) if right else (*here, *there)
                            out.append((width, *unit, right, id_, copies, body))
                if out:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(c, t) for c, t in zip(zip(*out), (
                            *[pa.int32()] * 5, pa.bool_(), pa.int64(), pa.int64(), pa.binary()))
                    ], names=columns)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, columns[:5], rows=1):
            keys = np.stack([table.column(c).to_numpy() for c in columns[:5]], 1)
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(keys))):
                yield from link(table.slice(lo, hi - lo), int(keys[lo, 0]), (keys[lo, 1:3] == keys[lo, 3:]).all())

    def link(table: pa.Table, width: int, same: bool) -> Iterator[pa.RecordBatch]:
        x = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(-1, width)
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        right = np.array(table.column("right").to_pylist(), bool)
        sides = (~right, ~right) if same else (~right, right)
        if not (sides[0].any() and sides[1].any()):
            return
        one, two, edges = joined(
            x[sides[0]], x[sides[1]], cosine, bool(same), copies[sides[0]], copies[sides[1]]
        )
        a, b = ids[sides[0]], ids[sides[1]]
        for id_, links in ((a, one), (b, two)):
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([
                pa.array(id_[some]), pa.array(links[some]), pa.nulls(len(some), pa.int64())
            ], names=["id", "links", "to"])
        yield pa.RecordBatch.from_arrays([
            pa.array(a[edges[:, 0]]), pa.array(np.zeros(len(edges), np.int64)), pa.array(b[edges[:, 1]])
        ], names=["id", "links", "to"])

    units = placed.select("id", "copies", "width", "unit", "centre").mapInArrow(
        deal, "width int, a int, a_part int, b int, b_part int, right boolean, id long, copies long,"
        " unit binary",
    )
    found = stages.put("found", units.repartition(*columns[:5]).sortWithinPartitions(*columns[:5])
                       .mapInArrow(compare, "id long, links long, to long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(
        found.where("to is not null").select(F.col("id").alias("a"), F.col("to").alias("b")),
        stages, "roots",
    )
    member = (
        nodes.join(links, "id", "left").join(roots, "id", "left")
        .withColumn("component", F.coalesce("root", "id"))
    )
    smallest = member.groupBy("component").agg(F.min("key").alias("component_id"))
    member = stages.put("members", member.join(smallest, "component").select(
        "unit", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id",
    ))
    made = rows.join(member, "unit", "left")
    component = F.when(F.col("n_links").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return made.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"),
    )


def centres_of(top: dict[int, np.ndarray], width: int) -> np.ndarray:
    """The first axis is the one centre of a width that the sample lacks."""
    return top[width] if width in top else np.eye(1, width)
