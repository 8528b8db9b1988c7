"""The Merkle manifest against trees built whole."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import merkle, queries


def digest(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def whole(nodes):
    """Root and every leaf's proof: (side of the sibling, sibling), side 2 where there is none."""
    proofs, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        higher, under = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for place, leaves in enumerate(below[i : i + 2]):
                for j in leaves:
                    proofs[j].append((2, "") if len(run) == 1 else (1 - place, run[1 - place]))
            higher.append(digest(*run))
            under.append(sum(below[i : i + 2], []))
        nodes, below = higher, under
    return nodes[0], proofs


def expected(docs):
    """Rows of (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in docs:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        same = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees.append((same, *whole([leaf(*r) for r in same])))
    if not trees:
        return []
    root, tops = whole([t[1] for t in trees])
    out = []
    for (same, subroot, proofs), top in zip(trees, tops):
        for row, proof in zip(same, proofs):
            path, value = proof + top, leaf(*row)
            folded = value
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                folded = leaf(*row[:3], row[3] + 1, row[4])
            for side, sibling in path:
                folded = digest(*((sibling, folded) if side == 0 else (folded, sibling)))
            siblings = digest(*(s for _, s in path))
            out.append((row[0], value, subroot, root, siblings, folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def document_rows(seed, n):
    rng = random.Random(seed)
    langs = ["en"] * 6 + ["de", "é", None, ""]
    rows = [
        (rng.choice([None, *range(2 * n)]), rng.choice(["web", None, ""]), rng.choice(langs),
         rng.choice([None, 5, 2**63 - 1]), rng.choice([None, "", "ö" * 9, "1:x-", "t" * 40_000]))
        for _ in range(n)
    ]
    return rows + [(3, "web", "en", 5, "same")] * (n // 3) + [(9, "x", "only", 1, "alone")]


@pytest.mark.parametrize("height, n", [(10, 60), (2, 60), (1, 41), (2, 300)])
def test_manifest_equals_brute_force(spark, stages, rows, monkeypatch, height, n):
    """Trees of one block, and of blocks under blocks."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    data = document_rows(n + height, n)
    frame = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    frame = frame.repartition(5)
    for name in ("tree", "pos", "n", "witness", "leaf", "digest", "_part"):
        frame = frame.withColumn(name, F.lit(1))
    assert rows(merkle.manifest_report(frame, stages), *COLUMNS) == expected(data)


def test_manifest_of_all_documents(spark, rows):
    sf = "/root/testdata/sf0.001"
    names = ("doc_id", "source", "lang", "n_chars", "text")
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*names).collect()]
    made = rows(queries.op13_merkle_manifest(spark, sf), *COLUMNS)
    assert made == expected(data) and {r[-1] for r in made} == {True, False}


def test_empty_table_and_one_row(documents, stages, rows):
    assert merkle.manifest_report(documents([(1, "x")]).limit(0), stages).collect() == []
    assert rows(merkle.manifest_report(documents([(1, "x", "en", "web")]), stages), *COLUMNS) == expected(
        [(1, "web", "en", 1, "x")])


@pytest.mark.parametrize("n", range(1, 34))
def test_witnesses_lead_to_the_root(n):
    leaves = [sha256(bytes([i])).digest() for i in range(n)]
    frontier = merkle.Frontier()
    for value in leaves:
        frontier.append(value)
    root = frontier.close((n - 1).bit_length())
    assert root.hex() == whole([v.hex() for v in leaves])[0]
    assert all(merkle.fold(v, bytes(w)) == root for v, w in zip(leaves, frontier.witnesses))
    assert merkle.fold(leaves[0][::-1], bytes(frontier.witnesses[0])) != root
