"""Substring deduplication of words and of bytes, against counting every window."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import bwt, doubling, repeats
from tests.llm.texts import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, window, words):
    units = [WORD.findall(t or "") if words else (t or "").encode() for _, t in rows]
    seen = Counter(
        tuple(u[k : k + window]) for u in units for k in range(len(u) - window + 1)
    )
    out = []
    for (key, _), u in zip(rows, units):
        gone = [False] * len(u)
        for k in range(len(u) - window + 1):
            if seen[tuple(u[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(u, gone) if not g]
        body = " ".join(kept).encode() if words else bytes(kept)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((key, len(u), sum(gone), spans, hashlib.sha256(body).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("words, window", [(True, 7), (True, 12), (False, 40)])
def test_equals_counting_every_window(documents, stages, rows, words, window):
    data = corpus(window)
    run = doubling.remove_repeated_words if words else bwt.remove_repeated_bytes
    docs = documents(data, uid=F.lit(1), anchor=F.lit("x"), runs=F.lit(2))
    assert rows(run(docs, stages, window=window)) == expected(data, window, words)


@pytest.mark.parametrize("words", [True, False])
def test_frequent_anchors_and_cut_runs(documents, stages, rows, words, monkeypatch):
    """An anchor that is too frequent for one task, and runs longer than a piece."""
    monkeypatch.setattr(repeats, "TOGETHER", 3)
    monkeypatch.setattr(repeats, "PIECE", 5)
    data = corpus(3)
    run = doubling.remove_repeated_words if words else bwt.remove_repeated_bytes
    window = 9 if words else 40
    assert rows(run(documents(data), stages, window=window)) == expected(data, window, words)


@pytest.mark.parametrize("words", [True, False])
def test_empty_table(documents, stages, rows, words):
    run = doubling.remove_repeated_words if words else bwt.remove_repeated_bytes
    assert rows(run(documents([]), stages)) == []


@pytest.mark.parametrize("find", [bwt.repeated_windows, doubling.repeated_windows])
def test_finders(find):
    rng = random.Random(5)
    for _ in range(150):
        window, letters = rng.choice([2, 3, 5, 8]), rng.choice([b"ab", b"abc"])
        size = lambda: rng.randrange(0, 30)
        pieces = [bytes(rng.choice(letters) for _ in range(size())) for _ in range(4)]
        if find is doubling.repeated_windows:
            pieces = [b" ".join(p[i : i + 1] for i in range(len(p))) for p in pieces]
        pieces = sorted(set(pieces))
        times = np.array([rng.choice([1, 1, 2]) for _ in pieces])
        cut = [p.split() if find is doubling.repeated_windows else p for p in pieces]
        runs = [[tuple(u[k : k + window]) for k in range(len(u) - window + 1)] for u in cut]
        seen = Counter()
        for r, n in zip(runs, times):
            for x in r:
                seen[x] += int(n)
        assert [f.tolist() for f in find(pieces, times, window)] == [[seen[x] > 1 for x in r] for r in runs]


def test_runs_of_long_documents(monkeypatch):
    """Anchors do not depend on where a document is cut for the search."""
    body = " ".join(f"w{i * i % 97}" for i in range(900)).encode()
    units = repeats.Units(True, 20, 10)
    whole = repeats.anchor_runs(body, units)
    monkeypatch.setattr(repeats, "PLACES", 128)
    parts = repeats.anchor_runs(body, units)
    assert set(whole[0]) == set(parts[0]) and whole[3] == parts[3] == 881
