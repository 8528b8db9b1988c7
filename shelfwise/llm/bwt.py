"""Substring deduplication of bytes: interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from shelfwise.llm.common import Stages
from shelfwise.llm.repeats import Units, repeated_spans


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes in the order of at least their first ``depth`` symbols (0 to 256).

    A suffix's rank is where its group of so far equal ones begins. Only groups of several suffixes
    are sorted again, by the rank of what follows.
    """
    n, reach = len(text), 7  # 257 ** 7 fits in 63 bits
    rank = np.zeros(n, np.int64)
    for i in range(reach):
        rank *= 257
        rank[: max(n - i, 0)] += text[i:]
    order = np.argsort(rank)
    places, key = np.arange(n), rank[order]
    while True:
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        last = np.ones(len(key), bool)
        last[:-1] = first[1:]
        begins = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
        rank[order[places]] = places[begins]
        places = places[~(first & last)]
        if reach >= depth or not len(places):
            return order
        at = order[places]
        after = np.zeros(len(at), np.int64)
        inside = at + reach < n
        after[inside] = rank[at[inside] + reach] + 1
        key = rank[at] * np.int64(n + 1) + after
        by = np.argsort(key)
        order[places], key = at[by], key[by]
        reach *= 2


def prefix_bounds(text: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """For each place in the suffix order, the symbols that its suffix shares with the one before,
    or -1 for ``least`` or more.

    Breadth first: the intervals of all strings of one length are extended by one symbol to the
    left, within the transform. The end of an interval that no shorter string has set gets the
    length reached, and only such an interval is extended further. So shared prefixes come in
    increasing order, and the search stops at ``least``. Symbol 0 ends a piece and is not put in
    front of a string.

    An interval's extension by a symbol reaches from the first to the last place in it that the
    symbol stands before: places whose neighbour with the same symbol lies outside.
    """
    n = len(text)
    before = text[order - 1]
    ended = before == 0
    by_symbol = np.argsort(before.astype(np.uint16), kind="stable").astype(np.int32)
    to_front = np.empty(n, np.int32)
    to_front[by_symbol] = np.arange(n, dtype=np.int32)
    previous, following = np.full(n, -1, np.int32), np.full(n, n, np.int32)
    same = before[by_symbol[1:]] == before[by_symbol[:-1]]
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    previous[ended], following[ended] = n, -1  # neither first nor last in any interval

    shared = np.full(n + 1, -1, np.int32)
    counts = np.bincount(text)
    high = np.cumsum(counts)[counts > 0].astype(np.int32)
    low = np.concatenate([[0], high[:-1]]).astype(np.int32)
    shared[0] = 0
    shared[high] = 0
    alone = low[:0]  # intervals of one place
    for length in range(1, least):
        one = high - low == 1
        alone = np.concatenate([alone, low[one]])
        low, high = low[~one], high[~one]
        size = high - low
        of = np.repeat(np.arange(len(low), dtype=np.int32), size)
        skipped = np.cumsum(size, dtype=np.int32) - size
        inside = np.arange(len(of), dtype=np.int32) + (low - skipped)[of]
        first = inside[previous[inside] < low[of]]
        last = inside[following[inside] >= high[of]]
        # In front order the extensions follow each other, so that starts and ends pair up.
        low, high = np.sort(to_front[first]), np.sort(to_front[last]) + 1
        alone = to_front[alone[~ended[alone]]]
        fresh = shared[high] < 0
        low, high = low[fresh], high[fresh]
        alone = alone[shared[alone + 1] < 0]
        if not len(low) and not len(alone):
            break
        shared[high] = length
        shared[alone + 1] = length
    return shared[:n]


def repeated_windows(pieces: list[bytes], times: np.ndarray, window: int) -> list[np.ndarray]:
    """For each piece, which of its windows occur twice or more; pieces differ, and a piece counts
    as often as ``times`` says."""
    lengths = np.array([len(p) for p in pieces])
    ends = np.cumsum(lengths + 1)
    text = np.zeros(int(ends[-1]), np.int64)
    piece = np.repeat(np.arange(len(pieces)), lengths + 1)
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    text[inside] = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64) + 1
    order = suffix_order(text, window)
    group = np.cumsum(prefix_bounds(text, order, window) >= 0) - 1
    whole = np.arange(len(text)) + window < ends[piece]
    weight = np.where(whole, times[piece], 0)
    often = np.bincount(group, weight[order]) > 1
    hit = np.zeros(len(text), bool)
    hit[order] = often[group]
    hit &= whole
    return [
        hit[e - n - 1 : e - 1 - window + 1] if n >= window else np.zeros(0, bool)
        for e, n in zip(ends.tolist(), lengths.tolist())
    ]


def remove_repeated_bytes(
    docs: DataFrame, stages: Stages, key: str = "doc_id", text: str = "text", window: int = 200
) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept_sha256 for every document (UTF-8 bytes)."""
    units = Units(False, window, max(window * 8 // 25, 1))
    made = repeated_spans(
        docs, stages, units, lambda p, t: repeated_windows(p, t, window), key, text
    )
    return made.withColumnRenamed("n_units", "n_bytes")
