"""Substring deduplication of words by level-wise doubling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from shelfwise.llm.common import Stages
from shelfwise.llm.repeats import Units, repeated_spans


def doubling_levels(window: int) -> list[int]:
    """1, 2, 4, ... and at last the window."""
    levels = [1]
    while levels[-1] < window:
        levels.append(min(levels[-1] * 2, window))
    return levels


def repeated_windows(pieces: list[bytes], times: np.ndarray, window: int) -> list[np.ndarray]:
    """For each piece (words joined by a space), which of its windows occur twice or more.

    At every level each place has a number for the run of words that starts there. Only places
    whose run is repeated are extended: two neighbouring repeated runs make one of twice the
    length, whose pair of numbers is numbered anew. It ends when the window is reached or no place
    survives. Pieces differ; a piece counts as often as ``times`` says.
    """
    lengths, ids, known = [], [], {}
    for p in pieces:
        words = p.split()
        lengths.append(len(words))
        ids += [known.setdefault(w, len(known)) for w in words]
    lengths = np.array(lengths)
    ends = np.cumsum(lengths)
    piece = np.repeat(np.arange(len(pieces)), lengths)
    weight, stop = times[piece], ends[piece]
    number = np.array(ids, np.int64)
    places = np.arange(len(number))
    run = 1
    for level in doubling_levels(window):
        if level > 1:
            step = level - run
            alive = np.zeros(len(number) + 1, bool)
            alive[places] = True
            places = places[(places + level <= stop[places])]
            places = places[alive[places + step]]
            pair = number[places] * np.int64(len(number) + 1) + number[places + step]
        else:
            pair = number
        if not len(places):
            break
        _, fresh = np.unique(pair, return_inverse=True)
        often = np.bincount(fresh, weight[places]) > 1
        places, fresh = places[often[fresh]], fresh[often[fresh]]
        number = number.copy()
        number[places] = fresh
        run = level
    hit = np.zeros(len(stop), bool)
    if run == window:
        hit[places] = True
    return [
        hit[e - n : e - n + max(n - window + 1, 0)] for e, n in zip(ends.tolist(), lengths.tolist())
    ]


def remove_repeated_words(
    docs: DataFrame, stages: Stages, key: str = "doc_id", text: str = "text", window: int = 35
) -> DataFrame:
    """key, n_words, n_removed, n_spans and kept_sha256 for every document.

    The first level over the corpus is half a window: runs of that many words (one anchor for each
    window) are counted, and only repeated ones are extended. Then the doubling of
    :func:`repeated_windows` goes on among texts that share an anchor.
    """
    units = Units(True, window, (window + 1) // 2)
    made = repeated_spans(
        docs, stages, units, lambda p, t: repeated_windows(p, t, window), key, text
    )
    return made.withColumnRenamed("n_units", "n_words")
