"""Language identification by error-correcting output codes."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import map_rows

#: Byte trigrams of the lower-cased text are counted in this many bins.
BINS = 1 << 15
LETTER = re.compile(r"[^\W\d_]")
UNDECIDED = "und"


def bins_of(text: str) -> np.ndarray:
    b = np.frombuffer((" " + text.lower() + " ").encode(), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    packed = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    return (packed * np.uint32(2654435761) >> np.uint32(32 - 15)).astype(np.int64)


def codewords(n: int) -> np.ndarray:
    """One row of -1 and 1 per language. Up to 6 languages: every split of the languages in two
    parts. More: the best of 64 seeded random codes by its smallest distance between two rows."""
    if n <= 6:
        columns = range(1, 1 << max(n - 1, 0))
        return np.array([[1 if c >> k & 1 else -1 for c in columns] for k in range(n)], np.int64)
    length, best, most = math.ceil(10 * math.log2(n)), None, -1
    rng = np.random.default_rng(20240501)
    for _ in range(64):
        code = rng.choice([-1, 1], (n, length))
        code = code[:, np.abs(code.sum(0)) < n]  # both parts of a bit have a language
        distance = (code[:, None] != code[None]).sum(2) + np.eye(n, dtype=int) * length
        if distance.min() > most:
            best, most = code, distance.min()
    return best


@dataclass(frozen=True)
class Model:
    """Languages in code point order, their codewords, a weight for each bin and bit, and for each
    bit its usual margin and how far decoding trusts it."""

    langs: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray
    usual: np.ndarray
    trust: np.ndarray

    def predict(self, text: str | None, ambiguous_below: float) -> tuple[str, float, bool]:
        """Language, score, and whether a second language is nearly as near."""
        if not text or not self.langs or not LETTER.search(text):
            return UNDECIDED, 0.0, True
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        bins = bins_of(text)
        total = np.zeros(self.weights.shape[1])
        for at in range(0, len(bins), 1 << 18):
            total += self.weights[bins[at : at + (1 << 18)]].sum(0)
        margins = total / max(len(bins), 1) / self.usual
        loss = (self.trust * np.logaddexp(0, -4 * self.code * margins)).sum(1)
        share = np.exp(loss.min() - loss)
        share /= share.sum()
        best = int(np.argmax(share))
        second = np.partition(share, -2)[-2]
        return self.langs[best], float(share[best]), bool(share[best] - second < ambiguous_below)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from every row with a text and a language.

    A task sends one row per language and bin, so what is shuffled and what reaches the driver is
    bounded by languages times bins, not by documents. Each bit is a naive Bayes classifier of the
    two sets of languages its column separates; languages weigh the same within a set.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums = held.setdefault(name, np.zeros(BINS, np.int64))
                bins = bins_of(body)
                for at in range(0, len(bins), 1 << 20):
                    sums += np.bincount(bins[at : at + (1 << 20)], minlength=BINS)
        for name, sums in held.items():
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(sums[at])],
                names=["lang", "bin", "n"],
            )

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("body")).dropna()
    counts = (
        rows.mapInArrow(run, "lang string, bin long, n long")
        .groupBy("lang", "bin").agg(F.sum("n").alias("n")).toArrow()
    )
    names = np.array(counts.column("lang").to_pylist(), object)
    langs = tuple(sorted(set(names.tolist())))
    share = np.full((len(langs), BINS), 0.5)
    bins, n = counts.column("bin").to_numpy(), counts.column("n").to_numpy()
    for k, name in enumerate(langs):
        share[k, bins[names == name]] += n[names == name]
    share /= share.sum(1, keepdims=True)
    code = codewords(len(langs))
    if len(langs) < 2:
        return Model(langs, code, np.zeros((BINS, 0)), np.zeros(0), np.zeros(0))
    sides = [(code == s).astype(float) for s in (1, -1)]
    one, other = (((side / side.sum(0)).T @ share).T for side in sides)
    weights = np.log(one) - np.log(other)
    expected = share @ weights  # the margin of each language's own text
    usual = np.abs(expected).mean(0)
    trust = np.clip((code * expected).min(0) / usual, 0.05, None)
    return Model(langs, code, weights.astype(np.float32), usual, trust / trust.sum() * len(trust))


def held_out(key: str) -> Column:
    """True for a fifth of the documents, by their key; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 5 == 0


def identify(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    ambiguous_below: float = 0.2,
) -> DataFrame:
    """key, held_out, lang_pred, score and ambiguous for every whole text.

    Learns from the rows that are not held out. Texts that are null or have no letter are ``und``
    with score 0, as is every text when there is nothing to learn from.
    """
    rows = docs.select(
        key, held_out(key).alias("held_out"), F.col(text).alias("_text"), F.col(lang).alias("_lang")
    )
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fit(rows.where(~F.col("held_out")), "_text", "_lang"))

    def run(columns: list[list]) -> list[list]:
        made = [model.value.predict(t, ambiguous_below) for t in columns[0]]
        return [list(c) for c in zip(*made)] if made else [[], [], []]

    return map_rows(
        rows, run, [key, "held_out"], ["_text"], "lang_pred string, score double, ambiguous boolean"
    )
