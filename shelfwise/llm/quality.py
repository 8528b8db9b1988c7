"""Quality rules: repetition rules and perplexity bands under a modified Kneser-Ney model."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import Stages, map_rows

# The symbols and the white space of the rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

#: n-grams are this many bytes of the words of a text, joined by one space; four fit in 32 bits.
ORDER = 4
#: A task holds the bits of at most this many n-grams (12 MB), the most frequent ones, however large
#: the corpus is. It finds them under hashes of this many bits. The bits of all others, and of those
#: whose hashes meet, come from a join.
HEAD_GRAMS, HASH_BITS = 1 << 20, 32
#: Rows of counts a task holds before it sends them on.
HELD_GRAMS = 1_000_000
#: Width of a band: so many robust standard deviations (interquartile range / 1.349) from the median.
BAND, DEVIATION = 6.0, 1.349
#: The clean model learns from texts within so many interquartile ranges of the median, with at
#: most this share of symbols among their characters, or twice their language's median share.
TRUSTED, SYMBOL_SHARE = 3.0, 0.01
#: Least interquartile range, in bits: a fixed part and one that is divided by the number of texts.
LEAST_SPREAD, FEW = 0.005, 0.5

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows found at least twice, the first included."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) ** 3 >= 1 << 63:  # three ids do not fit in a number
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(seen) + ids[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    at = np.flatnonzero(np.isin(windows, again))
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[at + shift] = True
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def grams_of(text: str | None) -> np.ndarray:
    """The n-grams of a text, each packed in a uint32; the words stand between single spaces."""
    words = (text or "").encode().split()
    if not words:
        return np.empty(0, np.uint32)
    b = (b" " + b" ".join(words) + b" ").rjust(ORDER)
    # Four bytes from every place, the first one highest.
    return np.ndarray(len(b) - ORDER + 1, ">u4", b, 0, 1).astype(np.uint32)


def _merged(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, times = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(times, first)


def gram_counts(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """lang, gram, n: how often each n-gram occurs in all texts of a language. Each task sends a
    gram once; what it holds is bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        raw: dict[str, list] = {}
        size = 0

        def reduce_raw() -> None:
            for name, grams in raw.items():
                keys, times = np.unique(np.concatenate(grams), return_counts=True)
                old = held.get(name)
                held[name] = [keys, times] if old is None else list(
                    _merged([old[0], keys], [old[1], times])
                )
            raw.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for name, (keys, times) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int64)),
                     pa.array(times.astype(np.int64))], names=["lang", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                grams = grams_of(body)
                if len(grams):
                    raw.setdefault(name, []).append(grams)
                    size += len(grams)
                if size > HELD_GRAMS:
                    reduce_raw()
                    size = 0
                    if sum(len(k) for k, _ in held.values()) > HELD_GRAMS:
                        yield from out()
        if raw:
            reduce_raw()
        yield from out()

    sent = docs.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.col(text).alias("body"))
    counted = sent.mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _suffix(order: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * order) - 1))


def kneser_ney(counts: DataFrame, stages: Stages | None = None) -> DataFrame:
    """The model's entries: lang, kind, gram, value.

    Kind ``n`` (1 to ORDER) holds the probability of a seen n-gram, kind ``ORDER + n`` the weight
    of the lower order after a context of ``n - 1`` bytes. The highest order has plain counts, the
    lower ones count the different bytes before them; each order has three discounts, from its
    counts of counts. The order below the lowest is uniform. With ``stages`` every order is a table
    of its own, so that the plan does not repeat the orders below and above it.
    """
    put = stages.put if stages else lambda name, df: df
    tables = {ORDER: counts.withColumnRenamed("n", "c")}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = put(
            f"grams-{n}",
            tables[n + 1].groupBy("lang", _suffix(n).alias("gram")).agg(F.count("*").alias("c")),
        )
    lower, entries = None, None
    for n in range(1, ORDER + 1):
        grams = tables[n]
        times = [F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        ones = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

        def discount(i: int) -> Column:
            fit = i - (i + 1) * ones * F.col(f"n{i + 1}") / F.col(f"n{i}")
            usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{i}") > 0)
            return F.when(usable, F.greatest(F.least(fit, F.lit(i - 0.05)), F.lit(0.05))).otherwise(
                0.75
            ).alias(f"d{i}")

        discounts = grams.groupBy("lang").agg(*times).select("lang", *map(discount, (1, 2, 3)))
        grams = grams.join(F.broadcast(discounts), "lang").withColumn(
            "cut", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2"))
            .otherwise(F.col("d3"))
        ).withColumn("context", F.shiftright("gram", 8))
        # A context has at most 256 n-grams, so its rows are few.
        same = Window.partitionBy("lang", "context")
        seen = grams.withColumn("total", F.sum("c").over(same)).withColumn(
            "weight", F.sum("cut").over(same) / F.col("total")
        )
        if lower is None:
            below = F.lit(1 / 256)
        else:
            seen = seen.withColumn("suffix", _suffix(n - 1)).join(
                lower.select("lang", F.col("gram").alias("suffix"), F.col("value").alias("below")),
                ["lang", "suffix"],
            )
            below = F.col("below")
        value = (F.col("c") - F.col("cut")) / F.col("total") + F.col("weight") * below
        table = put(f"seen-{n}", seen.select("lang", "gram", value.alias("value"), "context", "weight"))
        # The kind is no column of the table: who reads one kind has a plan with that table alone.
        lower = table.select("lang", F.lit(n).alias("kind"), "gram", "value")
        weights = table.groupBy("lang", "context").agg(F.max("weight").alias("value")).select(
            "lang", F.lit(ORDER + n).alias("kind"), F.col("context").alias("gram"), "value"
        )
        both = lower.unionByName(weights)
        entries = both if entries is None else entries.unionByName(both)
    return entries


def _slots(lang: str, kind: int | np.ndarray, grams: np.ndarray) -> np.ndarray:
    salt = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    x = grams.astype(np.uint64) | np.asarray(kind, np.uint64) << np.uint64(40)
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ x >> np.uint64(32)) >> np.uint64(64 - HASH_BITS)).astype(np.uint32)


def chances(counts: DataFrame, entries: DataFrame, stages: Stages | None = None) -> DataFrame:
    """lang, gram, n, value: the model's probability of every counted n-gram, seen by it or not.
    With ``stages`` the rows after each order are a table, so that no plan joins all orders."""
    put = stages.put if stages else lambda name, df: df
    rows = counts.select(
        "lang", "gram", "n", F.lit(None).cast("double").alias("value"), F.lit(1.0).alias("weight")
    )
    for k in range(ORDER, 0, -1):
        seen = entries.where(F.col("kind") == k).select(
            "lang", F.col("gram").alias("part"), F.col("value").alias("own")
        )
        back = entries.where(F.col("kind") == ORDER + k).select(
            "lang", F.col("gram").alias("context"), F.col("value").alias("back")
        )
        rows = put(f"chances-{k}", (
            rows.withColumn("part", _suffix(k)).withColumn("context", F.shiftright("part", 8))
            .join(seen, ["lang", "part"], "left").join(back, ["lang", "context"], "left")
            .select(
                "lang", "gram", "n",
                F.coalesce(F.col("value"), F.col("weight") * F.col("own")).alias("value"),
                (F.col("weight") * F.coalesce(F.col("back"), F.lit(1.0))).alias("weight"),
            )
        ))
        if stages and k < ORDER:
            stages.drop(f"chances-{k + 1}")
    return rows.select(
        "lang", "gram", "n", F.coalesce(F.col("value"), F.col("weight") / 256).alias("value")
    )


def _head(rows: DataFrame) -> Column:
    """Whether an n-gram is frequent enough to be held: by powers of two, at most HEAD_GRAMS are."""
    level = F.floor(F.log2("n"))
    sizes = rows.groupBy(level.alias("level")).count().collect()
    least, held = 64, 0
    for row in sorted(sizes, reverse=True):
        held += row[1]
        if held > HEAD_GRAMS:
            break
        least = row[0]
    return level >= least


def hash_arrays(
    entries: DataFrame, held: Column | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of entries and their values: those that are to be ``held`` (all) and whose hash
    no other entry has, held or not. So a hash that is found is that of the entry looked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array(batch.column(0).to_pylist(), object)
            kind, gram = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            slot = np.zeros(len(lang), np.int64)
            for name in set(lang.tolist()):
                own = lang == name
                slot[own] = _slots(name, kind[own].astype(np.uint64), gram[own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), batch.column(3), batch.column(4)], names=["slot", "value", "held"]
            )

    held = F.lit(True) if held is None else held
    slots = entries.select("lang", "kind", "gram", "value", held.alias("held")).mapInArrow(
        run, "slot long, value double, held boolean"
    )
    alone = slots.groupBy("slot").agg(
        F.max("value").alias("value"), F.max("held").alias("held"), F.count("*").alias("met")
    )
    rows = alone.where("held AND met = 1").select("slot", "value").toArrow()
    slot = rows.column("slot").to_numpy()
    order = np.argsort(slot)
    return slot[order].astype(np.uint32), rows.column("value").to_numpy()[order]


class Scorer:
    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        self.hashes, self.values = hashes, values
        # Where the hashes of each value of their upper bits start, one or two of each.
        upper = max(len(hashes).bit_length() - 1, 1)
        self.shift = np.uint32(HASH_BITS - upper)
        self.starts = np.zeros((1 << upper) + 1, np.int32)
        np.cumsum(np.bincount(hashes >> self.shift, minlength=1 << upper), out=self.starts[1:])

    def places(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each slot stands among the hashes, and whether it does."""
        upper = slots >> self.shift
        at, end = self.starts[upper], self.starts[upper + 1]
        found = np.zeros(len(slots), bool)
        left = np.flatnonzero(at < end)
        while len(left):
            have, want = self.hashes[at[left]], slots[left]
            found[left[have == want]] = True
            left = left[have < want]
            at[left] += 1
            left = left[at[left] < end[left]]
        return at, found

    def bits(self, lang: str, text: str | None) -> tuple:
        """The bits of the n-grams of a text that are held, the number of its n-grams (null bits
        without any), and the n-grams that are not held with how often each occurs."""
        packed = grams_of(text)
        if not len(packed):
            return None, 0, [], []
        grams, times = np.unique(packed, return_counts=True)
        slots = _slots(lang, ORDER, grams)
        at, found = self.places(slots)
        held = float(-(np.log2(self.values[at[found]]) @ times[found]))
        return held, int(times.sum()), grams[~found].tolist(), times[~found].tolist()


#: What ``Scorer.bits`` returns.
BITS = "held double, n_grams long, far_grams array<long>, far_times array<long>"


def _scored(rows: DataFrame, model: DataFrame, stages: Stages, name: str) -> DataFrame:
    """``rows`` with the mean number of bits for a byte of their words as column ``name``, instead of
    BITS. The n-grams that tasks did not hold are joined with the model; their sums are a table of
    known size, so documents are not shuffled for few of them."""
    far = F.explode(F.arrays_zip("far_grams", "far_times")).alias("far")
    times = rows.where(F.size("far_grams") > 0).select("at", F.col("tongue").alias("lang"), far).select(
        "at", "lang", F.col("far.far_grams").alias("gram"), F.col("far.far_times").alias("times")
    )
    more = stages.put(f"far-{name}", times.join(model, ["lang", "gram"]).groupBy("at").agg(
        F.sum(-F.log2("value") * F.col("times")).alias("more")
    ))
    bits = F.try_divide(
        F.col("held") + F.coalesce(F.col("more"), F.lit(0.0)), F.col("n_grams").cast("double")
    )
    return rows.join(more, "at", "left").withColumn(name, bits).drop(
        "more", *(f.split()[0] for f in BITS.split(", "))
    )


def quality(
    docs: DataFrame, stages: Stages, key: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The key with the rule counts, ``bits_per_byte`` (log2 of the perplexity of a byte),
    ``base_failed`` and ``kept``, for every document.

    The model of each language (null is a language of its own) is counted over all its texts.
    ``bits_per_byte`` comes from it. Junk that is frequent looks likely to it, so a second, clean
    model is counted over the texts that pass the base rules, are not full of symbols and are near
    their language's median perplexity. A document that passes the base rules is rejected when its
    perplexity under the clean model is outside its language's band. The bands come from all such
    documents. A text without words fails the base rules.
    """
    judged = _judged(docs, stages, F.col(key), text, lang)
    names = [f.split()[0] for f in BASE.split(", ")]
    return judged.select(
        F.col("row").alias(key), *names, "bits_per_byte", "base_failed", "kept"
    )


def quality_documents(
    docs: DataFrame, stages: Stages, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The documents that :func:`quality` keeps, with all their columns."""
    judged = _judged(docs, stages, F.struct(*docs.columns), text, lang)
    return judged.where("kept").select("row.*")


def _judged(docs: DataFrame, stages: Stages, row: Column, text: str, lang: str) -> DataFrame:
    context = docs.sparkSession.sparkContext

    def held(chances_: DataFrame):
        entries = chances_.withColumn("kind", F.lit(ORDER))
        return context.broadcast(hash_arrays(entries, _head(chances_)))

    counts = stages.put("gram-counts", gram_counts(docs, lang, text))
    # It was counted over all texts, so it has seen every n-gram.
    seen = kneser_ney(counts, stages).where(F.col("kind") == ORDER).drop("kind")
    chance = stages.put("chances", counts.join(seen, ["lang", "gram"]))
    model = held(chance)

    def measure(columns: list[list]) -> list[list]:
        scorer = Scorer(*model.value)
        rows = [(*base_counts(body), *scorer.bits(name, body)) for body, name in zip(*columns)]
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(9)]

    rows = docs.select(
        row.alias("row"), F.col(text).alias("body"), F.coalesce(F.col(lang), F.lit("")).alias("tongue")
    )
    measured = map_rows(
        rows, measure, ["row", "body", "tongue"], ["body", "tongue"], f"{BASE}, {BITS}"
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = stages.put("measured", measured.withColumn("base_failed", failed).withColumn(
        "at", F.monotonically_increasing_id()
    ))
    model.destroy()
    measured = _scored(measured, chance, stages, "bits_per_byte")

    share = F.col("n_symbols") / F.col("word_chars")
    middle = stages.put("middle", _middle(
        measured, "bits_per_byte", F.percentile_approx(share, 0.5, 10_000).alias("symbols")
    ))
    near = F.abs(F.col("bits_per_byte") - F.col("median")) <= TRUSTED * F.col("spread")
    plain = share <= F.greatest(F.lit(SYMBOL_SHARE), 2 * F.col("symbols"))
    trusted = measured.where(~F.col("base_failed")).join(middle, "tongue").where(near & plain)
    clean_counts = stages.put("clean-counts", gram_counts(trusted, "tongue", "body"))
    chance = chances(counts, kneser_ney(clean_counts, stages), stages)
    clean = held(chance)

    def again(columns: list[list]) -> list[list]:
        scorer = Scorer(*clean.value)
        rows = [
            scorer.bits(name, None if failed else body)
            for body, name, failed in zip(*columns)
        ]
        return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(4)]

    keep = [c for c in measured.columns if c != "body"]
    judged = stages.put("judged", map_rows(
        measured, again, keep, ["body", "tongue", "base_failed"], BITS
    ))
    clean.destroy()
    judged = _scored(judged, chance, stages, "clean_bits")
    width = BAND / DEVIATION * F.col("spread")
    # A table of one row per language, of known size: Spark need not shuffle documents by language.
    bands = stages.put("bands", _middle(judged, "clean_bits").select(
        "tongue", (F.col("median") - width).alias("low"), (F.col("median") + width).alias("high")
    ))
    inside = F.coalesce(F.col("clean_bits").between(F.col("low"), F.col("high")), F.lit(False))
    return judged.join(bands, "tongue", "left").withColumn("kept", ~F.col("base_failed") & inside)


def _middle(measured: DataFrame, bits: str, *more: Column) -> DataFrame:
    """tongue, median and spread of the texts that pass the base rules, and aggregates ``more``."""
    quarters = F.percentile_approx(bits, [0.25, 0.5, 0.75], 10_000)
    found = measured.where(~F.col("base_failed")).groupBy("tongue").agg(
        quarters.alias("q"), F.count("*").alias("n"), *more
    )
    least = LEAST_SPREAD + FEW / F.col("n")
    return found.withColumn("median", F.col("q")[1]).withColumn(
        "spread", F.greatest(F.col("q")[2] - F.col("q")[0], least)
    ).drop("q", "n")
