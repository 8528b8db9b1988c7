"""Benchmark decontamination, in DataFrame functions alone.

An item's window of words occurs in a document only if all its shingles do, so it is enough to look for
the rarest of them: the windows' prefix. Shingles of documents that some window holds are
joined once, counted, and of every window only the rarest shingle is kept and joined again; windows
with a shingle that no document has are out. A place that is left must leave room for the whole
window, and then the words themselves are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Stages, sieve, sifted

#: What stands between words, after A-Z have become a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_array(text: Column) -> Column:
    words = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN)
    return F.filter(words, lambda w: w != "")


def with_words(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and words. Going through ``explode`` makes the array once; else every use of it, one
    per word, might split the text again."""
    return df.select(*columns, F.explode(F.array(word_array(F.col("text")))).alias("words"))


def shingles(words: Column, size: int) -> Column:
    """One 64-bit hash per run of ``size`` words. These only choose what is compared."""
    shifted = [F.slice(words, i + 1, F.greatest(F.size(words) - size + 1, F.lit(0))) for i in range(size)]
    return F.transform(
        F.arrays_zip(*(s.alias(f"w{i}") for i, s in enumerate(shifted))),
        lambda run: F.xxhash64(*(run[f"w{i}"] for i in range(size))),
    )


def windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """item_id, body (the words of one window, joined by spaces), k (its words), s (words of its
    shingles) and shingles, one hash per place in the window."""
    size = F.size("words")
    k = F.least(size, F.lit(window))
    each = with_words(items, "item_id").where(size > 0).select(
        "item_id", k.alias("k"), F.least(k, F.lit(shingle)).alias("s"),
        F.explode(F.transform(
            F.sequence(F.lit(1), size - k + 1), lambda i: F.slice("words", i, k)
        )).alias("words"),
    )
    hashes = F.when(F.lit(False), F.array().cast("array<bigint>"))
    for n in range(1, shingle + 1):
        hashes = hashes.when(F.col("s") == n, shingles(F.col("words"), n))
    return each.select("item_id", F.array_join("words", " ").alias("body"), "k", "s",
                       hashes.alias("shingles")).distinct()


def candidates(docs: DataFrame, bodies: DataFrame, sizes: list[int], stages: Stages) -> DataFrame:
    """digest, start (from 0), k: where a window of ``bodies`` (body, k, s, shingles) may occur."""
    places = bodies.select("body", "k", "s", F.posexplode("shingles").alias("offset", "hash"))
    wanted = stages.put("wanted", places.select("s", "hash").distinct())
    words, found = with_words(docs, "digest"), None
    for s in sizes:
        each = words.select("digest", F.size("words").alias("n"),
                            F.posexplode(shingles(F.col("words"), s)).alias("place", "hash"))
        each = each.join(wanted.where(F.col("s") == s), "hash")
        found = each if found is None else found.unionByName(each)
    # Copies of a document count once: a place is known by the digest of the text.
    found = stages.put("found", found.groupBy("s", "hash", "digest", "place").agg(F.min("n").alias("n")))
    counts = found.groupBy("s", "hash").agg(F.count("*").alias("count"))
    rarity = places.join(stages.put("counts", counts), ["s", "hash"], "left")
    prefix = (
        rarity.groupBy("body", "k", "s").agg(
            F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "hash", "offset")).alias("rarest")
        )
        .where("rarest.count > 0")
        .select("k", "s", "rarest.hash", "rarest.offset").distinct()
    )
    start = F.col("place") - F.col("offset")
    return (
        found.join(stages.put("prefix", prefix), ["s", "hash"])
        .where((start >= 0) & (start + F.col("k") <= F.col("n")))
        .select("digest", start.alias("start"), "k").distinct()
    )


def covered(spans: Column) -> Column:
    """How many words the spans (start, k) cover together."""
    last = F.aggregate(
        F.array_sort(spans), F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum")),
        lambda done, span: F.struct(
            F.greatest(done["end"], span["start"] + span["k"]).alias("end"),
            (done["sum"] + F.greatest(
                F.lit(0), span["start"] + span["k"] - F.greatest(done["end"], span["start"])
            )).alias("sum"),
        ),
    )
    return last["sum"]


def contamination(docs: DataFrame, items: DataFrame, stages: Stages, window: int = 10,
                  shingle: int = 3) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (their ids as sorted strings).

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. A word inside any occurrence of a window is hit. Texts are read whole; a null or empty one
    has no words and no hits. Equal texts are searched once and each document has its row. Rows of one
    item_id are one item, all of their windows counting; an item without item_id hits words but is
    neither counted nor listed. Without items, or without documents, nothing is hit. Other columns are
    not read.
    """
    held = stages.put("windows", windows(items.select("item_id", "text"), window, shingle))
    bodies = held.drop("item_id").distinct()
    sizes = sorted(r.s for r in held.select("s").distinct().collect())  # 1 to ``shingle``
    texts = docs.select("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), "text")
    known = stages.put("texts", with_words(texts, "doc_id", "digest").select(
        "doc_id", "digest", F.size("words").cast("long").alias("n_words")))
    if not sizes:
        return known.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                            F.lit(0).cast("long").alias("n_items"),
                            F.array().cast("array<string>").alias("items"))

    found = stages.put("candidates", candidates(texts, bodies, sizes, stages))
    starts = found.groupBy("digest").agg(F.collect_list(F.struct("start", "k")).alias("starts"))
    once = stages.put("starts", starts)
    # Of texts without a candidate hardly any is shuffled, and of equal texts one for each task.
    some = sifted(texts, "digest", stages.put("sieve", sieve(once, "digest")))
    some = some.groupBy("digest").agg(F.any_value("text").alias("text")).join(once, "digest")
    spans = with_words(some, "digest", "starts").select(
        "digest",
        F.explode(F.transform("starts", lambda at: F.struct(
            at["start"].alias("start"), at["k"].alias("k"),
            F.array_join(F.slice("words", at["start"] + 1, at["k"]), " ").alias("body"),
        ))).alias("span"),
    )
    same = stages.put("hits", spans.select("digest", "span.*").join(bodies, ["body", "k"])
                      .select("digest", "start", "k", "body"))
    hits = same.groupBy("digest").agg(covered(F.collect_set(F.struct("start", "k"))).alias("n_hit"))
    named = (
        same.select("digest", "body").distinct()
        .join(held.where("item_id is not null").select("body", F.col("item_id").cast("string").alias("item")), "body")
        .groupBy("digest").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    report = stages.put("report", hits.join(named, "digest", "left"))
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return known.join(report, "digest", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"), items_.alias("items"),
    )


def contamination_report(docs: DataFrame, items: DataFrame, stages: Stages) -> DataFrame:
    """:func:`contamination` with the digest of the items' ids and whether any word is hit."""
    return contamination(docs, items, stages).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
