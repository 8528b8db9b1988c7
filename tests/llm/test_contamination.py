"""Benchmark decontamination against sets of windows."""

import random
import re
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import contamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, window=10):
    held = defaultdict(set)
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for at in range(len(w) - k + 1 if k else 0):
            held[tuple(w[at : at + k])].add(item)
    sizes, out = {len(x) for x in held}, []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for at in range(len(w) - k + 1):
                if (same := held.get(tuple(w[at : at + k]))) is not None:
                    hit |= set(range(at, at + k))
                    found |= same
        names = sorted(str(i) for i in found if i is not None)
        digest = sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def fixture(seed):
    rng = random.Random(seed)
    letters = ["a", "the", "Of", "x9", "ö", "Ñu", "b-c"]

    def text(n):
        return " ".join(rng.choice(letters) + rng.choice(["", " ", ". ", "\n"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 3, 5, 9, 10, 11, 14, 25]))) for i in range(8)]
    items = [] if seed == 0 else items + [(2, text(12)), (None, text(4)), (77, None), (78, ""), (79, "...")]
    items += items[:1]
    docs = [(i, text(rng.choice([0, 1, 3, 12, 40, 900]))) for i in range(40)]
    docs += [(100 + i, f"{docs[3][1]} {t}") for i, (_, t) in enumerate(items) if t] + docs[:5]
    docs += [(None, docs[1][1]), (500, None), (501, "")] + [(600 + i, docs[7][1]) for i in range(20)]
    return docs, items


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_hits_equal_brute_force(spark, documents, stages, rows, seed):
    docs, items = fixture(seed)
    more = dict.fromkeys(("digest", "words", "item_id", "body", "n_hit", "k"), F.lit(1))
    made = contamination.contamination_report(
        documents(docs, **more), spark.createDataFrame(items, ITEM).withColumn("body", F.lit(1)), stages
    )
    assert rows(made) == expected(docs, items)


def test_items_of_common_words_only(spark, documents, stages, rows):
    """Every shingle of the items is common; windows overlap, touch the ends and repeat."""
    docs = [(i, "a b " * (8 + i % 5) + "c " * (i % 3)) for i in range(60)]
    items = [(1, "a b a b a b a b a b"), (2, "b a b a b a b a b a c"), (3, "c c"), (4, "a b a b a b a b a b")]
    made = contamination.contamination_report(documents(docs), spark.createDataFrame(items, ITEM), stages)
    assert rows(made) == expected(docs, items)


def test_empty_tables(spark, documents, stages, rows):
    items = spark.createDataFrame([(1, "one two")], ITEM)
    assert contamination.contamination_report(documents([]).limit(0), items, stages).collect() == []
    none = contamination.contamination_report(documents([(1, "One two")]), items.limit(0), stages)
    assert rows(none) == expected([(1, "One two")], [])


def test_all_documents(spark, rows):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text")
    want = expected(*([tuple(r) for r in t.collect()] for t in (docs, items)))
    assert rows(queries.op12_decontamination(spark, sf)) == want and any(r[-1] for r in want)


def test_runs_no_python(spark, documents, stages, monkeypatch):
    """Neither the result nor any table on the way to it."""
    plans, put = [], type(stages).put

    def seen(self, name, df):
        plans.append(df._jdf.queryExecution().toString())
        return put(self, name, df)

    monkeypatch.setattr(type(stages), "put", seen)
    items = spark.createDataFrame([(1, "one two three")], ITEM)
    # Test rows themselves come from Python: store them first.
    docs, items = put(stages, "docs", documents([(1, "One two three four")])), put(stages, "items", items)
    made = contamination.contamination_report(docs, items, stages)
    plans.append(made._jdf.queryExecution().toString())
    assert len(plans) > 8 and not re.search("Python|Pandas|Arrow|ExternalRDD", "".join(plans))


def test_a_text_is_split_once(spark, documents, stages):
    plan = contamination.with_words(documents([(1, "a b")]), "doc_id").select(
        F.posexplode(contamination.shingles(F.col("words"), 3)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1
