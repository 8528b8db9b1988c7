"""Near-duplicate documents, lines and vectors, against comparing all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import covertree, lines, minhash
from shelfwise.llm.components import components
from shelfwise.llm.covertree import near_vectors
from tests.llm.texts import corpus, sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots_of(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def smallest(keys, roots):
    out = {}
    for k, r in zip(keys, roots):
        if k is not None:
            out[r] = min(out.get(r, k), k)
    return [out.get(r) for r in roots]


def test_components(spark, stages, rows):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)]
    pairs += [(200 + rng.randrange(90), 200 + rng.randrange(90)) for _ in range(60)]
    roots = roots_of(300, pairs)
    used = {x for a, b in pairs if a != b for x in (a, b)}
    rng.shuffle(pairs)
    made = rows(components(spark.createDataFrame(pairs, "a long, b long"), stages, "x"))
    assert made == sorted(((i, roots[i]) for i in used if roots[i] != i), key=repr)
    none = spark.createDataFrame([], "a long, b long")
    assert rows(components(none, stages, "none")) == []


def shingle_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def near_expected(data, words, share):
    sets = [shingle_set(t, words) for _, t in data]
    links = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if a and b and 100 * len(a & b) >= share * len(a | b)
    ]
    least = smallest([k for k, _ in data], roots_of(len(data), links))
    out = [
        (k, len(s), c if s else k, k == (c if s else k)) for (k, _), s, c in zip(data, sets, least)
    ]
    return sorted(out, key=repr)


@pytest.mark.parametrize("words, share, block", [(3, 85, 512), (5, 80, 512), (3, 85, 3)])
def test_documents_equal_all_pairs(documents, stages, rows, monkeypatch, words, share, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(words)
    data = corpus(words, 30)
    base = sentence(rng, 150).split(" ")
    for i in range(40):  # a group of near copies, each changed at a place of its own
        w = list(base)
        for _ in range(rng.choice([1, 2, 4])):
            w[rng.randrange(len(w))] = f"new{i}"
        data.append((1000 + i, " ".join(w)))
    docs = documents(data, id=F.lit(1), signature=F.lit("x"), component_id=F.lit(0))
    made = minhash.near_duplicates(docs, stages, words=words, numerator=share)
    assert rows(made) == near_expected(data, words, share)


def test_one_document_of_each_group_stays(documents, stages, rows):
    data = corpus(8, 20)
    docs = documents(data, row=F.lit(1), body=F.lit("x"))
    kept = minhash.distinct_documents(docs, stages, words=5)
    assert kept.columns == docs.columns
    flags = near_expected(data, 5, 80)
    alone = [(k,) for k, n, _, _ in flags if not n]
    groups = {c for _, n, c, _ in flags if n}
    assert rows(kept, "doc_id") == sorted(alone + [(c,) for c in groups], key=repr)


def test_documents_empty_table(documents, stages, rows):
    assert rows(minhash.near_duplicates(documents([]), stages)) == []


# --- lines


def line_set(line):
    """Nine characters from each word's start, from each ideograph, from every place of a longer word
    that leaves nine in it, and the last nine of the line."""
    ideograph = "\u4e00-\u9fff\u3400-\u4dbf"
    starts = []
    for m in re.finditer(rf"[{ideograph}]|[^\s{ideograph}]+", line):
        starts += range(m.start(), max(m.start(), m.end() - 9) + 1)
    return frozenset([line[i : i + 9] for i in starts if i + 9 <= len(line)] + [line[-9:]])


def all_places(line):
    """Nine characters from every place."""
    return frozenset(line[i : i + 9] for i in range(max(1, len(line) - 8)))


def lines_expected(data):
    cut = [(k, i, x) for k, t in data if t is not None for i, x in enumerate(t.split("\n"))
           if re.search(r"[^\x20\x09-\x0D]", x)]
    order = lambda p: (p[0] is None, p[0] or 0, p[1])
    different = sorted({x for _, _, x in cut})
    at = {x: i for i, x in enumerate(different)}
    sets = [line_set(x) for x in different]
    links = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if 100 * len(a & b) >= 80 * len(a | b)
    ]
    roots, head = roots_of(len(different), links), {}
    for k, i, x in cut:
        r = roots[at[x]]
        head[r] = min(head.get(r, (k, i)), (k, i), key=order)
    return {(k, i) for k, i, x in cut if head[roots[at[x]]] != (k, i)}


def line_rows(seed):
    rng = random.Random(seed)
    pool = [sentence(rng, rng.choice([1, 2, 4, 9, 14, 30, 60])) for _ in range(25)]
    data = []
    for k in range(60):
        own = []
        for _ in range(rng.randrange(1, 6)):
            w = rng.choice(pool).split(" ")
            if rng.random() < 0.5:
                w[rng.randrange(len(w))] = f"other{k}"
            own.append(" ".join(w))
        data.append((k, "\n".join(own)))
    data += [(90, None), (91, ""), (92, "\n \n\t"), (93, "漢字を使う長い行です漢字を使う"), (94, "short"),
             (95, "a\r\nb c"), data[4], data[4]]
    return data + [(None, data[5][1]), (None, None)]


def test_lines_equal_all_pairs(documents, stages, rows):
    data = line_rows(2)
    gone = lines_expected(data)
    docs = documents(data, line=F.lit(1), at=F.lit("x"), key=F.lit(2))
    made = rows(lines.line_report(docs, stages))
    want = [
        (k, len(t.split("\n")) if t is not None else 0,
         len(mine := sorted(i for d, i in gone if d == k) if t is not None or k is None else []), mine)
        for k, t in data
    ]
    assert made == sorted(want, key=repr)


def test_lines_are_taken_out(documents, stages, rows):
    data = [(1, "the first line of all\nkeep this one here\n\nlast words"),
            (2, "something new to read\nthe first line of all"), (3, None), (4, "keep this one here")]
    docs = documents(data)
    made = lines.dedup_lines(docs, stages)
    assert made.columns == docs.columns
    assert rows(made, "doc_id", "text", "n_chars") == [
        (1, data[0][1], len(data[0][1])), (2, "something new to read", 21), (3, None, 0), (4, "", 0)
    ]


def test_lines_empty_table(documents, stages, rows):
    assert rows(lines.line_report(documents([]), stages)) == []


LONG_TOKENS = [
    "https://example.org/a/one/index.html", "https://example.org/zz/other/index.html",
    "https://example.org/a/one/index.html?page=1&sort=up&view=all&lang=en&more=2",
    "https://example.org/a/one/index.html?page=1&sort=up&view=all&lang=en&more=3",
    "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo=", "QUJDREVGR0hJmZzh1a2xqc2Rma2xqc2RVVldYWVo=",
    "ประเทศไทยมีอาหารอร่อยมากมายหลายชนิดให้เลือกรับประทานทุกวันและทุกฤดูกาล",
    "ประเทศไทยมีอาหารอร่อยมากมายหลายชนิดให้เลือกรับประทานทุกวันและทุกฤดูหนาว",
    "if(a[i]==b[j]){x+=1;y-=2;return(x*y)%modulus;}", "if(a[i]==b[k]){x+=7;y-=2;return(x+y)%modulus;}",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaab",
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789abcdefXYZ_tail",
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ 012345678_other_XYZ_tail",
]


def test_long_words_count_at_every_place(documents, stages, rows):
    """Lines of one or two long words, against shingles from every place of the line."""
    data = list(enumerate(LONG_TOKENS))
    want = {
        j for j, b in data for i, a in data[:j]
        if 100 * len(all_places(a) & all_places(b)) >= 80 * len(all_places(a) | all_places(b))
    }
    made = lines.line_report(documents(data), stages)
    assert {r.doc_id for r in made.collect() if r.n_removed} == want == {3, 7}
    # Of words that long the sets are those of every place, but for shingles across words.
    assert all(line_set(x) == all_places(x) for x in LONG_TOKENS[:11])


def test_linked_short_lines_share_a_key(spark):
    """All sizes up to 13 and all differences that links allow."""
    rng = random.Random(7)
    token = lambda n: [rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)]
    data = []
    for same in range(3, 14):
        for x in range(14 - same):
            for y in range(x, 14 - same):
                if x + y and 100 * same >= 80 * (same + x + y):
                    for _ in range(400):
                        shared = token(same)
                        data.append((len(data), f"{same} {x} {y}", shared + token(x), shared + token(y)))
    assert {"8 1 1", "9 1 1", "4 0 1", "8 0 2", "11 0 2"} <= {r[1] for r in data}
    pairs = spark.createDataFrame(data, "id long, kind string, a array<long>, b array<long>")
    keys = lambda c: lines.signatures(pairs.select("id", F.explode(c).alias("hash"))).select(
        "id", F.explode(lines.band_keys()).alias("band"))
    met = keys("a").join(keys("b"), ["id", "band"])
    assert pairs.join(met, "id", "left_anti").groupBy("kind").count().collect() == []


@pytest.mark.parametrize("size", [20, 31, 60, 300])
def test_linked_long_lines_share_a_key(spark, size):
    """At the threshold: none missed up to 31 shingles, few above."""
    rng, data = random.Random(size), []
    for i in range(2000):
        pool = rng.sample(range(-(1 << 60), 1 << 60), 2 * size)
        only = size // 9  # of each line: J just above 0.8
        shared = pool[: size - only]
        data.append((i, shared + pool[size : size + only], shared + pool[size + only : size + 2 * only]))
    pairs = spark.createDataFrame(data, "id long, a array<long>, b array<long>")
    keys = lambda c: lines.signatures(pairs.select("id", F.explode(c).alias("hash"))).select(
        "id", F.explode(lines.band_keys()).alias("band"))
    missed = pairs.join(keys("a").join(keys("b"), ["id", "band"]), "id", "left_anti").count()
    assert missed <= (0 if size <= 31 else 16)


def test_lines_are_shingled_where_they_meet(spark, documents, stages, monkeypatch):
    """One exchange by line before its shingles, none of shingles."""
    plans, put = {}, type(stages).put
    monkeypatch.setattr(type(stages), "put", lambda self, name, df: (
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()), put(self, name, df))[1])
    lines.line_report(documents([(1, "some line\nsome line")]), stages)
    assert plans["posted"].count("Exchange hashpartitioning") == 1
    assert not re.search("Python|Pandas|Arrow", "".join(p.split("ExistingRDD")[0] for p in plans.values()))


def test_sketches_pass_all_similar_lines(spark):
    """At the threshold, with repeated shingles; most of the others are told apart."""
    rng, data = random.Random(3), []
    for size in (4, 9, 18, 60, 300, 2000):
        for i in range(60):
            pool = rng.sample(range(-(1 << 60), 1 << 60), 3 * size)
            only, more = size // 9, rng.randrange(3)
            a, b = pool[:size], pool[only:size] + pool[size : size + only]
            data.append((len(data), size, True, a + a[:more], b + b[-1:] * more))
            data.append((len(data), size, False, a, pool[size : 2 * size]))
    pairs = spark.createDataFrame(data, "id long, size int, linked boolean, a array<long>, b array<long>")
    sketch = lambda c: lines.signatures(pairs.select("id", F.explode(c).alias("hash"))).select(
        "id", F.struct("pieces", *lines.SKETCH).alias(c))
    met = pairs.select("id", "size", "linked").join(sketch("a"), "id").join(sketch("b"), "id")
    passed = met.where(lines.may_be_similar("a", "b")).groupBy("linked", "size").count().collect()
    assert {r["size"]: r["count"] for r in passed if r.linked} == dict.fromkeys((4, 9, 18, 60, 300, 2000), 60)
    assert not [r for r in passed if not r.linked and r["size"] <= 300]


def test_only_lines_of_possible_links_are_shingled_again(documents, stages, monkeypatch):
    """Lines that share a band but differ in most shingles are neither read nor cut again."""
    read, put = {}, type(stages).put
    def spy(self, name, df):  # noqa: E306
        made = put(self, name, df)
        read[name] = (made.count(), df._jdf.queryExecution().optimizedPlan().toString())
        return made
    monkeypatch.setattr(type(stages), "put", spy)
    rng = random.Random(4)
    data = [(i, "lorem ipsum " * 20 + sentence(rng, 40)) for i in range(12)]
    data += [(50, data[0][1] + " end"), (51, "something else altogether, of its own")]
    made = lines.line_report(documents(data), stages)
    assert {r.doc_id for r in made.collect() if r.n_removed} == {50} == {k for k, _ in lines_expected(data)}
    assert read["band-members"][0] > 4 and read["first-lines"][0] + read["other-lines"][0] <= 4
    assert "regexp_extract_all" not in read["open-members"][1]


def test_lines_run_no_python(documents, stages, capsys):
    lines.line_report(documents([(1, "some line\nsome line")]), stages).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan)


# --- vectors


VECTOR = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()),
])


def vector_rows(seed, n=300):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 12))
    near = base[:60] + rng.normal(size=(60, 12)) * rng.choice([0.05, 0.12, 0.3], (60, 1))
    hub = rng.normal(size=12) + rng.normal(size=(80, 12)) * 0.15
    data = [x.astype(np.float32).tolist() for x in (*base, *near, *hub, *base[:9], *base[:4] * 3)]
    data += [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [None] + [1.0] * 11,
             [float("inf")] * 12, [1.0, 2.0], [2.0, 4.0], [1e-30] * 12]
    rows = [(i, x, None) for i, x in enumerate(data)]
    return rows + [rows[0], (None, data[1], 3), (None, None, None)]


def vectors_expected(data, cosine):
    unit = []
    for _, x, _ in data:
        x = np.array(x, float) if x and None not in x else np.zeros(0)
        ok = len(x) and np.isfinite(x).all() and np.abs(x).max() > 0
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    links = [
        (i, j) for i, a in enumerate(unit) for j, b in enumerate(unit[:i])
        if a is not None and b is not None and len(a) == len(b) and a @ b >= cosine
    ]
    n = [0] * len(data)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    keys = [r[0] for r in data]
    least = smallest(keys, roots_of(len(data), links))
    least = [k if u is None else c for k, u, c in zip(keys, unit, least)]
    return sorted(((k, m, c, k == c) for k, m, c in zip(keys, n, least)), key=repr)


@pytest.mark.parametrize("part, leaf", [(8192, 256), (40, 4)])
def test_vectors_equal_all_pairs(spark, stages, rows, monkeypatch, part, leaf):
    monkeypatch.setattr(covertree, "PART", part)
    monkeypatch.setattr(covertree, "LEAF", leaf)
    data = vector_rows(part)
    frame = spark.createDataFrame(data, VECTOR).repartition(3).withColumn("id", F.lit(1))
    assert rows(near_vectors(frame, stages, cosine=0.9)) == vectors_expected(data, 0.9)


def chains(seed, planes=15, length=14, step=0.4):
    """Vectors of which only neighbours on a circle are linked (cosine 0.92, then 0.70), shuffled."""
    rng = np.random.default_rng(seed)
    data = []
    for k in range(planes):
        for at in range(length):
            x = np.zeros(2 * planes)
            x[2 * k : 2 * k + 2] = np.cos(at * step), np.sin(at * step)
            data.append(x.tolist())
    return [(n, data[i], None) for n, i in enumerate(rng.permutation(len(data)))]


@pytest.mark.parametrize("part, leaf", [(8192, 1024), (8192, 8), (40, 1024), (40, 4)])
def test_chained_vectors_are_one_component(spark, stages, rows, monkeypatch, part, leaf):
    monkeypatch.setattr(covertree, "PART", part)
    monkeypatch.setattr(covertree, "LEAF", leaf)
    data = chains(part + leaf)
    assert len({r[2] for r in vectors_expected(data, 0.9)}) == 15
    frame = spark.createDataFrame(data, VECTOR).repartition(3)
    assert rows(near_vectors(frame, stages, cosine=0.9)) == vectors_expected(data, 0.9)


def test_spanning_links_join_what_all_links_do():
    rng = np.random.default_rng(5)
    for n in (2, 4, 10, 40):
        for _ in range(50):
            forest, links = covertree.Forest(n), rng.integers(0, n, (rng.integers(1, 2 * n), 2))
            for part in np.array_split(links, 3):
                forest.add(part[:, 0], part[:, 1])
            kept = forest.links()
            assert len(kept) < n and roots_of(n, kept.tolist()) == roots_of(n, links.tolist())


def test_vectors_empty_table(spark, stages, rows):
    assert rows(near_vectors(spark.createDataFrame([], VECTOR), stages)) == []
