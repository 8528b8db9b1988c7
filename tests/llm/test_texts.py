"""BPE, page extraction, language identification, quality rules and mixing."""

import base64
import hashlib
import json
import random
import re
from collections import Counter
from math import log2

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm import bpe, langid, mixing, quality
from shelfwise.llm.common import map_rows
from shelfwise.llm.html import extract_pages, main_text
from shelfwise.llm.queries import RANKS
from tests.llm.texts import corpus

PATTERN = public_tokenizers.PATTERN
RECORDS = [{"doc_id": 3}, {"text": 1}]


# --- byte-level BPE


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(4)
    return [
        None, "", " ", "\n\n  \t x", "<|endoftext|>", "don't WE'LL 12345 ½ ñandú", "日本語のテキスト 🎉🎉",
        "a" * 3000, "ab" * 2000, "\x00\x01​ ", "".join(rng.choice("abcde") for _ in range(4000)),
        "".join(chr(rng.choice([*range(32, 127), *range(0x400, 0x4FF), *range(0x4E00, 0x4F00)])) for _ in range(2000)),
        json.dumps(RECORDS, indent=4),
    ]


def test_bpe_equals_reference_and_goes_back(documents, rows, reference):
    data = list(enumerate(odd_texts())) + corpus(1, 10)
    made = rows(bpe.bpe_digests(documents(data, ids=F.lit(1)), RANKS, PATTERN, block_chars=700))
    want = []
    for k, t in data:
        ids = reference.encode_ordinary(t or "")
        digests = (" ".join(map(str, ids)).encode(), (t or "").encode())
        want.append((k, len(ids), *(hashlib.sha256(d).hexdigest() for d in digests)))
    assert made == sorted(want, key=repr)


def test_bpe_columns(documents, rows, reference):
    docs = documents(list(enumerate(odd_texts())), token_ids=F.lit("taken"), _read_0=F.lit(1))
    made = bpe.bpe_ids(docs, RANKS, PATTERN)
    got = {r.doc_id: r for r in made.collect()}
    for k, t in enumerate(odd_texts()):
        assert got[k].token_ids == reference.encode_ordinary(t or "")
        assert bytes(got[k].decoded) == (t or "").encode() and got[k]._read_0 == 1
    assert rows(bpe.bpe_ids(documents([]), RANKS, PATTERN)) == []


def test_bpe_ids_holds_one_block_at_a_time(documents, reference):
    """A block of texts is encoded and sent on before the next; a column that is kept is sent once."""
    data = list(enumerate(odd_texts()))
    sizes = lambda columns: [[sum(len((t or "").encode()) for t in columns[0])] * len(columns[0])]
    held = map_rows(documents(data).coalesce(1), sizes, ["doc_id", "text"], ["text"], "held long", most=700)
    longest = {r.doc_id: len((r.text or "").encode()) for r in held.collect()}
    assert all(r.held <= max(700, longest[r.doc_id]) for r in held.collect()) and len(longest) == len(data)
    made = bpe.bpe_ids(documents(data), RANKS, PATTERN, block_chars=700)
    assert {r.doc_id: r.token_ids for r in made.collect()} == {
        k: reference.encode_ordinary(t or "") for k, t in data
    }
    assert "_read" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_merge_that_makes_a_lower_rank(tmp_path):
    """Merging b+c makes a pair (a, bc) of lower rank, which goes before the next b+c."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"bcb"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    ranks = {t: i for i, t in enumerate(tokens)}
    own = tiktoken.Encoding("x", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    merges = bpe.Merges(str(path))
    rng = random.Random(2)
    pieces = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 12))) for _ in range(300)]
    assert merges.replay([p.encode() for p in pieces]) == [own.encode_ordinary(p) for p in pieces]


# --- pages


LONG = "The house of the man was by the sea and it is said that he was in it for a year. " * 3


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("no markup at all", ""), ("<p>", ""), ("<!-- x", ""), ("<script>var a = '<p>b</p>'", ""),
    (f"<article><p>{LONG}<br>\n and   more</article>", f"{LONG.strip()} and more"),
    (f"<nav><a href=x>Home</a></nav><main><h1>Title</h1><p>{LONG}<p>Short.</main><footer>{LONG}</footer>",
     f"Title\n{LONG.strip()}\nShort."),
    (f"<div>{LONG}</div><div>Short one.</div><div>{LONG}</div><div>Last</div>",
     f"{LONG.strip()}\nShort one.\n{LONG.strip()}\nLast"),
    (f"<div class='cookie-notice'>{LONG}</div><p>{LONG}</p><div id=comments><p>{LONG}</p></div>", LONG.strip()),
    (f"<article><p>caf&eacute; &amp; &#x41; &lt;b&gt;</p><div class='share'>{LONG}</div></article>", "café & A <b>"),
    (f"<article><header><h1>In</h1></header><p>{LONG}</p></article><header>{LONG}</header>", f"In\n{LONG.strip()}"),
    ("<article><p>tiny</p></article><p>tiny</p>", "tiny"),
    (f"<article><p>{LONG}</p><ul><li><a href=1>{LONG}</a></ul></article>", LONG.strip()),
    (f"<article title=\"a>b\" data='<p>'><p>1 < 2 and {LONG}</p></article>", f"1 < 2 and {LONG.strip()}"),
    (f"<form><p>{LONG}</p></form><aside>{LONG}</aside><select><option>{LONG}</select>", ""),
    (f"<article><div class=heading-adventure><p>{LONG}</p></div></article>", LONG.strip()),
])
def test_main_text(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("inside", [
    "<table><tr>" + "<td>x" * 90, "<table>" + "<tr><td>x" * 90, "<dl>" + "<dt>x<dd>y" * 90, "<b><i>x" * 90,
    "<table><tr><td><table><tr><td>x" * 90,
])
@pytest.mark.parametrize("tag", ["nav", "aside", "footer"])
def test_closing_tag_at_any_depth(tag, inside):
    html = f"<{tag}>{inside}</{tag}><article><p>{LONG}</p></article>"
    assert main_text(html) == LONG.strip()


def test_cells_end_cells_of_their_own_table():
    html = f"<table><tr><td class=ads>x<td>{LONG}<tr><td id=menu><table><tr><td>x<td>y</table>{LONG}<td>{LONG}</table>"
    assert main_text(html) == f"{LONG.strip()}\n{LONG.strip()}"


CZECH = "Starý dům stál na kraji města a každý večer svítila okna do tmavé zahrady plné jabloní. " * 3


@pytest.mark.parametrize("html, text", [
    *((f"<div class='{c}'><article><h1>Title</h1><p>{LONG}</p></article></div>", f"Title\n{LONG.strip()}")
      for c in ("content has-sidebar", "layout-with-nav", "no-comments", "post-share-enabled", "widget")),
    (f"<div class='content has-sidebar'><h1>Title</h1><p>{LONG}</p></div><div class=site-footer>Imprint</div>",
     f"Title\n{LONG.strip()}"),
    (f"<form id=aspnet><nav>{LONG}</nav><article><p>{LONG}</p></article></form>", LONG.strip()),
    (f"<form><div>Search</div><h1>Title</h1><p>{LONG}</p></form>", f"Title\n{LONG.strip()}"),
    (f"<article><p>{LONG}</p></article><div class=comments><article class=comment><p>{LONG}</p></article></div>", LONG.strip()),
    (f"<nav><a href=x>Domů</a></nav><div><p>{CZECH}</p></div><footer>{CZECH}</footer>", CZECH.strip()),
])
def test_main_text_in_wrappers_and_other_languages(html, text):
    assert main_text(html) == text


RUSSIAN = "Старый дом стоял на краю города, и каждый вечер в нём горели окна допоздна."
CHINESE = "老房子坐落在城边每天晚上窗户里的灯光照进黑暗的花园里种满了苹果树孩子们在那里玩耍直到深夜" * 5


@pytest.mark.parametrize("beside", [
    "<svg class=logo />", "<svg viewBox='0 0 1 1'/>", "<title-bar>Shop</title-bar>",
    "<video-player src=x></video-player>", "<svg-icon name=a></svg-icon>", "<object-x></object-x>",
    "<svg><title>Logo</title><path d='M0>1'/></svg>", "<script src='a>b'>var x = '<p>';</script>",
    "<div class=cookie-bar>We use cookies and it is fine.</div>", "<div class=right-sidebar>See also.</div>",
    f"<div class='right-sidebar'><p>{LONG}</p></div>", f"<form class=signup><p>{LONG}</p></form>",
])
def test_elements_beside_the_article(beside):
    page = f"<body>{beside}<article><h1>Title</h1><p>{LONG}</p></article>{beside}</body>"
    assert main_text(page).removeprefix("Shop\n").removesuffix("\nShop") == f"Title\n{LONG.strip()}"


@pytest.mark.parametrize("inside", [
    f"<section id=reader-comments><p>{LONG}</p><p>{LONG}</p></section>",
    f"<div class=comment-list><div><p>{LONG}</p></div></div>", f"<div class='user-comments-list'><p>{LONG}</p></div>",
    f"<div class='ad-slot'><p>{LONG}</p></div>", f"<div id=newsletter-box><p>{LONG}</p></div>",
    f"<form><h1>Write to us</h1><p>{LONG}</p><p>{LONG}</p></form>",
])
def test_elements_inside_the_article_that_are_not_its_text(inside):
    assert main_text(f"<article><h1>Title</h1><p>{LONG}</p>{inside}<p>{LONG}</p></article>") == (
        f"Title\n{LONG.strip()}\n{LONG.strip()}")


@pytest.mark.parametrize("html, text", [
    (f"<article><p>{LONG}</p><p>It follows that <math><mi>x</mi></math> is <label>so</label>.</p></article>",
     f"{LONG.strip()}\nIt follows that x is so."),
    (f"<div class=widget><h1>Title</h1><p>{LONG}</p></div>", f"Title\n{LONG.strip()}"),
    (f"<form id=aspnet><div><p>{LONG}</p><p>{LONG}</p></div></form>", f"{LONG.strip()}\n{LONG.strip()}"),
    (f"<div>{CHINESE}</div>", CHINESE),
    ("<nav><a href=x>Домой</a></nav><div>" + f"<p>{RUSSIAN}</p>" * 6 + "</div>", "\n".join([RUSSIAN] * 6)),
    (f"<div class='post no-comments'><p>{LONG}</p></div><div class=comments><p>Nice.</p></div>", LONG.strip()),
])
def test_text_is_not_lost(html, text):
    assert main_text(f"<html><head><title>T</title></head><body>{html}</body></html>") == text


def test_pages(spark, rows):
    shape = "page_id long, url string, html string, text string"
    data = [(1, "u", f"<article><p>{LONG}</p></article>", "own"), (2, None, None, None), (None, "v", "<p>", ""),
            (1, "u", f"<article><p>{LONG}</p></article>", "own"), (3, "w", "<article>" + f"<p>{LONG}</p>" * 500, "")]
    made = rows(extract_pages(spark.createDataFrame(data, shape)))
    long = "\n".join([LONG.strip()] * 500)
    one = (1, "u", LONG.strip(), len(LONG.strip()))
    assert made == sorted([one, one, (2, None, "", 0), (None, "v", "", 0), (3, "w", long, len(long))], key=repr)
    assert rows(extract_pages(spark.createDataFrame([], shape))) == []


# --- language identification

LETTERS = {"xa": "abcdefgh", "xb": "ijklmnop", "xc": "aeioubcd", "xd": "qrstuvwx", "xe": "öäüßéabc",
           "xf": "klmnopqr", "xg": "ghijklmn"}


def spoken(rng, lang, words=40):
    word = lambda: "".join(rng.choice(LETTERS[lang]) for _ in range(rng.randrange(2, 6)))
    return " ".join(word() for _ in range(words))


@pytest.mark.parametrize("langs", [1, 4, 7])
def test_language_of_held_out_texts(documents, langs):
    rng = random.Random(langs)
    names = sorted(LETTERS)[:langs]
    truth = {k: names[k % langs] for k in range(langs * 50)}
    data = [(k, spoken(rng, lang), lang) for k, lang in truth.items()]
    data += [(9001, None, "xa"), (9002, "", "xa"), (9003, "12 !?", "xa"), (9004, spoken(rng, "xa"), None)]
    made = {r.doc_id: r for r in langid.identify(documents(data, bin=F.lit(1))).collect()}
    assert all(made[k].lang_pred == "und" and made[k].score == 0 for k in (9001, 9002, 9003))
    held = [k for k in truth if made[k].held_out]
    assert 0.1 < len(held) / len(truth) < 0.35
    assert sum(made[k].lang_pred == truth[k] for k in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in made.values()) and made[9004].lang_pred == "xa"


def test_language_labels_are_not_inputs(documents, rows):
    rng = random.Random(3)
    data = [(k, spoken(rng, "xb" if k % 2 else "xa"), "xb" if k % 2 else "xa", "s") for k in range(80)]
    plain = rows(langid.identify(documents(data)))
    held = {r[0] for r in plain if r[1]}
    changed = [(k, t, "zz" if k in held else lang, f"s{k}") for k, t, lang, _ in data]
    assert rows(langid.identify(documents(changed))) == plain


def test_language_without_anything_to_learn_from(documents, rows):
    assert rows(langid.identify(documents([]))) == []
    assert {r[2] for r in rows(langid.identify(documents([(1, "some text"), (None, "more")])))} == {"und"}


def test_codewords_differ():
    for n in (2, 3, 5, 6, 9, 40):
        code = langid.codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= max(1, code.shape[1] // 4)


# --- quality rules


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def plain_model(texts, order=4):
    """A modified Kneser-Ney model of bytes, by dictionaries and recursion."""
    counts = {order: Counter()}
    for t in texts:
        words = (t or "").encode().split()
        if words:
            b = (b" " + b" ".join(words) + b" ").rjust(order)
            counts[order].update(b[i : i + order] for i in range(len(b) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cuts = {}
    for n, seen in counts.items():
        times = Counter(seen.values())
        n1, n2 = times[1], times[2]
        cuts[n] = [0.0] + [
            min(max(i - (i + 1) * n1 / (n1 + 2 * n2) * times[i + 1] / times[i], 0.05), i - 0.05)
            if n1 and n2 and times[i] else 0.75 for i in (1, 2, 3)
        ]
    contexts = {n: {} for n in counts}
    for n, seen in counts.items():
        for g, c in seen.items():
            total, cut = contexts[n].get(g[:-1], (0, 0))
            contexts[n][g[:-1]] = (total + c, cut + cuts[n][min(c, 3)])

    def p(g):
        n = len(g)
        if not n:
            return 1 / 256
        total, cut = contexts[n].get(g[:-1], (0, 0))
        if not total:
            return p(g[1:])
        c = counts[n][g]
        return (c - cuts[n][min(c, 3)]) / total + cut / total * p(g[1:])

    def bits(t):
        words = (t or "").encode().split()
        if not words:
            return None
        b = (b" " + b" ".join(words) + b" ").rjust(order)
        grams = [b[i : i + order] for i in range(len(b) - order + 1)]
        return -sum(log2(p(g)) for g in grams) / len(grams)

    return bits


def test_quality_counts_and_perplexity(documents, stages):
    data = [(k, t, "xx" if (k or 0) % 3 else None) for k, t in corpus(6, 20)]
    data += [(501, "a#*$ b|c\n\nx y\nx y\n x y\n% & < >", "xx"), (502, "w " * 60, "xx"), (503, "same same same same", "yy")]
    made = quality.quality(documents(data, gram=F.lit(1), n=F.lit("x"), kept=F.lit(7)), stages).collect()
    models = {lang: plain_model([t for _, t, x in data if x == lang]) for lang in ("xx", None, "yy")}
    want = sorted((k, *plain_base(t), models[x](t)) for k, t, x in data if k is not None)
    got = sorted((r[0], *r[1:6], r.bits_per_byte) for r in made if r.doc_id is not None)
    assert [r[:6] for r in got] == [r[:6] for r in want] and len(made) == len(data)
    for (*_, a), (*_, b) in zip(got, want):
        assert (a is None) == (b is None) and (a is None or abs(a - b) < 0.02)
    for r in made:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_bands(documents, stages, rows):
    rng = random.Random(9)
    data = [(k, spoken(rng, "xa", 120), "xx") for k in range(60)]
    noise = " ".join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(5)) for _ in range(80))
    docs = documents(data + [(100, noise, "xx"), (101, None, "xx"), (102, "too short", "xx")], row=F.lit(1))
    kept = quality.quality_documents(docs, stages)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted(((k,) for k in range(60)), key=repr)
    assert rows(quality.quality(documents([]), stages)) == []


def test_quality_bands_reject_frequent_junk(documents, stages):
    """Shouting, symbols after words and tables, each in one text of twenty, of the same words."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    prose = lambda: [rng.choice(words) for _ in range(150)]
    data = [(k, " ".join(prose()), "xx") for k in range(170)]
    for k in range(10):
        data.append((200 + k, " ".join(f"{w.upper()}!!" for w in prose()), "xx"))
        data.append((220 + k, " ".join(w + rng.choice(["%%%", "###", "&&&"]) for w in prose()), "xx"))
        table = prose()
        table[2::3] = ["|"] * 50
        data.append((240 + k, " ".join(table), "xx"))
    made = quality.quality(documents(data), stages).collect()
    assert not any(r.base_failed for r in made)
    assert {r.doc_id for r in made if r.kept} == set(range(170))


def test_hash_arrays_are_sorted_and_bounded(documents, stages):
    counts = quality.gram_counts(documents(corpus(2, 10)), "lang", "text")
    hashes, values = quality.hash_arrays(quality.kneser_ney(counts))
    assert (np.diff(hashes.astype(np.int64)) > 0).all() and hashes.max() < 1 << quality.HASH_BITS
    assert ((values > 0) & (values <= 1.0001)).all()


def test_repeated_words_against_counting():
    rng = random.Random(5)
    texts = [[rng.choice([b"a", b"b", b"c", b"dd"]) for _ in range(rng.randrange(0, 40))] for _ in range(300)]
    many = [b"%d" % i for i in range(2_200_000)]  # three of their numbers do not fit in 64 bits
    for words in [*texts, many + many[7:11]]:
        windows = list(zip(words, words[1:], words[2:]))
        times = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
        assert quality.repeat_words(words) == len(covered)


def test_slots_are_found_by_their_upper_bits():
    """Any number of hashes, spread or close together, and slots before, among and after them."""
    rng = np.random.default_rng(3)
    for n, top in [(0, 9), (1, 1 << 32), (2, 3), (7, 1 << 32), (500, 600), (5000, 1 << 32)]:
        hashes = np.unique(rng.integers(0, top, n, np.uint32))
        slots = np.concatenate([hashes, rng.integers(0, top, 300, np.uint32), np.array([0, 2**32 - 1], np.uint32)])
        at, found = quality.Scorer(hashes, np.ones(len(hashes))).places(slots)
        assert found.tolist() == np.isin(slots, hashes).tolist()
        assert (hashes[at[found]] == slots[found]).all()


@pytest.mark.parametrize("held", [0, 40, 1 << 20])
def test_quality_is_exact_whatever_is_held(documents, stages, monkeypatch, held):
    """Against the plain model: n-grams that tasks do not hold are joined."""
    monkeypatch.setattr(quality, "HEAD_GRAMS", held)
    data = [(k, t, "xx" if k % 3 else None) for k, (_, t) in enumerate(corpus(6, 20))]
    made = {r.doc_id: r.bits_per_byte for r in quality.quality(documents(data), stages).collect()}
    models = {lang: plain_model([t for _, t, x in data if x == lang]) for lang in ("xx", None)}
    for k, t, x in data:
        want = models[x](t)
        assert (made[k] is None) == (want is None) and (want is None or abs(made[k] - want) < 1e-9)


def test_entries_whose_hashes_meet_are_not_held(documents):
    counts = quality.gram_counts(documents(corpus(2, 10)), "lang", "text")
    entries = quality.kneser_ney(counts).where("kind = 4")
    hashes, values = quality.hash_arrays(entries.unionByName(entries.where("value > 0.5")))
    assert len(hashes) == entries.where("value <= 0.5").count() and (values <= 0.5).all()


def test_no_plan_joins_all_orders_of_a_model(documents, stages):
    """Each plan of the driver has the tables of one order, and the values are those of one plan."""
    counts = stages.put("counts", quality.gram_counts(documents(corpus(2, 10)), "lang", "text"))
    part = stages.put("part", quality.gram_counts(documents(corpus(2, 10)[:5]), "lang", "text"))
    entries = quality.kneser_ney(part, stages)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for kind in range(1, 2 * quality.ORDER + 1):
        one = plan(entries.where(F.col("kind") == kind))
        assert one.count("Relation") == 1 and "Join" not in one and "Union" not in one
    made = quality.chances(counts, entries, stages)
    assert "Join" not in plan(made)
    want = {tuple(r)[:3]: r.value for r in quality.chances(counts, quality.kneser_ney(part)).collect()}
    got = {tuple(r)[:3]: r.value for r in made.collect()}
    assert got.keys() == want.keys() and len(got) == counts.count()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


# --- mixing


def test_target_sizes():
    assert mixing.target_sizes([100, 100, 100], [1, 2, 3]) == pytest.approx([50, 100, 150])
    assert mixing.target_sizes([10, 100, 100], [6, 1, 1]) == pytest.approx([30, 90, 90])
    assert mixing.target_sizes([0, 10], [1, 2]) == pytest.approx([0, 10])
    assert mixing.target_sizes([], []) == []


def nearest(sizes, counts, budget, copies):
    """How far the nearest sum of documents, each taken up to ``copies`` times, is from the budget."""
    sums = {0}
    for size, n in zip(sizes, counts):
        sums = {x + size * k for x in sums for k in range(n * copies + 1)}
    return min(abs(x - budget) for x in sums)


@pytest.mark.parametrize("scale", [1, 100])
def test_budget_is_met_as_nearly_as_documents_allow(scale):
    rng = random.Random(scale)
    for _ in range(400):
        sizes = [scale * x for x in rng.sample(range(1, 500), rng.randrange(1, 6))]
        counts, copies = [rng.randrange(1, 5) for _ in sizes], rng.choice([1, 2, 3])
        budget = rng.randrange(0, sum(map(int.__mul__, sizes, counts)) + 1)
        taken = mixing.fit_budget(np.array([*sizes, 0]), np.array([*counts, 3]), budget, copies)
        assert all(0 <= k <= n * copies for k, n in zip(taken, [*counts, 0]))
        words = int((taken[:-1] * sizes).sum())
        assert abs(words - budget) == nearest(sizes, counts, budget, copies)


def test_budgets_of_large_documents():
    fit = lambda sizes, counts, budget, copies=1: int(
        (mixing.fit_budget(np.array(sizes), np.array(counts), budget, copies) * sizes).sum())
    assert fit([70_000, 40_000], [1, 2], 80_000) == 80_000
    assert fit([400_000, 300_000, 100], [1, 2, 5], 600_000) == 600_000
    assert fit([810_000], [1], 640_000, 3) == 810_000  # nearer than nothing
    assert fit([1000, 999], [1_000_000, 1], 300_500) == 300_999
    rng = np.random.default_rng(3)
    sizes = np.unique(rng.lognormal(6, 1.5, 30_000).astype(np.int64))[1:]
    counts = rng.integers(1, 300, len(sizes))
    for share in (0.001, 0.3, 0.97):
        budget = int((sizes * counts).sum() * share)
        assert budget > 65_536 and fit(sizes, counts, budget) == budget


def test_mix_of_sources_with_one_document(documents, stages):
    data = [(1, "w " * 150, "x", "a"), (2, "w " * 810, "x", "b"), (3, "w " * 40, "x", "c"), (4, "w " * 9, "x", "c")]
    made = {r.doc_id: r for r in mixing.mix(documents(data), stages).collect()}
    for group in ([1], [2], [3, 4]):
        target = made[group[0]].target
        taken = sum(made[k].taken for k in group)
        sizes = [made[k]["size"] for k in group]
        assert abs(taken - target) == pytest.approx(nearest(sizes, [1] * len(sizes), target, 3))


def test_mix(documents, stages, rows):
    rng = random.Random(2)
    data = [(k, " ".join(["w"] * rng.choice([1, 2, 3, 5, 8, 40])), "xx", rng.choice(["b", "a", None, "é"]))
            for k in range(400)]
    data += [(900, None, "xx", "a"), (901, "", None, "zz"), (902, " one  two ", None, "tiny"), data[7], data[7],
             (None, "q r s", "xx", None)]
    docs = documents(data, size=F.lit(1), copies=F.lit("x"), origin=F.lit(2))
    made = mixing.mix(docs, stages).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id or -1, r["size"]) for r in made) == sorted((k or -1, size(t)) for k, t, *_ in data)
    source = {k: s for k, _, _, s in data}
    names = sorted({s for s in source.values() if s}) + [None]
    sizes = [sum(size(t) for _, t, _, s in data if s == n) for n in names]
    targets = dict(zip(names, mixing.target_sizes(sizes, [(1, 2, 3)[i % 3] for i in range(len(names))])))
    taken = Counter()
    for r in made:
        s = source[r.doc_id]
        assert r.source_size == sizes[names.index(s)] and r.target == pytest.approx(targets[s])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        taken[s] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 1 or abs(taken[s] - target) <= 40 and sizes[names.index(s)] < 50
    again = mixing.mix(documents(list(reversed(data))), stages)
    assert rows(again) == sorted((tuple(r) for r in made), key=repr)
    out = mixing.mixed_documents(docs, stages)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == +sum((Counter({r.doc_id: r.copies}) for r in made), Counter())


def test_mix_empty_table(documents, stages, rows):
    assert rows(mixing.mix(documents([]), stages)) == []
    assert rows(mixing.mixed_documents(documents([]), stages)) == []
