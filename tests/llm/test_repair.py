"""Conversation repair against a plain dynamic programme over strings."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import audits, conversations, queries
from shelfwise.llm.audits import Audits

TURN = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """(cost, audit, repaired turns) of (role, text, gone, flaw) rows, all prefixes kept as strings."""
    cells = {"": (0, "", ())}

    def put(to, state, made):
        if state not in to or made[:2] < to[state][:2]:
            to[state] = made

    def following(state):
        return "assistant" if state == "u" else "user"

    def with_inserts(cells):
        out = dict(cells)
        for _ in range(3):
            for state, (cost, audit, kept) in list(out.items()):
                role = following(state)
                put(out, role[0], (cost + 3, audit + "I", (*kept, (role, ""))))
        return out

    for role, text, gone, flaw in turns:
        new = {}
        for state, (cost, audit, kept) in with_inserts(cells).items():
            put(new, state, (cost + 4, audit + "D", kept))
            if gone:
                continue
            to, more = following(state), 3 * flaw
            if role[:1] == to[0]:
                put(new, to[0], (cost + more, audit + "K", (*kept, (role, text))))
            put(new, to[0], (cost + 3 + more, audit + "R", (*kept, (to, text))))
            if state == "" and role[:1] == "s":
                put(new, "s", (cost + more, audit + "K", (*kept, (role, text))))
        cells = new
    end = with_inserts(cells)
    return min((end[s] for s in ("", "a") if s in end), key=lambda v: v[:2])


def expected(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), sha256(t[2].encode()).digest()))
        seen, marks, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            body = text.rstrip(SPACE)
            fault = (
                "blank" if not body else "duplicate" if (role, text) in seen
                else "truncated" if body[-1] not in ".!?" else None
            )
            seen.add((role, text))
            if fault:
                n[fault] += 1
            marks.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        places = {t[0] for t in turns} - {None}
        gaps = max(places) - min(places) + 1 - len(places) if places else 0
        cost, audit, kept = cheapest(marks)
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out.append((conv, gaps, *n.values(), illegal, cost, audit, sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversation_rows(seed, n=500):
    rng = random.Random(seed)
    convs = [None, *range(30), *[7] * 20]  # one conversation with many of the turns
    roles = ["user", "assistant", "system", "u2", "tool", None, "", "söm"]
    texts = ["Hi.", "Yes!", "no", "", " \t", "What? ", None, "end.\n", "ok..x", "Ä.", "x. " * 900]
    rows = [
        (rng.choice(convs), rng.choice([None, *range(40)]), rng.choice(roles), rng.choice(texts))
        for _ in range(n)
    ]
    return rows + rows[:5] + [(99, 3, "user", "Same.")] * 40 + [(98, None, "user", "So.")]


@pytest.mark.parametrize("size", [2048, 3])
def test_repair_equals_brute_force(spark, stages, rows, monkeypatch, size):
    whole = conversations.segments
    monkeypatch.setattr(conversations, "segments", lambda df: whole(df, size))
    data = [r for seed in (1, 2) for r in conversation_rows(seed)]
    frame = spark.createDataFrame(data, TURN).repartition(5)
    for name in ("digest", "kind", "copies", "audit", "seen", "c"):  # other columns, with names used inside
        frame = frame.withColumn(name, F.lit(1))
    assert rows(conversations.repair_report(frame, stages)) == expected(data)


def test_repair_of_all_conversations(spark, stages, rows):
    sf = "/root/testdata/sf0.01"
    made = queries.op11_conversation_repair(spark, sf)
    table = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    data = [tuple(r) for r in table.collect()]
    assert rows(made) == expected(data) and made.count() == len({r[0] for r in data})


def test_empty_and_dropped(spark, stages, rows):
    none = spark.createDataFrame([], TURN)
    assert conversations.repair_report(none, stages).collect() == []
    gone = next((c, t) for c in range(99) for t in range(99) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    made = rows(conversations.repair_report(spark.createDataFrame([(*gone, "user", "Hi.")], TURN), stages))
    assert made == [(gone[0], 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


def test_one_conversation_is_dealt_over_tasks(spark, stages, rows):
    data = [(1, t, ("user", "assistant")[t % 2], f"Text {t * 7919 % 60}.") for t in range(9000)]
    parts = conversations.segments(conversations.faults(
        conversations.damaged(spark.createDataFrame(data, TURN))), 500)
    sizes = [r.rows for r in parts.select("rows").collect()]
    assert max(sizes) <= 1000 and len(sizes) >= 18
    assert rows(conversations.repair_report(spark.createDataFrame(data, TURN), stages)) == expected(data)


# --- audits as persistent strings


def tree(seed, labels):
    """Audits that continue earlier ones, and their plain strings."""
    rng = random.Random(seed)
    made, texts = Audits(), [""]
    nodes = [0]
    for _ in range(300):
        at = rng.randrange(len(nodes))
        label = rng.choice(labels)
        nodes.append(made.add(nodes[at], label))
        texts.append(texts[at] + label)
    return made, nodes, texts, rng


@pytest.mark.parametrize("labels", [list("KDIR"), ["K", "KD", "KDK", "D" * 70, "KDKI"]])
def test_audits_compare_like_strings(labels, monkeypatch):
    monkeypatch.setattr(audits, "LABEL", 16)
    made, nodes, texts, rng = tree(5, labels)
    for _ in range(3000):
        a, b = rng.randrange(len(nodes)), rng.randrange(len(nodes))
        assert made.text(nodes[a]) == texts[a] and made.length[nodes[a]] == len(texts[a])
        assert made.less(nodes[a], nodes[b]) == (texts[a] < texts[b])


def test_colliding_hashes_are_found_out(monkeypatch):
    monkeypatch.setattr(audits, "PRIME", 3)  # nearly every prefix collides
    audits._label_hashes.cache_clear(), audits._power.cache_clear()
    made, nodes, texts, rng = tree(6, ["K", "KD", "DK", "I"])
    for _ in range(3000):
        a, b = rng.randrange(len(nodes)), rng.randrange(len(nodes))
        assert made.less(nodes[a], nodes[b]) == (texts[a] < texts[b])
    audits._label_hashes.cache_clear(), audits._power.cache_clear()


def test_ties_take_the_lesser_letters():
    turns = [("u", 1, False, 0), ("u", 1, False, 0), ("a", 1, False, 0), ("a", 1, False, 0)]
    flat = [(initial, f"{i}.", gone, flaw) for i, (initial, _, gone, flaw) in enumerate(turns)]
    made, cells = Audits(), [(0, 0), None, None, None]
    for initial, _, _, flaw in turns:
        cells = audits.after_turn(made, cells, initial, flaw)
    cost, node = audits.solved(made, cells)
    assert (cost, made.text(node)) == cheapest(flat)[:2]
