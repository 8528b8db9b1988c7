"""Random texts with copies, near copies, shared passages and odd cases."""

import random

WORDS = [a + b for a in ("", "ka", "lo", "Mi") for b in ("re", "tan", "su", "vey", "ö", "na,", "ri.")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "x", "io"]) for _ in range(n))


def corpus(seed, n=40, words=60):
    """(doc_id, text) rows; the last ones are null, empty, blank, short, long, repeated."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randrange(5, 2 * words)) for _ in range(n)]
    passage = sentence(rng, words)
    out = list(base)
    for text in base[: n // 3]:
        w = text.split(" ")
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    out += [f"{sentence(rng, 9)}\n{passage}\t {sentence(rng, 7)}" for _ in range(n // 4)]
    out += base[:5] + [base[0]] * 6
    out += [None, "", " \n\t", "one", "One two", "a " * 400, "ab" * 900, sentence(rng, 3000), " x y z"]
    rng.shuffle(out)
    rows = list(enumerate(out))
    return rows + [rows[3], rows[3], (None, base[1]), (None, None)]
