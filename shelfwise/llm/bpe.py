"""Byte-level BPE by merge replay: encode texts to ids and back."""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfwise.llm.common import map_rows

#: Pieces whose ids a worker remembers, and the longest such piece in bytes.
REMEMBERED, LONGEST = 400_000, 64


class Merges:
    """A rank file as tables: id of each byte, id made by each pair of ids, bytes of each id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            rows = (line.split() for line in f if line.strip())
            ranks = {base64.b64decode(a): int(b) for a, b in rows}
        self.words = {i: b for b, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)])
        #: Ids stay below 2 ** 20, so a pair fits in one int.
        self.pairs = {
            ranks[b[:i]] << 20 | ranks[b[i:]]: r
            for b, r in ranks.items() for i in range(1, len(b)) if b[:i] in ranks and b[i:] in ranks
        }
        self.byte_pairs = np.full((256, 256), -1)
        for b, r in ranks.items():
            if len(b) == 2:
                self.byte_pairs[b[0], b[1]] = r

    def replay(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, all pieces being merged together in rank order.

        The pieces are laid end to end as one array of ids. An inverted index leads from a pair's
        rank to the positions where the pair stands. The lowest rank is taken from a heap, all its
        positions are merged from left to right, and only the two pairs beside a merge are posted
        anew. A merge can make a pair of lower rank than its own; that one then comes first.
        """
        lengths = np.array([len(p) for p in pieces], np.int64)
        ends = np.cumsum(lengths)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        if not n:
            return [[] for _ in pieces]
        step = np.arange(n)
        full = ends[lengths > 0]
        follow, before = step + 1, step - 1
        follow[full - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        ranks = np.where(follow[:-1] > 0, self.byte_pairs[raw[:-1], raw[1:]], -1)
        at = np.flatnonzero(ranks >= 0)
        at = at[np.argsort(ranks[at], kind="stable")]
        values, first = np.unique(ranks[at], return_index=True)
        index = {int(r): p.tolist() for r, p in zip(values, np.split(at, first[1:]))}
        tokens = self.byte_ids[raw].tolist()
        follow, before = follow.tolist(), before.tolist()
        self._merge(tokens, follow, before, index)
        kept = np.array(tokens)
        alive = np.concatenate([[0], np.cumsum(kept >= 0)])
        ids = kept[kept >= 0].tolist()
        return [
            ids[a:b]
            for a, b in zip(alive[ends - lengths].tolist(), alive[ends].tolist())
        ]

    def _merge(self, tokens: list, follow: list, before: list, index: dict) -> None:
        get, posts = self.pairs.get, index.get
        heap = list(index)
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            rank = pop(heap)
            posted = index.pop(rank)
            posted.sort()
            for k, at in enumerate(posted):
                left, nxt = tokens[at], follow[at]
                if nxt < 0 or left < 0 or get(left << 20 | tokens[nxt]) != rank:
                    continue  # merged or changed since
                tokens[at], tokens[nxt] = rank, -1
                follow[at] = after = follow[nxt]
                prior = before[at]
                lower = False
                if after >= 0:
                    before[after] = at
                    r = get(rank << 20 | tokens[after])
                    if r is not None:
                        if (there := posts(r)) is None:
                            index[r] = [at]
                            push(heap, r)
                        else:
                            there.append(at)
                        lower = r < rank
                if prior >= 0:
                    r = get(tokens[prior] << 20 | rank)
                    if r is not None:
                        if (there := posts(r)) is None:
                            index[r] = [prior]
                            push(heap, r)
                        else:
                            there.append(prior)
                        lower |= r < rank
                if lower and k + 1 < len(posted):
                    if (there := posts(rank)) is None:
                        index[rank] = posted[k + 1 :]
                        push(heap, rank)
                    else:
                        there += posted[k + 1 :]
                    break


class Codec:
    """Encodes blocks of texts: the distinct new pieces of a block are merged together."""

    def __init__(self, ranks_path: str, pattern: str):
        self.merges = Merges(ranks_path)
        self.split = regex.compile(pattern).findall
        self.ids: dict[str, str] = {}
        self.bytes: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, bytes]]:
        """For each text, its decimal ids joined by one space, and the bytes the ids decode to."""
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.bytes.clear()
        cut = [self.split(t) if t else [] for t in texts]
        pieces = set().union(*cut).difference(self.ids)
        new, word = list(pieces), self.merges.words.__getitem__
        collects = gc.isenabled()
        gc.disable()  # the lists of a block hold no cycles, and there are many
        for p, ids in zip(new, self.merges.replay([p.encode() for p in new])):
            self.ids[p] = " ".join(map(str, ids))
            self.bytes[p] = b"".join(map(word, ids))
        if collects:
            gc.enable()
        for found in cut:
            yield " ".join(map(self.ids.__getitem__, found)), b"".join(map(self.bytes.__getitem__, found))
        for p in new:
            if len(p) > LONGEST:
                del self.ids[p], self.bytes[p]


def blocks(texts: list[str | None], most: int):
    """Runs of texts of about ``most`` characters; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t or "") > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t or "")
    if run:
        yield run


def bpe_digests(
    df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
    block_chars: int = 4_000_000,
) -> DataFrame:
    """Number of ids, and digests of the ids and of the decoded bytes, of every whole text.

    ``ranks_path`` must exist on every executor. Each row is encoded where it is read: no row is
    shuffled, and a block of texts bounds what a task holds. Null and empty texts have no ids.
    """

    def digests(columns: list[list]) -> list[list]:
        codec = _codec(ranks_path, pattern)
        n, a, b = [], [], []
        for block in blocks(columns[0], block_chars):
            for ids, decoded in codec.encode(block):
                n.append(ids.count(" ") + 1 if ids else 0)
                a.append(hashlib.sha256(ids.encode()).hexdigest())
                b.append(hashlib.sha256(decoded).hexdigest())
        return [n, a, b]

    return map_rows(
        df, digests, [key], [text], "n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def bpe_ids(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", block_chars: int = 500_000
) -> DataFrame:
    """All columns of ``df`` with ``token_ids`` (array of int) and ``decoded`` (binary). What a task
    holds is bounded by a block of texts: their ids are packed, and sent on before the next block."""

    def run(columns: list[list]) -> list[pa.Array]:
        codec = _codec(ranks_path, pattern)
        ids, decoded = [np.empty(0, np.int32)], []
        for found, whole in codec.encode(columns[0]):
            ids.append(np.fromstring(found, np.int32, sep=" "))
            decoded.append(whole)
        ends = np.cumsum([len(i) for i in ids], dtype=np.int32)
        return [
            pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))),
            pa.array(decoded, pa.binary()),
        ]

    kept = [c for c in df.columns if c not in ("token_ids", "decoded")]
    return map_rows(df, run, kept, [text], "token_ids array<int>, decoded binary", most=block_chars)


@lru_cache(maxsize=2)
def _codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)
