"""Cheapest edits of a run of turns, as persistent strings.

An audit is a node: the audit it continues, and the letters it adds. Audits that continue the same
one share it. Every node has its length, the rolling hash of the whole audit and its ancestors 1, 2,
4, ... steps back, so two audits of one cost are compared by a search for their longest common
prefix; what the hashes call equal is then compared as nodes, and as letters where nodes differ.
"""

from __future__ import annotations

from functools import cache

PRIME = (1 << 61) - 1
BASE = 0x1F3D5B79A2C4E685 % PRIME
#: Longest label of a node.
LABEL = 4096

KEEP, REROLE, DELETE, INSERT, FLAW = 0, 3, 4, 3, 3  # costs; FLAW is that of a truncated turn that stays

#: What a sequence of roles ends with: nothing, system, user, assistant; and what may follow.
STATES = ("", "s", "u", "a")
AFTER = (2, 2, 3, 2)

Entry = tuple[int, int]  # cost, node


@cache
def _label_hashes(label: str) -> list[int]:
    out = [0]
    for c in label:
        out.append((out[-1] * BASE + ord(c)) % PRIME)
    return out


@cache
def _power(n: int) -> int:
    return pow(BASE, n, PRIME)


class Audits:
    """Node 0 is the empty audit."""

    def __init__(self) -> None:
        self.label, self.length, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, node: int, label: str) -> int:
        for at in range(0, len(label), LABEL):
            node = self._add(node, label[at : at + LABEL])
        return node

    def _add(self, node: int, label: str) -> int:
        ancestors, k = [node], 0
        while len(above := self.up[ancestors[k]]) > k:
            ancestors.append(above[k])
            k += 1
        self.label.append(label)
        self.length.append(self.length[node] + len(label))
        self.hash.append((self.hash[node] * _power(len(label)) + _label_hashes(label)[-1]) % PRIME)
        self.up.append(ancestors)
        return len(self.up) - 1

    def holding(self, node: int, n: int) -> int:
        """The first node on the way to ``node`` whose audit has ``n`` letters or more."""
        for k in range(len(self.up[node]) - 1, -1, -1):
            while len(self.up[node]) > k and self.length[self.up[node][k]] >= n:
                node = self.up[node][k]
        return node

    def prefix_hash(self, node: int, n: int) -> int:
        if not n:
            return 0
        node = self.holding(node, n)
        before = self.up[node][0]
        more = n - self.length[before]
        return (self.hash[before] * _power(more) + _label_hashes(self.label[node])[more]) % PRIME

    def letter(self, node: int, at: int) -> str:
        node = self.holding(node, at + 1)
        return self.label[node][at - self.length[self.up[node][0]]]

    def text(self, node: int, since: int = 0) -> str:
        """The letters added after the ancestor ``since``."""
        labels = []
        while node != since:
            labels.append(self.label[node])
            node = self.up[node][0]
        return "".join(reversed(labels))

    def common(self, a: int, b: int) -> int:
        """Length of the longest common prefix."""
        low, high = 0, min(self.length[a], self.length[b])
        while low < high:
            n = (low + high + 1) // 2
            if self.prefix_hash(a, n) == self.prefix_hash(b, n):
                low = n
            else:
                high = n - 1
        return low if self._same(a, b, low) else self._compared(a, b)

    def _same(self, a: int, b: int, n: int) -> bool:
        """Whether the first ``n`` letters are the same indeed, not only by their hash."""
        if not n:
            return True
        a, b = self.holding(a, n), self.holding(b, n)
        if a == b:
            return True
        fork = self._fork(a, b)
        size = n - self.length[fork]
        return self.text(a, fork)[:size] == self.text(b, fork)[:size]

    def _fork(self, a: int, b: int) -> int:
        """The last node that both continue. A node has a larger number than what it continues."""
        while a != b:
            if a > b:
                a = self.up[a][0]
            else:
                b = self.up[b][0]
        return a

    def _compared(self, a: int, b: int) -> int:
        fork = self._fork(a, b)
        same = 0
        for x, y in zip(self.text(a, fork), self.text(b, fork)):
            if x != y:
                break
            same += 1
        return self.length[fork] + same

    def less(self, a: int, b: int) -> bool:
        n = self.common(a, b)
        if n == min(self.length[a], self.length[b]):
            return self.length[a] < self.length[b]
        return self.letter(a, n) < self.letter(b, n)

    def better(self, old: Entry | None, cost: int, node: int, label: str) -> Entry:
        """The cheaper of an entry and of ``label`` after ``node``; of equal costs the lesser."""
        if old is not None and old[0] < cost:
            return old
        made = cost, self.add(node, label)
        return old if old is not None and old[0] == cost and self.less(old[1], made[1]) else made


def inserted(audits: Audits, cells: list[Entry | None]) -> list[Entry | None]:
    """The cells after any useful insertions."""
    out = list(cells)
    for state in (0, 1, 3):
        if cells[state] is not None:
            cost, node = cells[state]
            out[2] = audits.better(out[2], cost + INSERT, node, "I")
    if out[2] is not None:
        out[3] = audits.better(out[3], out[2][0] + INSERT, out[2][1], "I")
    return out


def deleted(audits: Audits, cells: list[Entry | None], n: int) -> list[Entry | None]:
    return [c and (c[0] + n * DELETE, audits.add(c[1], "D" * n)) for c in cells]


def after_turn(audits: Audits, cells: list[Entry | None], initial: str, flaw: int) -> list[Entry | None]:
    """The cells after a turn that may stay."""
    ready, out = inserted(audits, cells), deleted(audits, cells, 1)
    for state, cell in enumerate(ready):
        if cell is None:
            continue
        cost, node = cell
        to = AFTER[state]
        edit, price = ("K", KEEP) if initial == STATES[to] else ("R", REROLE)
        out[to] = audits.better(out[to], cost + price + flaw, node, edit)
        if state == 0 and initial == "s":
            out[1] = audits.better(out[1], cost + KEEP + flaw, node, "K")
    return out


def solved(audits: Audits, cells: list[Entry | None]) -> Entry:
    """The best audit whose roles end as they may."""
    cells = inserted(audits, cells)
    if cells[0] is None:
        return cells[3]
    if cells[3] is None or cells[0][0] < cells[3][0]:
        return cells[0]
    return audits.better(cells[0], *cells[3], "")


def segment(turns: list[tuple[str, int, bool, bool]], start: int) -> list[tuple[int, int, int, str]]:
    """(start, end, cost, audit) of the best audits of ``turns`` (initial, copies, gone, flaw) that
    begin after roles in the state ``start``, for every state they can end in."""
    audits, cells = Audits(), [None] * 4
    cells[start] = 0, 0
    for initial, copies, gone, flaw in turns:
        if not gone:
            cells = after_turn(audits, cells, initial, FLAW * flaw)
            copies -= 1
        if copies:
            cells = deleted(audits, cells, copies)
    return [(start, end, c[0], audits.text(c[1])) for end, c in enumerate(cells) if c is not None]


def followed(audits: Audits, cells: list[Entry | None], moves: list[dict]) -> list[Entry | None]:
    """The cells after a segment."""
    out: list[Entry | None] = [None] * 4
    for move in moves:
        cell = cells[move["start"]]
        if cell is not None:
            end = move["end"]
            out[end] = audits.better(out[end], cell[0] + move["cost"], cell[1], move["audit"])
    return out
