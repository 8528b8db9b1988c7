"""Words of a text as 64-bit hashes, in vectors; the same in every process."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) < n:
        n = 1 << max(16, n.bit_length())
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def prefix_sums(b: np.ndarray) -> np.ndarray:
    """Sums of the bytes' values times the powers of their places, from nothing up to all."""
    up, _ = _tables(len(b) + 1)
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * up[: len(b)], dtype=np.uint64, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per span of the bytes that ``sums`` was made of; equal bytes, equal hash."""
    _, down = _tables(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word."""
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~_SPACE[b]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: bytes) -> np.ndarray:
    b = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(b)
    return span_hashes(prefix_sums(b), starts, ends)


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash per run of ``n`` consecutive hashes; with fewer, one for the whole run."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + hashes[i : i + len(out)]
    return mix(out + np.uint64(n))
