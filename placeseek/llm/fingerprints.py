"""Fingerprints of word sequences, for operators 1 and 8."""

from __future__ import annotations

import numpy as np
import xxhash

_MEMO_WORDS = 400_000
# Odd multipliers of the two rolling fingerprints.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def words_of(text: str | None) -> list[bytes]:
    """Runs without white space (blank, tab to carriage return), in UTF-8."""
    return (text or "").encode().split()  # bytes are split at exactly those characters


def word_hashes(words: list[bytes], memo: dict[bytes, int]) -> np.ndarray:
    """A 64-bit hash of each word; ``memo`` remembers a bounded number of them."""
    distinct = set(words)
    new = distinct.difference(memo)
    if new:
        if len(memo) > _MEMO_WORDS:
            memo.clear()
            new = distinct
        memo.update([(w, xxhash.xxh3_64_intdigest(w)) for w in new])
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads them evenly (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2**64."""
    if which not in _POWERS or len(_POWERS[which][0]) < n:
        size = max(n, 4096)
        base = _BASES[which]
        inverse = pow(base, -1, 1 << 64)
        made = []
        for b in (base, inverse):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        if size > 1 << 20:  # a very long text: not kept
            return made[0], made[1]
        _POWERS[which] = made[0], made[1]
    return _POWERS[which]


def prefix_sums(hashes: np.ndarray, which: int = 0) -> np.ndarray:
    up, _ = _powers(which, len(hashes) + 1)
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64, out=out[1:])
    return out


def rolling(sums: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """The fingerprint of every run of ``length`` words, from ``prefix_sums``."""
    n = len(sums) - length
    if n <= 0:
        return np.empty(0, np.uint64)
    _, down = _powers(which, len(sums))
    return mixed((sums[length:] - sums[:n]) * down[:n])


def fingerprints_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """The fingerprints of runs of any lengths, from ``prefix_sums``."""
    _, down = _powers(which, len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    if len(x) < width:
        return x[:0]
    span, m = 1, x
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[: len(x) - width + 1], m[width - span :]) if span < width else m
