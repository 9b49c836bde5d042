"""Words and 64-bit hashes of word windows, computed on whole blocks of text with numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np

#: Bytes of text that are hashed together; a longer text makes a longer block.
BLOCK_BYTES = 1 << 20

# An odd multiplier, its inverse modulo 2^64, and the finaliser of splitmix64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX_1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_2)
    x ^= x >> np.uint64(31)
    return x


def coefficients(n: int, seed: int) -> np.ndarray:
    """`n` odd 64-bit constants, the same in every process."""
    start = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(BASE)
    return mix(start) | np.uint64(1)


class Words:
    """The words of a block of texts: hash, first byte and end byte of each; `first[i]` is text i's first word."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, first: np.ndarray):
        self.data, self.starts, self.ends, self.hashes, self.first = data, starts, ends, hashes, first

    def windows(self, width: int, seed: int = 0) -> np.ndarray:
        """Hash of the `width` words that begin at each word; the last `width` - 1 of a text reach into the next."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for j, c in enumerate(coefficients(width, seed)):
            total += self.hashes[j : j + n] * c
        return mix(total)


class WordHasher:
    """Hashes words (runs of bytes other than ASCII white space) of blocks of texts."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, np.uint64)
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 2 * BLOCK_BYTES)
            made = []
            for base in (BASE, INVERSE):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                made.append(np.multiply.accumulate(steps))
            self.power, self.inverse = made

    def __call__(self, texts: list[bytes]) -> Words:
        joined = b"\n".join(texts)
        data = np.frombuffer(joined, np.uint8)
        begins = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
        if not len(data):
            none = np.zeros(0, np.int64)
            return Words(data, none, none, np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
        word = ~self.space[data]
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        edges = np.concatenate(([0] * bool(word[0]), edges, [len(data)] * bool(word[-1]))).astype(np.int64)
        starts, ends = edges[::2], edges[1::2]
        self._powers(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[: len(data)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * self.inverse[starts] if len(starts) else np.zeros(0, np.uint64)
        hashes = mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(MIX_1))
        return Words(data, starts, ends, hashes, np.searchsorted(starts, begins))


def blocks(rows: Iterable[tuple[Any, str]], lower: bool = False) -> Iterator[tuple[list[Any], list[bytes]]]:
    """Rows gathered to blocks of about `BLOCK_BYTES`; `lower` turns A-Z into a-z."""
    keys: list[Any] = []
    texts: list[bytes] = []
    held = 0
    for key, text in rows:
        data = text.encode()
        keys.append(key)
        texts.append(data.lower() if lower else data)
        held += len(data)
        if held >= BLOCK_BYTES:
            yield keys, texts
            keys, texts, held = [], [], 0
    if keys:
        yield keys, texts
