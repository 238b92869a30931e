"""Sets of hashed word shingles of raw texts, vectorised; a small helper inside tasks.

Words are separated by space, tab, line feed, vertical tab, form feed and carriage return; A-Z count as a-z. A word is hashed by
a polynomial over random 64-bit codes of its bytes, read off running sums, so that a buffer of many texts takes a
fixed number of array operations. A shingle is a mixed sum of its words' hashes. Texts with fewer words than a shingle have one, made of
all their words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CHUNK = 1 << 20
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
BLANK = bytes(0x20 if b in SPACES else b for b in range(256))

_rng = np.random.default_rng(20_240_501)
_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_BASE = int(_rng.integers(1 << 40, 1 << 62)) * 8 + 3
_MASK = (1 << 64) - 1
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Shingler:
    def __init__(self, words: int):
        self.words = words
        self._powers(CHUNK + 16)

    def _powers(self, n: int) -> None:
        self.up = np.full(n, _BASE & _MASK, np.uint64)
        self.down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        self.up[0] = self.down[0] = 1
        np.multiply.accumulate(self.up, out=self.up)
        np.multiply.accumulate(self.down, out=self.down)

    def _hash_words(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hash and start of every word of a buffer."""
        data = np.frombuffer(buffer, np.uint8)
        if len(data) + 1 > len(self.up):
            self._powers(len(data) + 16)
        inside = np.concatenate([[False], data != 0x20, [False]])  # all spaces were made blanks before
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[data] * self.up[: len(data)], out=sums[1:])
        return _mix((sums[ends] - sums[starts]) * self.down[starts]), starts

    def _long(self, raw: bytes) -> np.ndarray:
        """Word hashes of one long text, piece by piece, cut at spaces."""
        raw = raw.translate(BLANK)
        parts, at = [], 0
        while at < len(raw):
            cut = len(raw)
            if cut - at > CHUNK:
                cut = raw.rfind(b" ", at, at + CHUNK)
                if cut <= at:
                    cut = raw.find(b" ", at + CHUNK)
                    cut = len(raw) if cut < 0 else cut
            parts.append(self._hash_words(raw[at:cut])[0])
            at = cut + 1
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def _shingles(self, words: np.ndarray) -> np.ndarray:
        k = self.words
        if len(words) == 0:
            return words
        if len(words) < k:
            return _mix((words * _PLACE[32 : 32 + len(words)]).sum(keepdims=True) + _PLACE[len(words)])
        total = words[: len(words) - k + 1] * _PLACE[0]
        for i in range(1, k):
            total = total + words[i : len(words) - k + 1 + i] * _PLACE[i]
        return _mix(total)

    def sets(self, texts: Iterable[bytes | None]) -> Iterator[np.ndarray]:
        """For each text its sorted distinct shingles, as unsigned numbers."""
        waiting: list[bytes] = []
        size = 0
        for text in texts:
            text = text or b""
            if size + len(text) > CHUNK - 1 or len(waiting) >= 4096:
                yield from self._flush(waiting)
                waiting, size = [], 0
            if len(text) >= CHUNK - 1:
                yield np.unique(self._shingles(self._long(text)))
                continue
            waiting.append(text)
            size += len(text) + 1
        yield from self._flush(waiting)

    def _flush(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not texts:
            return
        hashes, starts = self._hash_words(b" ".join(t.translate(BLANK) for t in texts))
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        cuts = np.searchsorted(starts, bounds)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield np.unique(self._shingles(hashes[a:b]))
