"""Words and their 64-bit hashes, found with whole-array operations over UTF-8 bytes.

Used inside tasks, on the texts of one Arrow batch. A word is a run of bytes that are not separators. Hashes fold ASCII
case if asked; a text is taken in slices that end at a separator, so memory stays bounded for texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE_BYTES = 1 << 20
SPACES = bytes([9, 10, 11, 12, 13, 32])
#: Everything in ASCII but digits and letters.
NON_ALNUM = bytes(b for b in range(128) if not chr(b).isalnum())

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Word hashes under one choice of separators and case folding."""

    def __init__(self, separators: bytes = SPACES, fold: bool = True) -> None:
        self.separator = np.zeros(256, bool)
        self.separator[list(separators)] = True
        folded = np.arange(256, dtype=np.uint64)
        if fold:
            folded[65:91] += np.uint64(32)
        self.value = mix(folded + np.uint64(1))
        self._power = self._inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._power) < n:
            up, down = np.full(n, _BASE), np.full(n, _INVERSE)
            up[0] = down[0] = 1
            self._power, self._inverse = np.cumprod(up), np.cumprod(down)
        return self._power, self._inverse

    def spans(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte start, byte end and hash of each word."""
        starts, ends, hashes = [], [], []
        for at, part in self._slices(raw):
            s, e, h = self._slice(part)
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(h)
        if not starts:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0, np.uint64)
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)

    def batch(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words of several short texts at once: text number, start, end (within the joined bytes), hash, and the bytes."""
        gap = bytes([int(np.flatnonzero(self.separator)[0])])
        joined = gap.join(texts)
        s, e, h = self.spans(joined)
        first = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
        return np.searchsorted(first, s, side="right") - 1, s, e, h, np.frombuffer(joined, np.uint8)

    def _slices(self, raw: bytes) -> Iterator[tuple[int, np.ndarray]]:
        data = np.frombuffer(raw, np.uint8)
        at = 0
        while at < len(data):
            end = min(len(data), at + SLICE_BYTES)
            while end < len(data) and not self.separator[data[end]]:
                after = self.separator[data[end : end + SLICE_BYTES]]
                end += int(after.argmax()) if after.any() else len(after)
            yield at, data[at:end]
            at = end

    def _slice(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~self.separator[data]
        edge = np.diff(inside)
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * power[: len(data)], out=total[1:])
        return s, e, mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64))


def grouped(texts: list[bytes | None], most: int = SLICE_BYTES, rows: int = 4096) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts in groups of about ``most`` bytes and at most ``rows`` texts, each with the number of its first one.

    Null counts as empty.
    """
    begin, held, size = 0, [], 0
    for k, text in enumerate(texts):
        held.append(text or b"")
        size += len(held[-1])
        if size >= most or len(held) == rows:
            yield begin, held
            begin, held, size = k + 1, [], 0
    if held:
        yield begin, held


def runs(hashes: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of each run of ``length`` consecutive words; a text of fewer words has one run, all its words."""
    if not len(hashes):
        return owner, hashes
    n = np.bincount(owner)[owner]
    first = np.searchsorted(owner, owner)
    place = np.arange(len(hashes)) - first
    begin = np.flatnonzero((place + length <= n) | ((place == 0) & (n < length)))
    size = np.minimum(n[begin], length)
    out = np.zeros(len(begin), np.uint64)
    for k in range(length):
        here = k < size
        at = np.minimum(begin + k, len(hashes) - 1)
        out = np.where(here, mix(out * np.uint64(31) + hashes[at] + np.uint64(k + 1)), out)
    return owner[begin], out


def weighted(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, element and count of each distinct element of each owner."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])][: len(owner)])
    return owner[first], hashes[first], np.diff(np.r_[first, len(owner)])
