"""Words of UTF-8 texts as hashes, a whole slab at a time in numpy.

A word is a run of letters (ASCII letters and all bytes from 0x80), of digits, or of
other signs; bytes 0x20 and 0x09-0x0D separate. Hashes are polynomial over the bytes,
modulo 2**64, then mixed: the hash of a run comes from two prefix sums.
"""

from __future__ import annotations

import numpy as np

_CLASS = np.full(256, 3, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[48:58] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n + 1, 1 << 16)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


class Slab:
    """Words of some texts: ``doc`` (index of the text), ``kind`` (1 letters, 2 digits,
    3 signs), ``start`` and ``end`` in the joined bytes."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.data = _LOWER[joined] if lower else joined
        kind = _CLASS[joined]
        edge = np.flatnonzero(np.diff(kind, prepend=0))
        kinds = kind[edge]
        ends = np.append(edge[1:], len(joined))
        real = kinds > 0
        self.start, self.end, self.kind = edge[real], ends[real], kinds[real]
        breaks = np.cumsum([len(x) + 1 for x in texts])
        self.doc = np.searchsorted(breaks, self.start, side="right")
        up, _ = _power_tables(len(joined) + 1)
        with np.errstate(over="ignore"):
            self._sums = np.concatenate((np.zeros(1, np.uint64),
                                         np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:len(joined)],
                                                   dtype=np.uint64)))

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Of the words, or of the given byte runs."""
        start, end = self.start if start is None else start, self.end if end is None else end
        _, down = _power_tables(len(self.data) + 1)
        with np.errstate(over="ignore"):
            return mixed((self._sums[end] - self._sums[start]) * down[start] + (end - start).astype(np.uint64))
