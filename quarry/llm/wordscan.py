"""Array kernels on bytes of many texts at once: word limits, hashes of byte ranges, batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BATCH_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_table(spaces, lower: bool = True) -> np.ndarray:
    """Byte map: separators become a blank, A-Z become a-z, all else stays."""
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    t[list(spaces)] = 32
    return t


#: White space of the n-gram contract, and everything but digits, letters and non-ASCII.
BLANKS = tuple([0x20, *range(0x09, 0x0E)])
NON_WORDS = tuple(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))


def texts_of(column) -> list[bytes]:
    """Arrow strings as bytes; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def batches(sizes: list[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` bytes; a longer text stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n + 1
    if start < len(sizes):
        yield start, len(sizes)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64; kept per worker, and grown by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, (n - 1).bit_length())
        out = np.ones(size, dtype=np.uint64)
        k, step = 1, base & _M64
        while k < size:
            out[k : 2 * k] = out[:k] * np.uint64(step)
            step = step * step & _M64
            k *= 2
        _powers[base] = have = out
    return have[:n]


class Words:
    """Words of a batch of texts, over their normalised bytes: words of a text joined by single blanks."""

    def __init__(self, texts: list[bytes], table: np.ndarray):
        raw = table[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
        keep = raw != 32
        keep[1:] |= raw[:-1] != 32
        self.bytes = raw[keep]
        blank = self.bytes == 32
        if len(self.bytes) and blank[0]:
            self.bytes, blank = self.bytes[1:], blank[1:]
        self.ends = np.flatnonzero(blank)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]).astype(np.int64) if len(self.ends) else np.zeros(0, np.int64)
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        last = np.concatenate([[0], np.cumsum(keep)])[np.cumsum(sizes)] if len(texts) else np.zeros(0, np.int64)
        lead = int(keep.sum()) - len(self.bytes)
        self.count_to = np.searchsorted(self.ends, last - lead, "left")  # words up to the end of each text
        self.first = np.concatenate([[0], self.count_to[:-1]]).astype(np.int64)
        self.counts = (self.count_to - self.first).astype(np.int64)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self._sums = None

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte ranges: differences of running sums, brought to one power of the base."""
        if self._sums is None:
            n = len(self.bytes)
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_VALUE[self.bytes] * powers(_BASE, n), out=self._sums[1:])
        shift = powers(_INVERSE, len(self.bytes) + 1)
        return mix((self._sums[ends] - self._sums[starts]) * shift[starts])

    def shingles(self, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of `size` consecutive words and their texts; a text of fewer words is one shingle."""
        n = len(self.doc)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.arange(max(0, n - size + 1))
        at = at[self.doc[at] == self.doc[at + size - 1]] if len(at) else at
        short = np.flatnonzero((self.counts > 0) & (self.counts < size))
        starts = np.concatenate([self.starts[at], self.starts[self.first[short]]])
        ends = np.concatenate([self.ends[at + size - 1] if len(at) else at, self.ends[self.count_to[short] - 1]])
        doc = np.concatenate([self.doc[at], short])
        order = np.argsort(doc, kind="stable")
        return self.hash(starts, ends)[order], doc[order]


def distinct(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, value), in that order."""
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return v[new], d[new]
