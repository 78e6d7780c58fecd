"""Benchmark decontamination by Wu-Manber search.

Patterns are windows of 13 benchmark words, blank-joined with a blank at both ends, so that a pattern occurs
in a normalised text exactly where its words do. Patterns are banded by length; each band has a table that
tells, for the hash of a block of bytes, how far the window may move on before any pattern can end there.
Blocks with shift 0 lead, by the hash of the pattern's last block, to the patterns to compare with. Many
stretches of text are searched in step: all of them move by their own shifts at once.

The texts stay where they are; the patterns travel in blocks of bounded bytes, one pass over the texts for
each block, so neither side has to fit anywhere as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.storage import removed, saved
from quarry.llm.wordscan import NON_WORDS, Words, batches, byte_table, texts_of

WINDOW = 13
BLOCK = 8
#: Slots of a shift table: twice the blocks of its patterns or more, so that most slots keep the full shift, between these powers of two.
TABLE_BITS = (16, 25)
LANE = 2048
PATTERN_BYTES = 32 << 20
TABLE = byte_table(NON_WORDS)
_MULT = np.uint64(0x9E3779B97F4A7C15)


def block_words(text: np.ndarray, size: int) -> np.ndarray:
    """At i: the `size` bytes that begin at i as one number (size is 2, 4 or 8)."""
    out = text.astype(np.uint64)
    k = 1
    while k < size:
        nxt = np.zeros_like(out)
        nxt[:-k] = out[k:]
        out = (out << np.uint64(8 * k)) | nxt
        k *= 2
    return out


class Band:
    """Shift and hash tables for patterns of at least `least` bytes."""

    def __init__(self, patterns: list[bytes]):
        self.least = min(map(len, patterns))
        self.block = 8 if self.least >= 16 else 4 if self.least >= 8 else 2
        top = self.least - self.block + 1
        bits = min(max((2 * top * len(patterns) - 1).bit_length(), TABLE_BITS[0]), TABLE_BITS[1])
        self.bits = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, top, dtype=np.int16 if top < 32000 else np.int32)
        self.patterns = patterns
        heads = np.frombuffer(b"".join(p[: self.least] for p in patterns), dtype=np.uint8).reshape(-1, self.least)
        for at in range(top):
            word = np.zeros(len(patterns), dtype=np.uint64)
            for k in range(self.block):
                word = (word << np.uint64(8)) | heads[:, at + k].astype(np.uint64)
            slot = self.slot(word)
            np.minimum.at(self.shift, slot, top - 1 - at)
        order = np.argsort(word, kind="stable")
        self.last, self.order = word[order], order

    def slot(self, word: np.ndarray) -> np.ndarray:
        return ((word * _MULT) >> self.bits).astype(np.int64)

    def search(self, text: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(starts, pattern numbers) of all occurrences."""
        n = len(text)
        if n < self.least:
            return
        blocks = block_words(text, self.block)
        width = max(LANE, self.least)
        at = np.arange(0, n - self.least + 1, width)
        stop = np.minimum(at + width, n - self.least + 1)
        while len(at):
            word = blocks[at + (self.least - self.block)]
            move = self.shift[self.slot(word)].astype(np.int64)
            hit = move == 0
            if hit.any():
                starts, words = at[hit], word[hit]
                lo = np.searchsorted(self.last, words, "left")
                hi = np.searchsorted(self.last, words, "right")
                many = hi - lo
                where = np.repeat(starts, many)
                which = self.order[np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
                same = np.fromiter((text[s : s + len(self.patterns[p])].tobytes() == self.patterns[p] for s, p in zip(where, which)), dtype=bool, count=len(where))
                if same.any():
                    yield where[same], which[same]
            at = at + np.maximum(move, 1)
            live = at < stop
            at, stop = at[live], stop[live]


class Matcher:
    """Bands over a block of distinct patterns; bands double in length, so a short item costs only its own band."""

    def __init__(self, patterns: list[bytes]):
        self.numbers: list[np.ndarray] = []
        self.bands: list[Band] = []
        by: dict[int, list[int]] = {}
        for k, p in enumerate(patterns):
            by.setdefault(len(p).bit_length(), []).append(k)
        for ks in by.values():
            self.numbers.append(np.array(ks))
            self.bands.append(Band([patterns[k] for k in ks]))

    def search(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [(s, numbers[p]) for numbers, band in zip(self.numbers, self.bands) for s, p in band.search(text)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def windows(text: bytes | None, size: int = WINDOW) -> Iterator[bytes]:
    """All windows of an item; one window if it has fewer words, none if it has no word."""
    words = Words([text or b""], TABLE)
    n = int(words.counts[0]) if len(words.counts) else 0
    raw = words.bytes
    for i in range(max(1, n - size + 1) if n else 0):
        yield b" " + raw[words.starts[i] : words.ends[min(i + size, n) - 1]].tobytes() + b" "


def occurrences(texts: list[bytes], matcher: Matcher, length: np.ndarray):
    """Per text: number of words, runs of hit words (start, stop, start, stop, ..), and patterns that occur."""
    for lo, hi in batches([len(t) for t in texts]):
        words = Words(texts[lo:hi], TABLE)
        starts, which = matcher.search(np.concatenate([[np.uint8(32)], words.bytes]))
        first = np.searchsorted(words.starts, starts, "left")
        last = first + length[which] - 1
        inside = last < len(words.doc)
        inside[inside] &= words.doc[first[inside]] == words.doc[last[inside]]
        first, last, which = first[inside], last[inside], which[inside]
        doc = words.doc[first]
        order = np.lexsort((first, doc))
        first, last, which, doc = first[order], last[order], which[order], doc[order]
        cut = np.searchsorted(doc, np.arange(hi - lo + 1))
        for k in range(hi - lo):
            a, b = int(cut[k]), int(cut[k + 1])
            base = int(words.first[k])
            runs: list[int] = []
            for s, e in zip((first[a:b] - base).tolist(), (last[a:b] - base + 1).tolist()):
                if runs and s <= runs[-1]:
                    runs[-1] = max(runs[-1], e)
                else:
                    runs += [s, e]
            yield int(words.counts[k]), runs, np.unique(which[a:b]).tolist()


def covered(runs: list[int]) -> int:
    """Words in the union of runs."""
    total = end = 0
    for s, e in sorted(zip(runs[::2], runs[1::2])):
        total += max(0, e - max(s, end))
        end = max(end, e)
    return total


def scan(tables, shared, first: bool, last: bool) -> Iterator[pa.RecordBatch]:
    """One pass for one block of patterns; adds its runs and items to those of the passes before."""
    patterns, items = shared.value
    matcher = Matcher(patterns)
    length = np.array([p.count(b" ") - 1 for p in patterns], dtype=np.int64)
    for batch in tables:
        n_words, runs, names = [], [], []
        for n, r, found in occurrences(texts_of(batch.column("text")), matcher, length):
            n_words.append(n)
            runs.append(r)
            names.append({x for k in found for x in items[k] if x is not None})
        if not first:
            runs = [a + b for a, b in zip(batch.column("runs").to_pylist(), runs)]
            names = [set(a) | b for a, b in zip(batch.column("items").to_pylist(), names)]
        if not last:
            columns = [batch.column("doc_id"), batch.column("text"), pa.array(runs, pa.list_(pa.int32())), pa.array([sorted(x) for x in names], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "runs", "items"])
            continue
        hit = [covered(r) for r in runs]
        digests = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in names]
        columns = [
            batch.column("doc_id"),
            pa.array(n_words, pa.int64()),
            pa.array(hit, pa.int64()),
            pa.array([len(x) for x in names], pa.int64()),
            pa.array(digests, pa.string()),
            pa.array([h > 0 and 20 * h >= n for h, n in zip(hit, n_words)], pa.bool_()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def pattern_blocks(benchmark: DataFrame, window: int, limit: int = PATTERN_BYTES) -> Iterator[tuple[list[bytes], list[list[str]]]]:
    """Distinct patterns with the ids of their items, in blocks of `limit` bytes and one pattern at most.

    Items come one by one; the windows of an item, and equal ones of several, may stand in more than one block.
    """
    patterns: dict[bytes, list[str]] = {}
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), F.encode("text", "UTF-8").alias("text")).orderBy("item")
    for item, text in rows.toLocalIterator():
        for p in windows(bytes(text) if text is not None else None, window):
            own = patterns.setdefault(p, [])
            size += 0 if own else len(p)
            if item not in own[-1:]:
                own.append(item)
            if size > limit:
                yield list(patterns), list(patterns.values())
                patterns, size = {}, 0
    if patterns:
        yield list(patterns), list(patterns.values())


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A null text has no words, and no hit; nor has an item without words any window. Equal windows of several
    items count for all of them; an item without item_id hits words but is not counted or listed; repeated
    documents are judged again. Empty tables give an empty result, or no hits. Only doc_id, text and item_id are read.

    The driver holds two blocks of patterns at most, the one in use and the one that follows; with more than one,
    every pass but the last is written before the next begins.
    """
    rows = docs.select("doc_id", "text")
    type_ = rows.schema["doc_id"].dataType.simpleString()
    blocks = pattern_blocks(benchmark, window)
    block, first, carried = next(blocks, ([], [])), True, None
    while True:
        following = next(blocks, None)
        last = following is None
        shared = docs.sparkSession.sparkContext.broadcast(block)  # PATTERN_BYTES and one pattern at most
        schema = (REPORT if last else CARRIED).format(type_)
        rows = rows.mapInArrow(lambda t, shared=shared, first=first, last=last: scan(t, shared, first, last), schema)
        if last:
            return rows
        rows = saved(rows, "contamination")
        shared.destroy()
        if carried is not None:
            removed(carried)
        block, first, carried = following, False, rows


CARRIED = "doc_id {}, text string, runs array<int>, items array<string>"
REPORT = "doc_id {}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
