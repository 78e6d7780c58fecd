"""Fill-in-the-middle: a text is cut at two counted units and its parts are put in another order.

Units are runs of A-Z and a-z, or any other single character. Where the n-th unit lies is found by chunks: a rolling hash
cuts the UTF-8 text where its content says so, so that passages and copies that documents share become equal
chunks, whatever stands before them. A chunk is looked up by its bytes, so an entry is used only for equal content, and its
summary says how many units it holds and whether it begins and ends within a run of letters. Summaries add up: two
chunks hold the units of both, less one if a run crosses between them. The sums name the chunk in which a cut lies;
that chunk alone is looked into.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import whole
from quarry.llm.wordscan import batches, texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SHORTEST, CHUNK, LONGEST = 64, 512, 4096
CACHE_BYTES = 16 << 20
BATCH_BYTES = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
# A random number per byte for the rolling hash, from a linear congruence.
_GEAR = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


@dataclass
class Summary:
    """units: that begin in the chunk, one that goes on from the chunk before included if the chunk begins with a letter."""

    units: int
    opens: bool
    closes: bool
    starts: np.ndarray | None = None  # byte offset of each unit, made when a cut lies in the chunk


def unit_starts(raw: np.ndarray) -> np.ndarray:
    """Byte offsets at which units begin if the text begins here."""
    letter = _LETTER[raw]
    before = np.append(False, letter[:-1])
    return np.flatnonzero(~(letter & before) & ((raw & 0xC0) != 0x80))


def chunk_cuts(raw: np.ndarray) -> list[int]:
    """Ends of chunks: where the hash of the last 32 bytes is 0 modulo CHUNK, not within a character, SHORTEST to about LONGEST bytes apart."""
    h = _GEAR[raw]
    for k in (1, 2, 4, 8, 16):  # sums of 2, 4, ... 32 bytes, each byte shifted by its age
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    whole_char = (raw & 0xC0) != 0x80
    ends = np.flatnonzero(((h[:-1] >> np.uint32(8)) % np.uint32(CHUNK) == 0) & whole_char[1:]) + 1
    out, at = [], 0
    for end in [*ends.tolist(), len(raw)]:
        while end - at > LONGEST:
            at += LONGEST
            while not whole_char[at]:
                at -= 1
            out.append(at)
        if end - at >= SHORTEST or end == len(raw):
            out.append(end)
            at = end
    return out


class Chunks:
    """Summaries by content, forgotten all at once when they fill their share of memory."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.known: dict[bytes, Summary] = {}
        self.size, self.limit, self.met, self.reused = 0, limit, 0, 0

    def summary(self, chunk: bytes) -> Summary:
        self.met += 1
        found = self.known.get(chunk)
        if found is not None:
            self.reused += 1
            return found
        raw = np.frombuffer(chunk, np.uint8)
        found = Summary(len(unit_starts(raw)), bool(_LETTER[raw[0]]), bool(_LETTER[raw[-1]]))
        if self.size > self.limit:
            self.known.clear()
            self.size = 0
        self.known[chunk] = found
        self.size += len(chunk) + 200
        return found


class Document:
    """A text in chunks, and how many units begin before each."""

    def __init__(self, text: bytes, chunks: Chunks):
        self.text, raw = text, np.frombuffer(text, np.uint8)
        self.ends = chunk_cuts(raw) if text else []
        self.starts = [0, *self.ends[:-1]] if text else []
        self.parts = [chunks.summary(text[a:b]) for a, b in zip(self.starts, self.ends)]
        joins = np.array([False] + [a.closes and b.opens for a, b in zip(self.parts, self.parts[1:])], dtype=bool) if text else np.empty(0, dtype=bool)
        own = np.array([p.units for p in self.parts], dtype=np.int64) - joins
        self.joins, self.upto = joins, np.cumsum(own)
        self.n = int(self.upto[-1]) if text else 0

    def offset(self, units: int) -> int:
        """Byte offset after so many units: where the next one begins."""
        if units >= self.n:
            return len(self.text)
        k = int(np.searchsorted(self.upto, units, side="right"))
        part, before = self.parts[k], int(self.upto[k - 1]) if k else 0
        if part.starts is None:
            part.starts = unit_starts(np.frombuffer(self.text[self.starts[k] : self.ends[k]], np.uint8))
        return self.starts[k] + int(part.starts[units - before + int(self.joins[k])])


def cut_texts(tables: Iterator[pa.RecordBatch], text: str, draws: str) -> Iterator[pa.RecordBatch]:
    chunks = Chunks()
    at = lambda t, name: t.column(t.schema.names.index(name))
    for whole_batch in tables:
        texts = texts_of(at(whole_batch, text))
        for a, b in batches([len(x) for x in texts], BATCH_BYTES):
            t = whole_batch.slice(a, b - a)
            out = []
            for raw, (h1, h2) in zip(texts[a:b], at(t, draws).to_pylist()):
                d = Document(raw, chunks)
                low, high = sorted((h1 % (d.n + 1), h2 % (d.n + 1)))
                x, y = d.offset(low), d.offset(high)
                out.append((d.n, raw[:x], raw[x:y], raw[y:]))
            n, *parts = zip(*out)
            kept = [c for c in t.schema.names if c not in (text, draws)]
            yield pa.RecordBatch.from_arrays([*(at(t, c) for c in kept), pa.array(n, pa.int64()), *(pa.array([p.decode() for p in x], pa.string()) for x in parts)], names=[*kept, "n", "prefix", "middle", "suffix"])


def draw(key: str | Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2^32 that the key alone decides; a null key draws like an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key) if isinstance(key, str) else key, F.lit("")).cast("string")), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, plain: int = 10, spm: int = 20) -> DataFrame:
    """One row per document: key, n, form, prefix, middle, suffix, output.

    plain and spm are the percentages of texts left as they are and, of the others, of texts with the suffix first. A null
    text counts as empty. Empty texts, and texts that hold a marker, are plain; their parts are given all the same. Rows that
    repeat a key draw the same lots. Rows stay where they are read, so a hot source or a long text needs no shuffle.
    Only key and text are read.
    """
    h = draw(F.col(key).cast("string"), seed)
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(whole(text), F.lit(m))
    form = F.when((whole(text) == "") | marked | (h[2] % 100 >= 100 - plain), "plain").when(h[3] % 100 < spm, "spm").otherwise("psm")
    rows = docs.select(F.col(key), whole(text).alias("text"), F.array(h[0], h[1]).alias("draws"), form.alias("form"))
    type_ = docs.schema[key].dataType.simpleString()
    cut = rows.mapInArrow(lambda t: cut_texts(t, "text", "draws"), f"`{key}` {type_}, form string, n long, prefix string, middle string, suffix string")
    return cut.select(key, "n", "form", "prefix", "middle", "suffix", arranged(F.col("form"), F.col("prefix"), F.col("middle"), F.col("suffix")).alias("output"))


def arranged(form: Column, prefix: Column, middle: Column, suffix: Column) -> Column:
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    return (
        F.when(form == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(form == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.concat(prefix, middle, suffix))
    )


def restored(form: Column, output: Column) -> Column:
    """The text from output and form alone; the markers stand once each, as marked texts are plain."""
    locate = lambda mark: F.position(F.lit(mark), output)
    piece = lambda mark, end: F.substring(output, locate(mark) + len(mark), (locate(end) if end else F.length(output) + 1) - locate(mark) - len(mark))
    psm = F.concat(piece(PREFIX, SUFFIX), piece(MIDDLE, None), piece(SUFFIX, MIDDLE))
    spm = F.concat(piece(PREFIX, MIDDLE), piece(MIDDLE, None), piece(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
