"""Exact substring dedup: bytes covered by a 50-byte string that also starts in an earlier document.

1. Every 50-byte window has an anchor: the least hash of its 20-byte strings. Consecutive windows of one anchor
   form a segment. A census tells in how many documents each anchor occurs; segments of anchors that only one
   document holds are done with.
2. The other segments, with the bytes their windows cover, meet in a bucket by anchor, so equal windows meet.
   Each bucket sorts the suffixes that begin a window (two-stage sorting), and equal neighbours, those with a
   common prefix of 50 bytes, form the groups in which a later document loses what an earlier one has.
3. Anchors with more text than HOT units of it are not gathered: their windows are cut out one by one, equal ones are
   reduced to the least doc_id within each block and then by partial aggregates, and joined back.
4. Hits return to the block of their document, which merges them and hashes what remains.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.census import Ledger, blocks_of, census, ordered
from quarry.llm.storage import removed, saved, spread
from quarry.llm.suffixes import common_prefixes, suffix_array
from quarry.llm.tables import hex_sha256, whole
from quarry.llm.wordscan import batches, mix

LENGTH = 50
GRAM = 20
UNIT = 64  # windows of one anchor in one document that count as one unit of text
HOT = 1 << 15  # units of one anchor that a bucket takes: less than 4 MB of text
PIECE = 1 << 12  # windows of a segment; longer ones are cut
HOT_WINDOWS = 1 << 17
KEYS_PER_BYTE = 0.066
BUCKET_BYTES = 3 << 20
_BASE = 0xD6E8FEB86659FD93
_M64 = (1 << 64) - 1


def rolling(text: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes from every position, by doubling; the last size - 1 entries mean nothing."""
    part, n = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), 1
    out, have = None, 0
    while True:
        if size & n:
            if out is None:
                out = part.copy()
            else:
                out *= np.uint64(pow(_BASE, n, 1 << 64))
                out[: len(out) - have] += part[have:]
            have += n
        if 2 * n > size:
            return mix(out)
        longer = part * np.uint64(pow(_BASE, n, 1 << 64))
        longer[: len(part) - n] += part[n:]
        part, n = longer, 2 * n


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least of `width` values from every position on; fewer at the end."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        out[: len(out) - step] = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
    """Anchor, text, first window and number of windows of every segment, in order."""
    keys, docs, starts, counts = [], [], [], []
    for lo, hi in batches([len(t) for t in texts]):
        sizes = np.fromiter((len(t) for t in texts[lo:hi]), dtype=np.int64, count=hi - lo)
        text = np.frombuffer(b"".join(texts[lo:hi]), dtype=np.uint8)
        if len(text) < length:
            continue
        least = window_minimum(rolling(text, gram), length - gram + 1)
        doc = np.repeat(np.arange(hi - lo), sizes)
        ends = np.cumsum(sizes)
        valid = np.zeros(len(text), dtype=bool)
        room = np.maximum(sizes - length + 1, 0)
        begin = ends - sizes
        marks = np.zeros(len(text) + 1, dtype=np.int32)
        np.add.at(marks, begin[room > 0], 1)
        np.add.at(marks, (begin + room)[room > 0], -1)
        valid = np.cumsum(marks[:-1]) > 0
        at = np.flatnonzero(valid)
        if not len(at):
            continue
        value, own = least[at], doc[at]
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (own[1:] != own[:-1])])
        begins = np.flatnonzero(new)
        steps = np.arange(len(at)) - np.repeat(begins, np.diff(np.append(begins, len(at))))
        first = np.flatnonzero(steps % PIECE == 0)
        keys.append(value[first])
        docs.append(own[first] + lo)
        starts.append(at[first] - begin[own[first]])
        counts.append(np.diff(np.append(first, len(at))))
    if not keys:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in (keys, docs, starts, counts))


def weighed(keys: np.ndarray, doc: np.ndarray, counts: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and texts for the census, so that it counts text: more than UNIT windows of one anchor in one text stand
    for further texts, which come last."""
    if not len(keys):
        return keys, doc
    order = np.lexsort((doc, keys))
    k, d = keys[order], doc[order]
    begins = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])]))
    extra = (np.add.reduceat(counts[order], begins) - 1) // UNIT
    more = np.repeat(begins, extra)
    nth = np.arange(len(more)) - np.repeat(np.cumsum(extra) - extra, extra)
    return np.concatenate([keys, k[more]]), np.concatenate([doc, d[more] + n_texts * (1 + nth)])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys, doc, _, counts = segments(texts)
    return weighed(keys, doc, counts, len(texts))


SHARED = "bucket int, win binary, least long, block int, ids binary, starts binary, counts binary, data binary"
HITS = "block int, ids binary, starts binary, counts binary"


def shared_segments(key, table, answer, buckets, targets, hot):
    """Segments whose anchor other documents hold, packed by bucket; windows of hot anchors one by one."""
    ids, texts = ordered(table)
    keys, doc, starts, counts = segments(texts)
    total = Ledger(*weighed(keys, doc, counts, len(texts)), buckets).told(answer)[: len(keys)]
    block = key[0].as_py()
    rows = []
    some = np.flatnonzero((total >= 2) & (total <= hot))
    target = ((mix(keys[some]) >> np.uint64(11)) % np.uint64(targets)).astype(np.int64)
    some = some[np.argsort(target, kind="stable")]
    target = np.sort(target)
    cuts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(some) else []
    for a, b in zip(cuts, np.append(cuts[1:], len(some)) if len(some) else []):
        own = some[a:b]
        data = b"".join(texts[d][s : s + n + LENGTH - 1] for d, s, n in zip(doc[own].tolist(), starts[own].tolist(), counts[own].tolist()))
        rows.append((int(target[a]), None, None, block, ids[doc[own]].astype(np.int64).tobytes(), starts[own].tobytes(), counts[own].astype(np.int32).tobytes(), data))
    many = np.flatnonzero(total > hot)
    for part in np.array_split(many, int(counts[many].sum()) // HOT_WINDOWS + 1):
        rows += [(None, win, least, block, own.tobytes(), at.tobytes(), None, None) for win, least, own, at in single_windows(texts, ids, doc[part], starts[part], counts[part])]
    types = [pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "win", "least", "block", "ids", "starts", "counts", "data"]
    return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(names, types))})


def single_windows(texts: list[bytes], ids: np.ndarray, doc: np.ndarray, starts: np.ndarray, counts: np.ndarray):
    """Distinct windows of some segments: bytes, least doc_id, and the doc_ids and starts of all places."""
    if not len(doc):
        return
    data = b"".join(texts[d][s : s + n + LENGTH - 1] for d, s, n in zip(doc.tolist(), starts.tolist(), counts.tolist()))
    segment = np.repeat(np.arange(len(doc)), counts)
    step = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    size = counts + LENGTH - 1
    place = (np.cumsum(size) - size)[segment] + step
    _, first, number = np.unique(rolling(np.frombuffer(data, dtype=np.uint8), LENGTH)[place], return_index=True, return_inverse=True)
    own, at = ids[doc[segment]].astype(np.int64), (starts[segment] + step).astype(np.int64)
    order = np.argsort(number, kind="stable")
    cuts = np.append(np.searchsorted(number[order], np.arange(len(first))), len(order))
    for k, f in enumerate(place[first].tolist()):
        places = order[cuts[k] : cuts[k + 1]]
        yield data[f : f + LENGTH], int(own[places].min()), own[places], at[places]


def equal_windows(table):
    """One bucket: runs of windows that an earlier document also has, by block."""
    unique: dict[bytes, int] = {}
    least: list[int] = []
    rows = []
    for block, ids, starts, counts, data in zip(*(table.column(c).to_pylist() for c in ("block", "ids", "starts", "counts", "data"))):
        ids, starts, counts = np.frombuffer(ids, np.int64), np.frombuffer(starts, np.int64), np.frombuffer(counts, np.int32)
        number, at = np.empty(len(ids), dtype=np.int64), 0
        for k, (i, n) in enumerate(zip(ids.tolist(), counts.tolist())):
            seg = data[at : at + n + LENGTH - 1]
            at += n + LENGTH - 1
            u = unique.setdefault(seg, len(least))
            if u == len(least):
                least.append(i)
            elif i < least[u]:
                least[u] = i
            number[k] = u
        rows.append((block, ids, starts, counts, number))
    segs = list(unique)
    text = np.frombuffer(b"".join(segs), dtype=np.uint8)
    sizes = np.fromiter((len(s) for s in segs), dtype=np.int64, count=len(segs))
    n_windows = sizes - LENGTH + 1
    begin = np.cumsum(sizes) - sizes
    first_window = np.cumsum(n_windows) - n_windows
    owner = np.repeat(np.arange(len(segs)), n_windows)
    places = np.arange(len(owner)) - first_window[owner] + begin[owner]
    wanted = np.zeros(len(text), dtype=bool)
    wanted[places] = True
    order = suffix_array(text, wanted, LENGTH)
    new = common_prefixes(text, order, LENGTH) < LENGTH
    group = np.cumsum(new) - 1
    rank = np.empty(len(text), dtype=np.int64)  # window number of a place
    rank[places] = np.arange(len(places))
    window = rank[order]
    low = np.array(least, dtype=np.int64)
    group_least = np.minimum.reduceat(low[owner[window]], np.flatnonzero(new)) if len(window) else low
    earliest = np.empty(len(places), dtype=np.int64)
    earliest[window] = group_least[group]
    out = []
    for block, ids, starts, counts, number in rows:
        later = ids > low[number]
        hit_ids, hit_starts, hit_counts = [ids[later]], [starts[later]], [counts[later].astype(np.int64)]
        for k in np.flatnonzero(~later).tolist():
            f, n = int(first_window[number[k]]), int(counts[k])
            hit = earliest[f : f + n] < ids[k]
            if hit.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                hit_ids.append(np.full(len(edge) // 2, ids[k]))
                hit_starts.append(starts[k] + edge[::2])
                hit_counts.append(edge[1::2] - edge[::2])
        i, s, n = (np.concatenate(x).astype(np.int64) for x in (hit_ids, hit_starts, hit_counts))
        if len(i):
            out.append((block, i.tobytes(), s.tobytes(), n.tobytes()))
    return hits_table(out)


def hits_table(out: list[tuple]) -> pa.Table:
    types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array([r[k] for r in out], t) for k, (n, t) in enumerate(zip(("block", "ids", "starts", "counts"), types))})


def hot_hits(tables):
    """Places of hot windows that an earlier document also has."""
    for batch in tables:
        out = []
        for block, ids, starts, first in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "starts", "first"))):
            ids, starts = np.frombuffer(ids, np.int64), np.frombuffer(starts, np.int64)
            later = ids > first
            if later.any():
                out.append((block, ids[later].tobytes(), starts[later].tobytes(), np.ones(int(later.sum()), np.int64).tobytes()))
        yield from hits_table(out).to_batches()


RESULT = "doc_id {}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed_spans array<long>"


def remaining(table, hits):
    """Documents of a block without the bytes that hits cover."""
    ids, texts = ordered(table)
    parts = [np.concatenate([np.frombuffer(x, np.int64) for x in hits.column(c).to_pylist()]) if len(hits) else np.zeros(0, np.int64) for c in ("ids", "starts", "counts")]
    order = np.argsort(parts[0], kind="stable")
    hit_ids, starts, counts = (p[order] for p in parts)
    n_bytes, n_removed, n_spans, digests, removed = [], [], [], [], []
    for i, text in zip(ids.tolist(), texts):
        a, b = np.searchsorted(hit_ids, [i, i + 1])
        kept, spans = text, []
        if a < b:
            marks = np.zeros(len(text) + 1, dtype=np.int64)
            ok = starts[a:b] + counts[a:b] + LENGTH - 1 <= len(text)  # rows that repeat a doc_id may be shorter
            np.add.at(marks, starts[a:b][ok], 1)
            np.add.at(marks, (starts[a:b] + counts[a:b] + LENGTH - 1)[ok], -1)
            gone = np.cumsum(marks[:-1]) > 0
            spans = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).tolist()
            kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
        n_bytes.append(len(text))
        n_removed.append(len(text) - len(kept))
        n_spans.append(len(spans) // 2)
        digests.append(hashlib.sha256(kept).hexdigest())
        removed.append(spans)
    return pa.table(
        {
            "doc_id": pa.array(ids, table.schema.field("doc_id").type),
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array(n_spans, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
            "removed_spans": pa.array(removed, pa.list_(pa.int64())),
        }
    )


def deduplicated(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed_spans (start, stop, ..).

    Texts are UTF-8 bytes, null the empty text. A string may occur twice within one document without loss.
    doc_id is an integer; it names a document, so rows with an equal doc_id lose nothing to each other. A row without
    doc_id stands in no order: it loses nothing, and nothing is lost to it. An empty table gives an empty result.
    Only doc_id and text are read.
    """
    dealt, _, n_bytes = blocks_of(docs.select("doc_id", "text").filter("doc_id is not null"))
    body = whole("text")
    nameless = docs.filter("doc_id is null").select(
        "doc_id", F.octet_length(body).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        hex_sha256(body).alias("kept_sha256"), F.array().cast("array<long>").alias("removed_spans"),
    )
    answers, buckets = census(dealt, int(n_bytes * KEYS_PER_BYTE) + 1, anchors)
    targets = max(spread(docs.sparkSession), math.ceil(n_bytes * KEYS_PER_BYTE * 65 / 4 / BUCKET_BYTES))
    shared = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda key, table, answer: shared_segments(key, table, answer, buckets, targets, hot), SHARED
    )
    shared = saved(shared, "segments")
    cold = shared.filter("bucket is not null").select("bucket", "block", "ids", "starts", "counts", "data")
    hits = cold.groupBy("bucket").applyInArrow(equal_windows, HITS)
    common = shared.filter("win is not null").select("win", "least", "block", "ids", "starts")
    held = F.octet_length("ids") > 8  # more than one place in the block
    first = common.groupBy("win").agg(F.min("least").alias("first"), F.count("*").alias("n"), F.bool_or(held).alias("held"))
    first = first.filter("n > 1 or held").select("win", "first")
    # kept, so that neither the segments nor their shuffle files are there when the texts are dealt again
    hits = saved(hits.unionByName(common.join(first, "win").mapInArrow(hot_hits, HITS)), "hits")
    removed(shared)
    type_ = dealt.schema["doc_id"].dataType.simpleString()
    named = dealt.groupBy("block").cogroup(hits.groupBy("block")).applyInArrow(remaining, RESULT.format(type_))
    return named.unionByName(nameless)
