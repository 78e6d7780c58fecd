"""Near-duplicate passages by compact windows.

The tokens of a text are its five-word shingles. Under one hash function the Cartesian tree of a text tells for
every token the widest stretch of which it is the minimum; tokens whose stretch holds a passage of the least
length give compact windows (first, minimum, last): all sequences that begin in [first, minimum] and end in
[minimum, last] share that min-hash. There are about 2 n / t of them.

1. A census tells which tokens other documents have too. Only stretches of which 27 of 46 tokens in a row are
   such can hold a passage; windows are made of these. Of equal texts one stands for all.
2. A stretch whose tokens in common stand word for word in an earlier document is a copy: it gives one link, at a
   similarity of 1, and the earlier stretch stands for it. All other windows of one min-hash are joined, every document
   with every earlier one.
3. Per pair of documents the aligned windows are joined as intervals: where NEED functions or more cover a
   stretch of the least length, it is a candidate passage.
   Shingles of one word five times over count as larger than all others in every function: a passage of nothing else is a run,
   and runs of one word are linked to the first such.
4. A candidate stays if the shingle sets of both sides have a Jaccard of 0.75 or more. Shingles are compared by
   32 bits of their hash; within two stretches a false match is one in millions, and adds one shingle at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.census import Ledger, blocks_of, census, ordered, picked
from quarry.llm.components import components
from quarry.llm.ngram_join import SIZE, TABLE
from quarry.llm.storage import removed, saved, spread
from quarry.llm.substring import window_minimum
from quarry.llm.wordscan import Words, batches, mix

WORDS = 50
WORD = r"[^\x20\x09-\x0D]+"
LEAST = WORDS - SIZE + 1
FUNCTIONS = 6
NEED = 3
SIMILARITY = 0.75
DENSE = 27
MARGIN = LEAST // 4
KEYS_PER_BYTE = 0.15
FAR = (1 << 14) - 1
SECTION = FAR
MOST = (1 << 64) - 1


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes in reading order, their texts, and which are one word five times; texts of fewer words than a shingle have none."""
    values, docs, alike = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for lo, hi in batches([len(t) for t in texts]):
        words = Words(texts[lo:hi], TABLE)
        at = np.arange(max(0, len(words.doc) - SIZE + 1))
        at = at[words.doc[at] == words.doc[at + SIZE - 1]] if len(at) else at
        if len(at):
            values.append(words.hash(words.starts[at], words.ends[at + SIZE - 1]))
            docs.append(words.doc[at] + lo)
            word = words.hash(words.starts, words.ends)
            again = np.concatenate([[0], np.cumsum(word[1:] == word[:-1])])
            alike.append(again[at + SIZE - 1] - again[at] == SIZE - 1)
    return np.concatenate(values), np.concatenate(docs), np.concatenate(alike)


def nearest_smaller(values: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Index of the last entry before each that is smaller and of its group, else -1: pointers jump until all rest."""
    n = len(values)
    before = np.arange(-1, n - 1)
    if n:
        before[1:][groups[1:] != groups[:-1]] = -1
        before[0] = -1
    while True:
        move = np.flatnonzero(before >= 0)
        move = move[values[before[move]] >= values[move]]
        if not len(move):
            return before
        before[move] = before[before[move]]


class Frame:
    """Where texts begin and end among all tokens, and where a window of `least` tokens fits; one for all functions."""

    def __init__(self, doc: np.ndarray, least: int = LEAST):
        n = len(doc)
        edge = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.append(edge, n))
        self.doc, self.least = doc, least
        self.begin, self.end = np.repeat(edge, sizes), np.repeat(edge + sizes - 1, sizes)
        self.start = np.flatnonzero(self.end - np.arange(n) >= least - 1)


def compact_windows(value: np.ndarray, frame: Frame):
    """(minimum, first, last) as places in `value`, for every window of at least `least` tokens within a text."""
    least, doc, begin, end, start = frame.least, frame.doc, frame.begin, frame.end, frame.start
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    low = window_minimum(value, least)[start]
    run = np.concatenate([[True], (low[1:] != low[:-1]) | (np.diff(start) > 1)])
    heads = start[run]
    last_start = np.append(start[np.flatnonzero(run)[1:] - 1], start[-1]) if len(heads) else heads
    middle = np.concatenate([h + np.argmin(value[h[:, None] + np.arange(least)[None, :]], axis=1) for h in np.array_split(heads, len(heads) * least // (1 << 20) + 1)])
    again = np.flatnonzero(middle < last_start)  # the run goes on without its first minimum, so the same hash comes again
    repeats = [h + np.flatnonzero(value[h : e + least] == value[m]) for h, e, m in zip(heads[again], last_start[again], middle[again])]
    middle = np.unique(np.concatenate([middle, *repeats]))
    v, d = value[middle], doc[middle]
    left = nearest_smaller(v, d)
    right = len(v) - 1 - nearest_smaller(v[::-1], d[::-1])[::-1]
    first = np.where(left >= 0, middle[left] + 1, begin[middle])
    last = np.where(right < len(v), middle[np.minimum(right, len(v) - 1)] - 1, end[middle])
    return middle, first, last


def token_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return tokens(texts)[:2]


def sections(shared: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the stretches in which a passage can lie, among all tokens.

    Tokens in common make up three quarters of a passage, and whatever its length, however they lie in it, some
    LEAST tokens in a row hold DENSE of them. Stretches of such rows are cut where they are longer than SECTION;
    the parts overlap so that every row lies within one.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(shared) < LEAST:
        return none, none
    total = np.concatenate([[0], np.cumsum(shared)])
    rows = np.flatnonzero((total[LEAST:] - total[:-LEAST] >= DENSE) & (doc[LEAST - 1 :] == doc[: len(doc) - LEAST + 1]))
    if not len(rows):
        return none, none
    new = np.flatnonzero(np.concatenate([[True], (np.diff(rows) > LEAST) | (doc[rows[1:]] != doc[rows[:-1]])]))
    start, stop = rows[new], rows[np.append(new[1:], len(rows)) - 1] + LEAST
    step = SECTION - LEAST + 1
    parts = np.maximum(1, -(-(stop - start - LEAST + 1) // step))
    first = np.repeat(start, parts) + step * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    return first, np.minimum(first + SECTION, np.repeat(stop, parts))


def all_windows(value: np.ndarray, doc: np.ndarray, begin: np.ndarray, shared: np.ndarray, alike: np.ndarray):
    """Keys, texts, packed windows and stretches of all functions, and first and last common token of the stretches that can hold a passage.

    Tokens that no other document has are larger than all others: without them two passages are never less alike. So are those of one word
    five times: a run of a frequent word is one token, and would be the minimum of six functions in all documents with such a run, whatever
    stands around it. Passages that hold nothing else are `runs`.
    """
    start, stop = sections(shared, doc)
    at = np.flatnonzero(shared)
    core = at[np.searchsorted(at, start)] if len(start) else start, at[np.searchsorted(at, stop) - 1] + 1 if len(start) else stop
    sizes = stop - start
    at = np.arange(sizes.sum()) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
    frame = Frame(np.repeat(np.arange(len(sizes)), sizes))
    keys, docs, packed, within = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    last = ~shared[at] | alike[at]
    for f in range(FUNCTIONS):
        h = mix(value[at] ^ mix(np.full(1, f + 1, np.uint64)))
        h[last] = np.uint64(MOST)
        c, a, b = compact_windows(h, frame)
        c, a, b = (x[h[c] != np.uint64(MOST)] for x in (c, a, b))
        own = doc[at[c]]
        keys.append(mix(h[c] + np.uint64(f)))
        docs.append(own)
        packed.append((f << 59) | ((at[c] - begin[own]) << 28) | ((c - a) << 14) | (b - c))
        within.append(frame.doc[c])
    return *map(np.concatenate, (keys, docs, packed, within)), core


def contents(value: np.ndarray, begin: np.ndarray, doc: np.ndarray, core: tuple) -> np.ndarray:
    """What the cores of stretches hold, by 64 bits: their tokens in order, and how much text is left around, as far as passages reach."""
    start, stop = core
    total = np.zeros(len(start), np.uint64)
    sizes = stop - start
    at = np.arange(sizes.sum()) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
    if len(at):
        placed = mix(value[at] + mix((at - np.repeat(start, sizes)).astype(np.uint64)))
        total = np.add.reduceat(placed, np.cumsum(sizes) - sizes)
    room = [np.minimum(x, LEAST).astype(np.uint64) for x in (start - begin[doc], begin[doc + 1] - stop)]
    return mix(total + mix(sizes.astype(np.uint64) * np.uint64(1 << 16) + room[0] * np.uint64(1 << 8) + room[1]))


def unpacked(w: np.ndarray):
    """Function, minimum, reach to the left and to the right."""
    return w >> 59, (w >> 28) & ((1 << 31) - 1), (w >> 14) & FAR, w & FAR


def spaced(keys: np.ndarray, doc: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Windows to keep, of windows in order of doc, key and place: all but those within runs.

    In a run the same tokens come again in less than a passage, so that one window for each LEAST places tells as
    much as all of them.
    """
    n = len(keys)
    if n < 3:
        return np.ones(n, dtype=bool)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value), dtype=np.uint64)])
    same = (keys[1:] == keys[:-1]) & (doc[1:] == doc[:-1])
    step, between = np.diff(place), total[place[1:]] - total[place[:-1]]
    run = np.zeros(n, dtype=bool)
    run[1:-1] = same[1:] & same[:-1] & (step[1:] == step[:-1]) & (step[1:] < LEAST) & (between[1:] == between[:-1])
    start = np.maximum.accumulate(np.where(run, 0, np.arange(n)))
    slot = (place - place[start]) // LEAST
    return ~run | (slot != np.concatenate([[0], slot[:-1]]))


def runs(value: np.ndarray, doc: np.ndarray, alike: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) of the passages that are one word over and over, in tokens."""
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(value))
    keep = (stop - start >= LEAST) & alike[start]
    return start[keep], stop[keep]


STRETCHES = "array<struct<start: long, n: long, content: long>>"
CANDIDATES = f"doc_id long, keys array<long>, windows array<long>, parts array<int>, cores {STRETCHES}, runs {STRETCHES}, tokens binary"


def shared_windows(table, answer, buckets: int):
    """Documents of a block with stretches that can hold a passage: the windows of these, and all tokens."""
    ids, texts = ordered(table)
    keep = np.flatnonzero(picked(ids, answer))
    ids, texts = ids[keep], [texts[i] for i in keep]
    value, of, alike = tokens(texts)
    begin = np.searchsorted(of, np.arange(len(texts) + 1))
    shared = Ledger(value, of, buckets).told(answer) >= 2
    keys, doc, packed, within, core = all_windows(value, of, begin, shared, alike)
    first = np.searchsorted(of[core[0]], np.arange(len(texts) + 1))
    order = np.lexsort((within, packed, keys, doc))
    # where stretches were cut a window may come twice
    same = (packed[order][1:] == packed[order][:-1]) & (doc[order][1:] == doc[order][:-1]) & (within[order][1:] == within[order][:-1])
    order = order[np.concatenate([[True], ~same])] if len(order) else order
    order = order[spaced(keys[order], doc[order], begin[doc[order]] + unpacked(packed[order])[1], value)]
    cuts = np.searchsorted(doc[order], np.arange(len(texts) + 1))
    run = runs(value, of, alike & shared)
    held = []
    for (start, stop), content in ((core, contents(value, begin, of[core[0]], core)), (run, value[run[0]])):
        at = np.searchsorted(of[start], np.arange(len(texts) + 1))
        rows = [dict(zip(("start", "n", "content"), x)) for x in zip((start - begin[of[start]]).tolist(), (stop - start).tolist(), content.view(np.int64).tolist())]
        held.append([rows[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())])
    out = []
    for i in np.flatnonzero(np.diff(first)).tolist():
        own = order[cuts[i] : cuts[i + 1]]
        own_tokens = (value[begin[i] : begin[i + 1]] >> np.uint64(32)).astype(np.uint32)
        out.append((int(ids[i]), keys[own].view(np.int64), packed[own], (within[own] - first[i]).astype(np.int32), held[0][i], held[1][i], own_tokens.tobytes()))
    part = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "n", "content")]))
    types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), part, part, pa.binary())
    names = ("doc_id", "keys", "windows", "parts", "cores", "runs", "tokens")
    return pa.table({n: pa.array([r[k] for r in out], t) for k, (n, t) in enumerate(zip(names, types))})


def stretches(pair: np.ndarray, mine: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Candidates (pair, start, stop, other start, other stop) in tokens, for many pairs of documents at once.

    pair: number of the pair of documents to which a pair of windows belongs.
    """
    f, c, left, right = unpacked(mine)
    _, c2, left2, right2 = unpacked(theirs)
    left, right, shift = np.minimum(left, left2), np.minimum(right, right2), c2 - c
    order = np.lexsort((c, shift, pair))
    # windows of one alignment, give or take a few words put in or left out, are judged together
    edge = np.ones(len(order), dtype=bool)
    edge[1:] = (np.diff(pair[order]) != 0) | (np.diff(shift[order]) > 8)
    group = np.cumsum(edge) - 1
    if len(order):
        enough = np.bitwise_count(np.bitwise_or.reduceat(1 << f[order], np.flatnonzero(edge))) >= NEED
        order, group = order[enough[group]], group[enough[group]]
    if not len(order):
        return (np.zeros(0, np.int64),) * 5
    f, c, shift, pair, lo, hi = f[order], c[order], shift[order], pair[order], (c - left)[order], (c + right + 1)[order]
    # what the windows of one function cover counts once
    by = np.lexsort((lo, f, group))
    cell = group[by] * FUNCTIONS + f[by]
    cell = np.cumsum(np.concatenate([[0], np.diff(cell) != 0])) << 32
    start, stop = cell + lo[by], np.maximum.accumulate(cell + hi[by])
    new = np.concatenate([[True], start[1:] > stop[:-1]])
    ends = np.append(np.flatnonzero(new)[1:] - 1, len(by) - 1)
    own = group[by][new] << 32
    at = np.concatenate([own + (start - cell)[new], own + (stop - cell)[ends]])
    at, inverse = np.unique(at, return_inverse=True)
    depth = np.cumsum(np.bincount(inverse, np.repeat([1, -1], len(own)), len(at)).astype(np.int64)) >= NEED
    turns = np.flatnonzero(np.diff(np.concatenate([[False], depth]).astype(np.int8)))  # every group ends at a depth of 0
    s, e = at[turns[::2]], at[turns[1::2]]
    s, e = (x[e - s >= LEAST] for x in (s, e))
    by = np.lexsort((shift, c, group))
    place = (group[by] << 32) + c[by]
    first, last = np.searchsorted(place, s), np.searchsorted(place, e) - 1
    some = first <= last
    s, e, first, last = s[some], e[some], by[first[some]], by[np.searchsorted(place, place[last[some]])]
    s, e = s & (MOST >> 32), e & (MOST >> 32)
    return pair[first], np.maximum(0, s - MARGIN), e + MARGIN, np.maximum(0, s + shift[first] - MARGIN), e + shift[last] + MARGIN


def grown(start: np.ndarray, stop: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches widened to the length of a passage, to the left first, as far as n tokens allow."""
    lacking = np.maximum(0, LEAST - (stop - start))
    left = np.minimum(start, lacking)
    return start - left, np.minimum(n, stop + lacking - left)


def ragged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from start to stop of every range, and the number of the range."""
    sizes = np.maximum(stop - start, 0)
    own = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(own)) + (start - (np.cumsum(sizes) - sizes))[own], own


class Tokens:
    """Tokens of one side of many candidates: their order by candidate and value, and where each came before."""

    def __init__(self, texts: list[np.ndarray]):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.begin, self.sizes = np.cumsum(sizes) - sizes, sizes
        self.of = np.repeat(np.arange(len(texts)), sizes)
        self.key = (self.of.astype(np.uint64) << np.uint64(32)) | np.concatenate(texts).astype(np.uint64)
        self.order = np.argsort(self.key, kind="stable")
        self.sorted = self.key[self.order]
        new = np.ones(len(self.sorted), dtype=bool)
        new[1:] = self.sorted[1:] != self.sorted[:-1]
        self.group = np.cumsum(new) - 1
        self.nth, self.before = np.empty(len(new), np.int64), np.full(len(new), -1)
        self.nth[self.order] = np.arange(len(new)) - np.flatnonzero(new)[self.group]
        again = np.flatnonzero(~new)
        self.before[self.order[again]] = self.order[again - 1]
        #: values that stand in a range for the first time in the candidate: never more than the range has
        self.fresh = np.concatenate([[0], np.cumsum(self.before < 0)])

    def kinds(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the distinct values of ranges, and the range of each."""
        at, own = ragged(start, stop)
        first = self.before[at] < start[own]
        return at[first], own[first]


def judged(xs: list[np.ndarray], ys: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The widest stretches of candidates that are similar enough: what is not splits at its widest gap.

    xs, ys: all tokens of both sides, none empty. A stretch reaches from its first to its last token in common, and further by tokens that
    are not, where it would be too short for a passage: a word changed near an end leaves none in common beyond it.
    Gives the number of the candidate, start and stop on either side, and the similarity. All open stretches of all candidates take a step at
    once; where the places in common are too few for the similarity, whatever they hold, they are not compared.
    """
    x, y = Tokens(xs), Tokens(ys)
    lo, hi = np.empty(len(x.key), np.int64), np.empty(len(x.key), np.int64)
    lo[x.order], hi[x.order] = np.searchsorted(y.sorted, x.sorted), np.searchsorted(y.sorted, x.sorted, "right")
    met = lo < hi
    hit = np.flatnonzero(met)
    place = y.order[np.minimum(lo + x.nth, hi - 1)[hit]]  # a token that comes again meets the next place of its like
    hits = np.concatenate([[0], np.cumsum(met)])
    spot = (y.group << 32) + y.order
    # the widest gap of a range, and of equal ones the first, from tables over powers of two
    gap = np.maximum(np.diff(hit), np.abs(np.diff(place)))
    tables = [(gap << 32) + (len(gap) - np.arange(len(gap)))]
    i, j = hits[x.begin], hits[x.begin + x.sizes]
    while 1 << len(tables) < int((j - i).max(initial=0)):
        w = 1 << len(tables) - 1
        tables.append(np.maximum(tables[-1][:-w], tables[-1][w:]))
    out = [[] for _ in range(6)]
    while True:
        keep = j - i >= LEAST // 2
        i, j = i[keep], j[keep]
        if not len(i):
            return tuple(np.concatenate([np.zeros(0, t), *v]) for v, t in zip(out, [np.int64] * 5 + [np.float64]))
        own = x.of[hit[i]]
        s, e = grown(hit[i] - x.begin[own], hit[j - 1] + 1 - x.begin[own], x.sizes[own])
        s2, e2 = grown(place[i] - y.begin[own], place[j - 1] + 1 - y.begin[own], y.sizes[own])
        p, q, p2, q2 = s + x.begin[own], e + x.begin[own], s2 + y.begin[own], e2 + y.begin[own]
        long = np.flatnonzero((e - s >= LEAST) & (e2 - s2 >= LEAST))
        most, least = hits[q[long]] - hits[p[long]], x.fresh[q[long]] - x.fresh[p[long]] + y.fresh[q2[long]] - y.fresh[p2[long]]
        long = long[7 * most >= 3 * least]
        (u, of_u), (_, of_v) = x.kinds(p[long], q[long]), y.kinds(p2[long], q2[long])
        there = met[u]
        u, of_c = u[there], of_u[there]
        next_ = np.searchsorted(spot, (y.group[lo[u]] << 32) + p2[long][of_c])
        next_ok = next_ < hi[u]
        of_c = of_c[next_ok][y.order[next_[next_ok]] < q2[long][of_c[next_ok]]]
        n, n2, common = (np.bincount(k, minlength=len(long)) for k in (of_u, of_v, of_c))
        share = common / np.maximum(1, n + n2 - common)
        good = share >= SIMILARITY
        for v, found in zip(out, (own[long], s[long], e[long], s2[long], e2[long], share)):
            v.append(found[good])
        open_ = np.ones(len(i), dtype=bool)
        open_[long[good]] = False
        i, j = i[open_], j[open_]
        level = np.frexp((j - i - 1).astype(float))[1] - 1
        cut = np.empty(len(i), dtype=np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            cut[at] = np.maximum(tables[k][i[at]], tables[k][j[at] - 1 - (1 << k)])
        cut = len(gap) - (cut & (MOST >> 32)) + 1
        i, j = np.concatenate([i, cut]), np.concatenate([cut, j])


RESULT = "doc_id long, other_id long, start long, n_words long, other_start long, other_n_words long, similarity double"


#: Pairs of windows that are looked at together, and tokens of both sides
WINDOW_PAIRS, BOTH_SIDES = 1 << 19, 1 << 19
#: Bytes of documents, and pairs of these, that a cell holds
CELL_BYTES, CELL_PAIRS = 32 << 20, 50_000
TURN_BYTES = 1 << 29


def candidates(rows: np.ndarray, others: np.ndarray, keys: pa.ListArray, windows: pa.ListArray) -> tuple[np.ndarray, ...]:
    """Candidate stretches (pair, start, stop, other start, other stop) of pairs of documents, given as rows of the lists; keys are in order."""
    begin, k, w = keys.offsets.to_numpy(), keys.values.to_numpy().view(np.uint64), windows.values.to_numpy()
    at = windows.offsets.to_numpy()
    mine, theirs, number, out, total = [], [], [], [[] for _ in range(5)], 0
    for n, (i, j) in enumerate(zip(rows.tolist(), others.tolist())):
        own, other = k[begin[i] : begin[i + 1]], k[begin[j] : begin[j + 1]]
        lo = np.searchsorted(other, own)
        times = np.searchsorted(other, own, "right") - lo
        some = np.flatnonzero(times)
        times = times[some]
        to = np.arange(times.sum()) + np.repeat(lo[some] - (np.cumsum(times) - times), times)
        mine.append(w[at[i] + np.repeat(some, times)]), theirs.append(w[at[j] + to]), number.append(np.full(len(to), n))
        total += len(to)
        if total >= WINDOW_PAIRS or n + 1 == len(rows):
            for v, found in zip(out, stretches(*map(np.concatenate, (number, mine, theirs)))):
                v.append(found)
            mine, theirs, number, total = [], [], [], 0
    return tuple(np.concatenate([np.zeros(0, np.int64), *v]) for v in out)


def verified(pairs: pa.Table, members: pa.Table) -> pa.Table:
    """Passages of the pairs of documents of a cell. members: doc_id, keys, windows and tokens of each document that stands in a pair."""
    members = members.combine_chunks().sort_by("doc_id").combine_chunks()
    known, ids, others = (t.column(c).to_numpy() for t, c in ((members, "doc_id"), (pairs, "doc_id"), (pairs, "other_id")))
    rows, other_rows = np.searchsorted(known, ids), np.searchsorted(known, others)
    keys, windows, held = (members.column(c).chunk(0) for c in ("keys", "windows", "tokens"))
    pair, start, stop, other_start, other_stop = candidates(rows, other_rows, keys, windows)
    held = [np.frombuffer(t.as_buffer(), np.uint32) for t in held]
    sizes = np.array([len(t) for t in held])
    stop, other_stop = np.minimum(stop, sizes[rows[pair]]), np.minimum(other_stop, sizes[other_rows[pair]])
    whole = np.flatnonzero((start < stop) & (other_start < other_stop))
    out = [[np.zeros(0, np.int64)] for _ in range(6)] + [[np.zeros(0)]]
    for a, b in batches((stop - start + other_stop - other_start)[whole].tolist(), BOTH_SIDES):
        part = whole[a:b]
        xs = [held[i][s:e] for i, s, e in zip(rows[pair[part]].tolist(), start[part].tolist(), stop[part].tolist())]
        ys = [held[i][s:e] for i, s, e in zip(other_rows[pair[part]].tolist(), other_start[part].tolist(), other_stop[part].tolist())]
        own, s, e, s2, e2, share = judged(xs, ys)
        own = part[own]
        for v, x in zip(out, (ids[pair[own]], others[pair[own]], start[own] + s, e - s + SIZE - 1, other_start[own] + s2, e2 - s2 + SIZE - 1, share)):
            v.append(x)
    names = ["doc_id", "other_id", "start", "n_words", "other_start", "other_n_words", "similarity"]
    return pa.table({n: np.concatenate(v) for n, v in zip(names, out)})


def verified_pairs(pairs: DataFrame, kept: DataFrame) -> list[DataFrame]:
    """Passages of pairs of documents, in tables that together hold all.

    Documents are dealt to blocks, and pairs to cells of two blocks; a document goes to each cell in which it has a pair once, not once for each
    pair. Cells are looked at in as many turns as keep what is on its way within twice the bytes of the documents that stand in pairs, or TURN_BYTES.
    """
    met = pairs.select(F.explode(F.array("doc_id", "other_id")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("pairs"))
    sizes = saved(kept.select("doc_id", (16 * F.size("keys") + F.octet_length("tokens")).alias("bytes")).join(met, "doc_id"), "sizes")
    size, ends = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0))).first()
    blocks = max(math.ceil(2 * size / CELL_BYTES), math.ceil(math.sqrt(ends / CELL_PAIRS)), math.ceil(math.sqrt(2 * spread(kept.sparkSession))))
    sent = sizes.agg(F.coalesce(F.sum(F.col("bytes") * F.least("pairs", F.lit(blocks))), F.lit(0))).first()[0]
    turns = math.ceil(sent / max(TURN_BYTES, 2 * size, 1))
    removed(sizes)
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    cells = pairs.select((F.least(block("doc_id"), block("other_id")) * blocks + F.greatest(block("doc_id"), block("other_id"))).alias("cell"), "doc_id", "other_id")
    out = []
    for turn in range(max(1, turns)):
        some = cells.filter(F.pmod(F.xxhash64("cell"), F.lit(turns)) == turn) if turns > 1 else cells
        members = some.select(F.col("cell").alias("at"), F.explode(F.array("doc_id", "other_id")).alias("doc_id")).distinct().join(kept, "doc_id")
        out.append(saved(some.groupBy("cell").cogroup(members.groupBy("at")).applyInArrow(verified, RESULT).distinct(), "passages"))
    return out


def copies_of(found: DataFrame) -> DataFrame:
    """(doc_id, part, start, n, other_id, other_start, n): stretches that stand word for word in an earlier place, with the first such place.

    Cores shorter than a passage are none: what lies around them decides whether they are part of one.
    """
    cores = found.select("doc_id", F.posexplode("cores").alias("part", "core")).select("doc_id", "part", "core.*").filter(F.col("n") >= LEAST)
    first = cores.groupBy("content", "n").agg(F.min(F.struct("doc_id", "start")).alias("f"))
    met = cores.join(first, ["content", "n"]).filter(F.struct("doc_id", "start") > F.col("f"))
    return met.select("doc_id", "part", "start", "n", F.col("f.doc_id").alias("other_id"), F.col("f.start").alias("other_start"))


def runs_of(found: DataFrame) -> DataFrame:
    """Links of passages that are one word over and over, to the first document with one of that word."""
    each = found.select("doc_id", F.explode("runs").alias("run")).select("doc_id", "run.*")
    first = each.groupBy("content").agg(F.min(F.struct("doc_id", "start", "n")).alias("f"))
    met = each.join(first, "content").filter(F.col("doc_id") > F.col("f.doc_id"))
    size = lambda c: (F.col(c) + SIZE - 1).alias("n_words")
    return met.select("doc_id", F.col("f.doc_id").alias("other_id"), "start", size("n"), F.col("f.start").alias("other_start"), size("f.n").alias("other_n_words"), F.lit(1.0).alias("similarity"))


def sides_of(found: DataFrame, copies: DataFrame) -> DataFrame:
    """Windows, without those of stretches that are copies, and tokens of the documents that have such. `found` is not needed further."""
    left = F.collect_set("part").alias("copied")
    kept = found.join(copies.groupBy("doc_id").agg(left), "doc_id", "left")
    x = F.filter(F.arrays_zip("keys", "windows", "parts"), lambda w: ~F.coalesce(F.array_contains("copied", w["parts"]), F.lit(False)))
    kept = saved(kept.select("doc_id", x.alias("x"), "tokens").filter(F.size("x") > 0).select("doc_id", F.col("x.keys").alias("keys"), F.col("x.windows").alias("windows"), "tokens"), "sides")
    removed(found)
    return kept


def hashes(kept: DataFrame) -> DataFrame:
    """(doc_id, key, f): the min-hashes of every document, and their functions; those of a document lie together by key."""
    first = F.filter(F.arrays_zip("keys", "windows"), lambda x, i: (i == 0) | (x["keys"] != F.get("keys", i - 1)))
    return kept.select("doc_id", F.explode(first).alias("x")).select("doc_id", F.col("x.keys").alias("key"), F.expr("shiftright(x.windows, 59)").alias("f"))


def ends(rows: DataFrame, column: str) -> DataFrame:
    """Rows of those keys that hold several values of the column, with the least of these."""
    same = Window.partitionBy("key")
    return rows.withColumns({"least": F.min(column).over(same), "last": F.max(column).over(same)}).filter("least < last").drop("last")


def enough(pairs: DataFrame) -> DataFrame:
    """(doc_id, other_id), the greater first, of rows of these and a function: pairs that NEED functions or more have brought."""
    pairs = pairs.groupBy(F.greatest("doc_id", "other_id").alias("doc_id"), F.least("doc_id", "other_id").alias("other_id"))
    pairs = pairs.agg(F.expr("bit_count(bit_or(shiftleft(1, int(f))))").alias("n"))
    return saved(pairs.filter(F.col("n") >= NEED).select("doc_id", "other_id"), "pairs")


def pairs_met(found: DataFrame, copies: DataFrame) -> list[DataFrame]:
    """Passages of every two documents that hold enough min-hashes in common, without stretches that are copies. `found` is not needed further."""
    kept = sides_of(found, copies)
    each = hashes(kept)
    pairs = enough(each.join(each.select("key", F.col("doc_id").alias("other_id")), "key").filter("doc_id > other_id"))
    passages = verified_pairs(pairs, kept)
    removed(pairs, kept)
    return passages


def one_of(passages: list[DataFrame]) -> DataFrame:
    out = passages[0]
    for part in passages[1:]:
        out = out.unionByName(part)
    return out


def pairs_apart(keys: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs of documents that hold enough min-hashes in common and that no chain of links connects so far.

    Only min-hashes of several such classes are looked at, and within them a document meets those of other classes alone.
    """
    label = F.coalesce("component", "doc_id").alias("label")
    known = components(links, "doc_id", "other_id")
    own = keys.join(known.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "key", "f", label)
    own = saved(ends(own, "label").drop("least"), "apart")
    reach = own.join(own.select("key", F.col("label").alias("to")).distinct(), "key").filter("to < label")
    pairs = enough(reach.join(own.select("key", F.col("label").alias("to"), F.col("doc_id").alias("other_id")), ["key", "to"]).select("doc_id", "other_id", "f"))
    removed(own)
    return pairs


def chained(found: DataFrame, copies: DataFrame, links: DataFrame) -> DataFrame:
    """Passages that connect, with the `links` of copies, what the passages of all pairs would connect. `found` is not needed further.

    First every document is judged with the least one of those that share its min-hashes, then with all that share enough and are not
    connected with it yet. So the pairs within a group of near copies are as many as its documents.
    """
    kept = sides_of(found, copies)
    keys = saved(ends(hashes(kept), "doc_id").withColumnRenamed("least", "other_id"), "keys")
    pairs = enough(keys.filter("doc_id > other_id").select("doc_id", "other_id", "f"))
    first = one_of(verified_pairs(pairs, kept))
    rest = pairs_apart(keys, links.unionByName(first.select("doc_id", "other_id")))
    passages = first.unionByName(one_of(verified_pairs(rest, kept)))
    removed(pairs, rest, keys, kept)
    return passages


def searched(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What `near_passages` and `passage_classes` begin with: windows, copies of stretches as links, all copies of stretches, copies of texts as links."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    rows = saved(docs.select("doc_id", F.regexp_count("text", F.lit(WORD)).alias("n"), F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")), "texts")
    classes = saved(rows.filter(F.col("n") >= WORDS).groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("first")), "classes")
    dealt, blocks, n_bytes = blocks_of(docs)
    chosen = classes.select(F.pmod(F.xxhash64(F.col("first")), F.lit(blocks)).cast("int").alias("block"), F.col("first").alias("chosen"))
    answers, buckets = census(dealt, int(n_bytes * KEYS_PER_BYTE) + 1, token_keys, chosen)
    both = answers.unionByName(chosen, allowMissingColumns=True)
    found = dealt.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(lambda table, answer: shared_windows(table, answer, buckets), CANDIDATES)
    found = saved(found, "windows")
    same = saved(copies_of(found), "copies")
    size = (F.col("n") + SIZE - 1).alias("n_words")
    linked = same.filter("doc_id > other_id").select("doc_id", "other_id", "start", size, "other_start", size.alias("other_n_words"), F.lit(1.0).alias("similarity"))
    zero, whole = F.lit(0).cast("long"), F.col("n").cast("long")
    copies = rows.join(classes, ["n", "h1", "h2"]).filter("doc_id > first")
    copies = copies.select("doc_id", F.col("first").alias("other_id"), zero.alias("start"), whole.alias("n_words"), zero.alias("other_start"), whole.alias("other_n_words"), F.lit(1.0).alias("similarity"))
    return found, saved(linked.unionByName(runs_of(found)).distinct(), "passages"), same, copies


def near_passages(docs: DataFrame) -> DataFrame:
    """Links from later documents to earlier ones that hold a near copy of a passage of 50 words or more.

    doc_id, other_id (a smaller doc_id), start and n_words of the passage in either, counted in words, and the Jaccard
    of their shingles. A document without such a passage gives no row; a text that equals an earlier one, word
    limits included, gives one row for the whole of it. Every two documents whose near copies have NEED min-hashes in common are linked (at a
    Jaccard of exactly 0.75 about 4 in 100 have fewer), with one exception, which the links tell: a stretch that stands word for word in an earlier document is linked to the first that has it, at a
    similarity of 1, and its further links are those of that document's stretch. So it is with a run of one word, 50 times or more, whatever the lengths.
    Null, empty and short texts have no passage, nor have rows without doc_id; of rows that repeat a doc_id none is
    linked to another, and of their texts the first in order is searched. An empty table gives an empty result.
    doc_id is an integer; only it and text are read.
    """
    found, linked, same, copies = searched(docs)
    more = pairs_met(found, same)
    removed(same)
    return one_of([linked, *more, copies])


def passage_classes(docs: DataFrame) -> DataFrame:
    """The class of every document: all documents that links of `near_passages` connect, however many links there are between.

    doc_id, class_id (the smallest doc_id that links reach, itself included), and one link of the document, null if it has none: other_id,
    start, n_words, other_start, other_n_words and similarity, as in `near_passages`, but to a later document too. It is the first in this order
    of those looked at: passages are judged until everything is connected, so a group of near copies costs as many pairs as it has documents
    and not their square. Pairs that are not connected otherwise are judged all, so no link between two classes is left out.
    Null, empty and short texts are classes of their own. One row for each doc_id; rows without one give none. An empty table gives an empty result.
    """
    found, linked, same, copies = searched(docs)
    copies = saved(copies, "copies")
    links = one_of([linked, chained(found, same, linked.select("doc_id", "other_id")), copies])
    known = components(links.select("doc_id", "other_id").distinct(), "doc_id", "other_id")
    names = ["other_id", "start", "n_words", "other_start", "other_n_words", "similarity"]
    turned = links.select(F.col("other_id").alias("doc_id"), F.col("doc_id").alias("other_id"), F.col("other_start").alias("start"), F.col("other_n_words").alias("n_words"), F.col("start").alias("other_start"), F.col("n_words").alias("other_n_words"), "similarity")
    one = links.unionByName(turned).groupBy("doc_id").agg(F.min(F.struct(*names)).alias("link"))
    known = known.select(F.col("node").alias("doc_id"), "component").join(one, "doc_id")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    removed(same)
    return ids.join(known, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("class_id"), *(F.col(f"link.{n}") for n in names))
