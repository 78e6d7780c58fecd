"""Suffix arrays by two-stage sorting, on arrays.

Suffixes smaller than their successor are sorted directly, by their bytes. All others follow from them:
buckets of first bytes are scanned in order, and each suffix found sends its predecessor, if that is larger,
to the next free place of the predecessor's bucket. A bucket is scanned as a whole, so the scan is a few
array operations for each pair of bytes that occurs. Order is by the first `depth` bytes at least.
"""

from __future__ import annotations

import numpy as np

from quarry.llm.decontaminate import block_words


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor: a run of one byte is decided by the byte after it."""
    n = len(text)
    if not n:
        return np.zeros(0, dtype=bool)
    last = np.flatnonzero(np.concatenate([text[1:] != text[:-1], [True]]))  # last place of every run
    after = np.append(text[np.minimum(last[:-1] + 1, n - 1)], 0)
    rising = after > text[last]
    rising[-1] = False
    return np.repeat(rising, np.diff(np.concatenate([[-1], last])))


def direct_sort(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by `depth` bytes, eight at a time; only ties are looked at again."""
    order = at[np.argsort(words[at], kind="stable")]
    value = words[order]
    group = np.concatenate([[0], np.cumsum(value[1:] != value[:-1])]) if len(order) else np.zeros(0, np.int64)
    n = len(words)
    for step in range(8, depth, 8):
        same = group[1:] == group[:-1]
        tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(tied):
            break
        pos, own = order[tied], group[tied]
        value = words[np.minimum(pos + step, n - 1)]
        again = np.lexsort((value, own))
        order[tied] = pos[again]
        value, own = value[again], own[again]
        split = np.zeros(len(group), dtype=np.int64)
        fresh = np.concatenate([[False], (own[1:] == own[:-1]) & (value[1:] != value[:-1])])
        split[tied[fresh]] = 1
        group = group + np.cumsum(split)
    return order


def suffix_array(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes in order of their first `depth` bytes.

    To induce a wanted suffix its successors are needed up to one that is sorted directly; these helpers are
    sorted along and left out of the result.
    """
    n = len(text)
    rising = smaller_than_next(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    stop = np.where(rising, np.arange(n), n - 1)
    until = np.minimum.accumulate(stop[::-1])[::-1]  # next directly sorted suffix
    needed = wanted.copy()
    marks = np.zeros(n + 1, dtype=np.int32)
    at = np.flatnonzero(wanted)
    np.add.at(marks, at, 1)
    np.add.at(marks, until[at] + 1, -1)
    needed |= np.cumsum(marks[:n]) > 0
    induced = needed & ~rising
    words = block_words(text, 8)
    direct = direct_sort(words, np.flatnonzero(needed & rising), depth)
    heads = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if needed[-1]:
        waiting[text[-1]].append(np.array([n - 1]))  # its successor is empty, smaller than all
    out = []
    for c in range(256):
        front = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waves = [front]
        while len(front):  # larger predecessors that begin with the same byte
            before = front[front > 0] - 1
            front = before[induced[before] & (text[before] == c)]
            waves.append(front)
        bucket = np.concatenate([*waves, direct[heads[c] : heads[c + 1]]])
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (text[before] > c)]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else []
        for a, b in zip(cuts, np.append(cuts[1:], len(first)) if len(first) else []):
            waiting[first[a]].append(before[a:b])
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix, at most `depth`, of each suffix with the one before it in the order; 0 for the first."""
    n = len(order)
    out = np.zeros(n, dtype=np.int64)
    words = block_words(text, 8)
    end = len(text) - 1
    live = np.arange(1, n)
    for step in range(0, depth, 8):
        a, b = order[live - 1], order[live]
        x = words[np.minimum(a + step, end)] ^ words[np.minimum(b + step, end)]
        differ = x != 0
        bits = np.frexp(x[differ].astype(np.float64))[1]
        # rounding up to a power of two can only occur within the leading byte's bits when they are all ones
        lead = (64 - bits) // 8
        exact = x[differ] >> (np.uint64(56) - (np.maximum(lead, 0) * 8).astype(np.uint64)) if len(lead) else x[differ]
        lead = np.where(exact == 0, lead + 1, lead)
        out[live[differ]] = step + np.clip(lead, 0, 8)
        live = live[~differ]
        if not len(live):
            break
    out[live] = depth
    return np.minimum(out, depth)
