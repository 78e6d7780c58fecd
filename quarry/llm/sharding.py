"""Shards of near equal bytes: the smallest capacity for which contiguous groups fit, then cuts there.

Atomic groups are the rows of one text, ordered by the hash of the text. A capacity is feasible if greedy
filling needs no more than the given number of shards; the smallest one is found by binary search. Group
sizes stay distributed: the driver sees sums over hash ranges, on which a capacity is surely feasible, surely
not, or undecided; ranges in which an undecided cut may fall are split again, the heaviest first, until none is
left. A pass brings at most 1.25 * NODES sums; ranges that no undecided cut can reach are added up between passes.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.storage import removed, saved
from quarry.llm.tables import whole

SHARDS = 8
NODES = 4096
SPLIT = 64  # ranges split in one pass, so that the condition stays short
SLOT_ROWS = 50_000
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def greedy(edges: np.ndarray, atomic: np.ndarray, largest: np.ndarray, capacity: int, shards: int):
    """Where each cut can fall: the lowest and highest prefix sum, and the ranges of nodes they lie in."""
    low = high = 0
    spans = []
    for _ in range(shards):
        i = int(np.searchsorted(edges, low + capacity, "right")) - 1
        j = int(np.searchsorted(edges, high + capacity, "right")) - 1
        n = len(atomic)
        if i < n:
            low = int(edges[i]) if atomic[i] else max(int(edges[i]), low + capacity - int(largest[i]) + 1)
        else:
            low = int(edges[n])
        high = min(high + capacity, int(edges[n])) if j < n and not atomic[j] else int(edges[min(j, n)])
        spans.append((min(i, n - 1), min(j, n - 1)))
        if low >= edges[-1]:
            break
    return low, high, spans


def smallest(edges, atomic, largest, shards: int) -> tuple[int, int]:
    """Largest capacity that surely fails plus one, and smallest that surely suffices."""
    total = int(edges[-1])

    def search(good) -> int:
        lo, hi = max(1, int(largest.max(initial=1)), -(-total // shards)), max(total, 1)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if good(mid) else (mid + 1, hi)
        return lo

    may = search(lambda c: greedy(edges, atomic, largest, c, shards)[1] >= total)
    must = search(lambda c: greedy(edges, atomic, largest, c, shards)[0] >= total)
    return may, must


def spread_for(spark: SparkSession, n: int) -> int:
    """Partitions for n rows as narrow as here: a session with many shuffle partitions would cut them into tiny tasks and files."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(n / SLOT_ROWS))


def ranged(groups: DataFrame, ranges: list[tuple[int, int, int]]) -> list:
    """Sums over parts of hash ranges (first, last, width), in order; at most one row per part.

    The few rows are sorted here: an ORDER BY would sample and deal them out once more in every pass.
    """
    pieces = [
        F.when(F.col("h").between(lo, hi), F.concat_ws(":", F.lit(str(k)), F.floor((F.col("h").cast("decimal(38,0)") - F.lit(lo).cast("decimal(38,0)")) / F.lit(w).cast("decimal(38,0)")).cast("string")))
        for k, (lo, hi, w) in enumerate(ranges)
    ]
    found = groups.withColumn("node", F.coalesce(*pieces)).filter("node is not null").groupBy("node")
    found = found.agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"), F.count("*").alias("n"))
    return sorted(found.coalesce(spread_for(groups.sparkSession, 0)).collect(), key=lambda r: r.lo)


def merged(parts: list[tuple], reach: set[int], split: set[int], finer: list[tuple]) -> list[tuple]:
    """Parts in order of hash: split ones replaced by finer ones, runs that no undecided cut can reach as one part."""
    out: list[tuple] = []
    at = 0
    for k, p in enumerate(parts):
        if k in split:
            while at < len(finer) and finer[at][0] <= p[1]:
                out.append(finer[at])
                at += 1
        elif out and k - 1 not in reach and k > 0 and k not in reach:
            q = out[-1]
            out[-1] = (q[0], p[1], q[2] + p[2], max(q[3], p[3]), q[4] + p[4])
        else:
            out.append(p)
    return out


def cut_points(groups: DataFrame, shards: int = SHARDS, nodes: int = NODES) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the first hash of every shard but the first.

    groups: (h, bytes), one row per group. An empty table gives capacity 0 and no cuts.
    """
    span = (HIGH - LOW + 1) // nodes
    parts = [tuple(r)[1:] for r in ranged(groups, [(LOW, HIGH, span)])]
    if not parts:
        return 0, []
    while True:
        sums = np.array([p[2] for p in parts], dtype=np.int64)
        edges = np.concatenate([[0], np.cumsum(sums)])
        largest = np.array([p[3] for p in parts], dtype=np.int64)
        atomic = np.array([p[4] == 1 for p in parts])
        may, must = smallest(edges, atomic, largest, shards)
        reach: set[int] = set()
        for (i, _), (_, j) in zip(greedy(edges, atomic, largest, may, shards)[2], greedy(edges, atomic, largest, must, shards)[2]):
            reach.update(range(i, j + 1))
        unsure = [k for k in reach if not atomic[k]]
        if not unsure:
            break
        split = sorted(unsure, key=lambda k: (-parts[k][2], k))[: max(1, min(SPLIT, nodes // 4))]
        room = max(2, nodes // len(split))
        finer = ranged(groups, [(parts[k][0], parts[k][1], -(-(parts[k][1] - parts[k][0] + 1) // room)) for k in split])
        parts = merged(parts, reach, set(split), [tuple(r)[1:] for r in finer])
    cuts, at = [], 0
    while True:
        i = int(np.searchsorted(edges, at + must, "right")) - 1
        if i >= len(parts):
            return must, cuts
        cuts.append(parts[i][0])
        at = int(edges[i])


def shard_of(h: Column, cuts: list[int]) -> Column:
    n = F.lit(0)
    for c in cuts:
        n = n + (h >= F.lit(c)).cast("int")
    return n


def slots(rows: DataFrame, n: int, key: str = "doc_id", tie: str = "h") -> DataFrame:
    """Adds `slot`, gapless from 0 within `shard`: the n rows are numbered in small lots, lots get offsets."""
    lots = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / SLOT_ROWS))
    lotted = rows.withColumn("lot", F.pmod(F.xxhash64(key), F.lit(lots)).cast("int"))
    few = spread_for(rows.sparkSession, lots * SHARDS)
    counts = lotted.groupBy("shard", "lot").agg(F.count("*").alias("n")).coalesce(few)
    before = F.expr("sum(n) over (partition by shard order by lot rows between unbounded preceding and 1 preceding)")
    offsets = counts.select("shard", "lot", F.coalesce(before, F.lit(0)).cast("long").alias("offset")).coalesce(few)
    number = F.expr(f"row_number() over (partition by shard, lot order by {key}, {tie})")
    return lotted.join(offsets, ["shard", "lot"]).withColumn("slot", number.cast("long") - 1 + F.col("offset")).drop("lot", "offset")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Size is the bytes of the text plus 1; a null text counts as the empty one. All rows of one text share a
    shard, repeated rows included. A group larger than the even share sets the capacity by itself. An empty
    table gives an empty result. Only doc_id and text are read.
    """
    body = whole("text")
    rows = docs.select(
        "doc_id",
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.xxhash64(body).alias("h"),
    )
    rows = saved(rows, "sizes")
    n = rows.count()
    few = spread_for(docs.sparkSession, n)
    groups = saved(rows.groupBy("h").agg(F.sum("size").alias("bytes")).coalesce(few), "groups")
    _, cuts = cut_points(groups, shards)
    removed(groups)
    placed = slots(rows.withColumn("shard", shard_of(F.col("h"), cuts)), n).coalesce(few)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )
