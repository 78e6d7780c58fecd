"""How many documents hold a key, told back to where the key came from.

Several operators turn every document into many 64-bit keys and care only for keys that other documents
hold too. A census answers that with little traffic:

1. documents are dealt into blocks by the hash of doc_id; a block sends its distinct keys with the number of
   its documents that hold them, packed into one binary per key bucket: 4 bytes and a count for each key;
2. a bucket adds the counts up and returns, packed in the same order, how many documents hold each key;
3. the block makes its keys again and lays the counts beside them.

A key that a third of all documents hold is sent once per block. A block has a row for each bucket in which it
has keys, so there are never more rows than keys, however many blocks and buckets a corpus has. 32 bits of a key stand beside its bucket,
and buckets hold about BUCKET_KEYS keys however large the corpus, so keys are confused with a chance of
BUCKET_KEYS / 2^32; that can only raise a count, never hide a shared key.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.storage import spread
from quarry.llm.wordscan import texts_of

BLOCK_BYTES = 2 << 20
BUCKET_KEYS = 1 << 21
MOST = 65535

#: From the texts of a block to (keys, index of the text each key belongs to).
KeyMaker = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def blocks_of(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """Documents with a block number, the number of blocks, and the bytes of all texts."""
    n_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(spread(docs.sparkSession), math.ceil(n_bytes / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block")
    return docs.select(block, "doc_id", "text"), blocks, n_bytes


def ordered(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Documents of a block in one order however they arrive: by doc_id, then text."""
    ids = table.column("doc_id").combine_chunks().to_numpy(zero_copy_only=False)
    texts = texts_of(table.column("text"))
    order = sorted(range(len(texts)), key=lambda i: (ids[i], texts[i]))
    return ids[order], [texts[i] for i in order]


class Ledger:
    """Distinct keys of a block by bucket, and where they stand among all its keys."""

    def __init__(self, keys: np.ndarray, doc: np.ndarray, buckets: int):
        order = np.lexsort((doc, keys))
        k, d = keys[order], doc[order]
        new_key = np.ones(len(k), dtype=bool)
        new_key[1:] = k[1:] != k[:-1]
        new_pair = new_key.copy()
        new_pair[1:] |= d[1:] != d[:-1]
        number = np.cumsum(new_key) - 1
        self.inverse = np.empty(len(k), dtype=np.int64)
        self.inverse[order] = number
        self.keys = k[new_key]
        self.counts = np.bincount(number[new_pair], minlength=len(self.keys)) if len(k) else np.zeros(0, np.int64)
        bucket = ((self.keys & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        self.by_bucket = np.argsort(bucket, kind="stable")
        own = bucket[self.by_bucket]
        cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
        ends = np.append(cuts[1:], len(own))
        #: buckets that hold a key of the block, and where their keys stand in by_bucket
        self.ranges = dict(zip(own[cuts].tolist(), zip(cuts.tolist(), ends.tolist())))

    def packed(self) -> pa.Table:
        high = (self.keys >> np.uint64(32)).astype(np.uint32)
        counts = np.minimum(self.counts, MOST).astype(np.uint16)
        parts = [(b, self.by_bucket[i:j]) for b, (i, j) in self.ranges.items()]
        return pa.table(
            {
                "bucket": pa.array([b for b, _ in parts], pa.int32()),
                "keys": pa.array([high[i].tobytes() for _, i in parts], pa.binary()),
                "counts": pa.array([counts[i].tobytes() for _, i in parts], pa.binary()),
            }
        )

    def told(self, answer: pa.Table) -> np.ndarray:
        """Documents that hold each of the block's keys, in the order the keys were made."""
        total = np.ones(len(self.keys), dtype=np.uint16)
        for b, counts in zip(answer.column("bucket").to_pylist(), answer.column("counts").to_pylist()):
            if b is None:
                continue
            i, j = self.ranges[b]
            total[self.by_bucket[i:j]] = np.frombuffer(counts, dtype=np.uint16)
        return total[self.inverse]


def added(table):
    """One bucket: the counts of equal keys of all blocks, returned block by block."""
    parts = [np.frombuffer(x, dtype=np.uint32) for x in table.column("keys").to_pylist()]
    counts = np.concatenate([np.frombuffer(x, dtype=np.uint16) for x in table.column("counts").to_pylist()])
    keys = np.concatenate(parts)
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    sums = np.add.reduceat(counts[order].astype(np.int64), np.flatnonzero(new))
    total = np.empty(len(keys), dtype=np.uint16)
    total[order] = np.minimum(sums, MOST)[np.cumsum(new) - 1].astype(np.uint16)
    ends = np.cumsum([len(p) for p in parts])
    answers = [total[e - len(p) : e].tobytes() for p, e in zip(parts, ends)]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "counts": pa.array(answers, pa.binary())})


def census(docs: DataFrame, n_keys: int, make: KeyMaker, only: DataFrame | None = None) -> tuple[DataFrame, int]:
    """Counts per (block, bucket), and the number of buckets.

    docs: (block, doc_id, text). only: (block, chosen), the doc_ids that count, if not all.
    """
    buckets = max(spread(docs.sparkSession), math.ceil(n_keys / BUCKET_KEYS))

    def send(key, table):
        _, texts = ordered(table)
        keys, doc = make(texts)
        packed = Ledger(keys, doc, buckets).packed()
        return packed.add_column(0, "block", pa.array([key[0].as_py()] * len(packed), pa.int32()))

    def send_only(key, table, chosen):
        ids, texts = ordered(table)
        keep = np.flatnonzero(picked(ids, chosen))
        keys, doc = make([texts[i] for i in keep])
        packed = Ledger(keys, doc, buckets).packed()
        return packed.add_column(0, "block", pa.array([key[0].as_py()] * len(packed), pa.int32()))

    schema = "block int, bucket int, keys binary, counts binary"
    if only is None:
        sent = docs.groupBy("block").applyInArrow(send, schema)
    else:
        sent = docs.groupBy("block").cogroup(only.groupBy("block")).applyInArrow(send_only, schema)
    return sent.groupBy("bucket").applyInArrow(added, "block int, bucket int, counts binary"), buckets


def picked(ids: np.ndarray, chosen: pa.Table) -> np.ndarray:
    """True for the first row of every chosen doc_id (ids are sorted)."""
    first = np.ones(len(ids), dtype=bool)
    first[1:] = ids[1:] != ids[:-1]
    wanted = chosen.column("chosen").drop_null().combine_chunks().to_numpy(zero_copy_only=False)
    return first & np.isin(ids, wanted.astype(np.int64))
