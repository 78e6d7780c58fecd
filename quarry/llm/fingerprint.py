"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by how often they occur. For every sample each term draws two
gamma variables and a uniform one from its hash alone; they give the term a step of its weight and a score,
and the term with the lowest score is the sample, together with its step. Two texts agree in a sample with
a probability equal to their generalised Jaccard similarity. All of it is DataFrame expressions: terms are
counted within the row, exploded, and reduced by partial aggregates to one row per text before any shuffle.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.storage import saved
from quarry.llm.tables import hex_sha256, whole

SAMPLES = 24
RANGE_ROWS = 8192
MOST_RANGES = 1 << 16
MASK = (1 << 32) - 1


def hashes(text: Column, edited: bool) -> Column:
    """Word hashes whose lowest bit tells the text; a text without words has one term that stands for emptiness."""
    words = F.array_remove(F.split(text, r"[\x00-\x20]+"), "")
    words = F.when(F.size(words) == 0, F.array(F.lit(""))).otherwise(words)
    if edited:
        return F.transform(words, lambda w: F.xxhash64(w).bitwiseOR(F.lit(1)))
    return F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)))


def counted(at: Column, j: Column) -> Column:
    """(term, n0, n1) for the run of equal hashes that begins at `at` in the sorted array a: its counts in the
    text and in the edited text. p holds where runs begin; a term in both texts is two runs, of which the
    second counts nothing."""
    n = F.size("a")
    h, after = F.get("a", at), F.coalesce(F.get("p", j + 1), n)
    plain = h.bitwiseAND(F.lit(1)) == 0
    paired = F.get("a", after).eqNullSafe(h.bitwiseOR(F.lit(1)))
    done = (at > 0) & F.coalesce(F.get("a", at - 1) == h - 1, F.lit(False))
    n1 = F.when(plain, F.when(paired, F.coalesce(F.get("p", j + 2), n) - after).otherwise(0)).when(~done, after - at).otherwise(0)
    return F.struct(h.bitwiseAND(F.lit(-2)).alias("term"), F.when(plain, after - at).otherwise(0).alias("n0"), n1.alias("n1"))


def uniform(term: Column, draw: int) -> tuple[Column, Column]:
    """Two numbers in (0, 1) from the halves of one hash."""
    h = F.xxhash64(term, F.lit(draw))
    scale = F.lit(1.0 / (1 << 32))
    return (F.shiftrightunsigned(h, 32) + 0.5) * scale, (h.bitwiseAND(F.lit(MASK)) + 0.5) * scale


def samples_of(k: int) -> list[Column]:
    """Score and identity of a term in sample k, packed so that the least long is the sample; for both texts.

    With r, c from Gamma(2, 1) and b uniform: t = floor(ln w / r + b), and the score is
    ln c - r (t - b) - r. The upper half holds the score in order, the lower the hash of (term, t).
    The draws depend on the term alone, so both texts share them. A term that a text lacks gives null.
    """
    term = F.col("term")
    u1, u2 = uniform(term, 3 * k)
    v1, v2 = uniform(term, 3 * k + 1)
    b, _ = uniform(term, 3 * k + 2)
    r, log_c = -F.log(u1 * u2), F.log(-F.log(v1 * v2))
    out = []
    for w in ("w0", "w1"):
        step = F.floor(F.col(w) / r + b)
        order = F.greatest(F.least(log_c - r * (step - b) - r, F.lit(1000.0)), F.lit(-1000.0)) * F.lit(float(1 << 20))
        out.append(F.shiftleft(order.cast("long"), 32).bitwiseOR(F.xxhash64(term, step).bitwiseAND(F.lit(MASK))))
    return out


def signatures(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """One row per key: s0.. are the samples of the column body, e_s0.. those of the column edited."""
    both = F.concat(hashes(F.col("body"), False), hashes(F.col("edited"), True))
    rows = texts.select(*keys, F.sort_array(both).alias("a"))
    begins = F.filter(F.sequence(F.lit(0), F.size("a") - 1), lambda i: (i == 0) | (F.get("a", i) != F.get("a", i - 1)))
    terms = rows.select("*", begins.alias("p")).select(*keys, F.inline(F.transform("p", counted))).filter("n0 + n1 > 0")
    log = lambda n: F.when(F.col(n) > 0, F.log(F.col(n).cast("double")))
    terms = terms.select(*keys, "term", log("n0").alias("w0"), log("n1").alias("w1"))
    least = []
    for k in range(samples):
        for name, packed in zip((f"s{k}", f"e_s{k}"), samples_of(k), strict=True):
            least.append(F.min(packed).bitwiseAND(F.lit(MASK)).alias(name))
    return terms.groupBy(*keys).agg(*least)


def names(samples: int = SAMPLES) -> list[str]:
    return [f"s{k}" for k in range(samples)]


def similarity(a: list[Column], b: list[Column]) -> Column:
    """Share of samples in which two signatures agree."""
    same = reduce(lambda x, y: x + y, ((p == q).cast("int") for p, q in zip(a, b, strict=True)))
    return same / F.lit(float(len(a)))


def shown(samples: list[Column]) -> Column:
    return F.concat(*(F.lpad(F.lower(F.hex(s)), 8, "0") for s in samples))


def cuts(rows: DataFrame, ranges: int) -> list[int]:
    """Values of doc_id, ascending and distinct, that cut the rows into at most `ranges` ranges of about equal length."""
    shares = [k / ranges for k in range(1, ranges)]
    found = rows.agg(F.percentile_approx(F.col("doc_id").cast("long"), shares, max(10_000, 4 * ranges))).first()[0] if shares else None
    return sorted(set(found or []))


def place(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the value: first among every step-th one, then within the step."""
    step = max(1, math.isqrt(len(bounds)))
    coarse, fine = (F.lit(np.array(b, dtype=np.int64)) if b else F.array().cast("array<bigint>") for b in (bounds[::step], bounds))
    passed = F.size(F.filter(coarse, lambda b: b <= value)).cast("long")
    start = F.greatest(passed - 1, F.lit(0)) * step
    inside = F.size(F.filter(F.slice(fine, (start + 1).cast("int"), F.lit(step)), lambda b: b <= value))
    return F.when(value.isNotNull(), start + inside)


def in_order(docs: DataFrame) -> DataFrame:
    """Rows in descending doc_id, in ranges: rng and rn name a row, next_rng and next_rn the one that follows.

    Columns: rng, rn, next_rng, next_rn, doc_id, body, next_body. The last row is followed by the first. Rows of
    one doc_id follow each other by text; rows without doc_id come last, by a hash of the text in ranges of their
    own. Ranges are cut at quantiles of doc_id. One shuffle deals the texts by range; only the first text of every
    range crosses ranges.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", whole("text").alias("body"))
    ranges = min(MOST_RANGES, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS))
    rows = rows.withColumn("rng", F.coalesce(place(F.col("doc_id"), cuts(rows, ranges)), -1 - F.crc32(F.encode("body", "UTF-8")) % ranges))
    heads = rows.groupBy("rng").agg(F.max("doc_id").alias("doc_id"))
    line = F.lead(F.struct("rng", "doc_id")).over(Window.orderBy(F.desc("rng")))
    top = F.first(F.struct("rng", "doc_id")).over(Window.orderBy(F.desc("rng")))
    follows = heads.select("rng", F.coalesce(line, top).alias("after"))
    follows = F.broadcast(follows.select(F.col("rng").alias("of"), F.col("after.rng").alias("next_rng"), F.col("after.doc_id").alias("next_id")))
    # at most 2 * MOST_RANGES rows of three numbers are sent
    first = rows.join(follows, (F.col("rng") == F.col("next_rng")) & F.col("doc_id").eqNullSafe(F.col("next_id")))
    first = first.groupBy("of", "next_rng").agg(F.min("body").alias("head"))
    by = Window.partitionBy("rng").orderBy(F.desc("doc_id"), "body")
    rows = rows.select("*", F.row_number().over(by).alias("rn"), F.lead("body").over(by).alias("after"))
    rows = rows.join(first, rows.rng == first.of, "left")
    last = F.col("after").isNull()
    return rows.select(
        "rng",
        "rn",
        F.when(last, F.col("next_rng")).otherwise(F.col("rng")).alias("next_rng"),
        F.when(last, F.lit(1)).otherwise(F.col("rn") + 1).alias("next_rn"),
        "doc_id",
        "body",
        F.coalesce("after", "head").alias("next_body"),
    )


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text swaps the last third for the beginning of the next document. A null text counts as the
    empty one; texts without words all have the fingerprint of emptiness. A repeated row follows its twin. An
    empty table gives an empty result. Rows without doc_id follow all others. Only doc_id, an integer, and text
    are read.
    """
    rows = in_order(docs)
    n = F.length("body")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("body", F.lit(1), n - cut), F.substring("next_body", F.lit(1), cut))
    rows = rows.select("rng", "rn", "next_rng", "next_rn", "doc_id", n.cast("long").alias("n_chars"), "body", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", hex_sha256(F.col("edited")))
    keys = ["rng", "rn", "next_rng", "next_rn", "doc_id", "n_chars", "edited_sha256"]
    own = saved(signatures(rows, keys, samples), "samples")
    after = own.select(F.col("rng").alias("next_rng"), F.col("rn").alias("next_rn"), *(F.col(c).alias(f"n_{c}") for c in names(samples)))
    all_ = own.join(after, ["next_rng", "next_rn"])
    mine, theirs, next_ = ([F.col(p + c) for c in names(samples)] for p in ("", "e_", "n_"))
    return all_.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(mine).alias("fingerprint"),
        shown(theirs).alias("edited_fingerprint"),
        similarity(mine, theirs).alias("near_edited"),
        similarity(mine, next_).alias("near_next"),
    )
