"""Quality classifier by co-training.

Two views of a document are classified apart: its text (words, and how words end) and the metadata of its page
(source, language, length and layout ratios). Both start from the same labelled sample; in each round either
view labels the unlabelled documents it is sure of for the other one. The views are then calibrated on
labelled documents set aside, combined, and every document is scored.

Labelled documents are sampled, at most LABELLED by the hash of doc_id, and gathered as packed features. The others,
those with a label beyond the sample included, stay on Spark, all of them: each pass sums up the gradient, and a bound of the curvature, of every document
that the other view is sure of, and a view is fitted to the labelled sample and these sums. Scoring covers all.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.storage import removed, saved, spread
from quarry.llm.wordscan import BLANKS, NON_WORDS, Words, batches, byte_table, mix, texts_of

LABELLED = 8000
ROUNDS = 3
PASSES = 2  # over the unlabelled documents in a round
SURE = 0.97
HELD_OUT = 4  # every fourth labelled document is set aside
WORD_BITS = 18
END_BITS = 12
TEXT_SIZE = (1 << WORD_BITS) + (1 << END_BITS) + 256
NAME_SIZE = 128
RATIOS = 8
META_SIZE = 2 * NAME_SIZE + RATIOS
CLEAN_KEPT = 0.99
SLICE = 1 << 16
WORDS_TABLE, RAW_TABLE = byte_table(NON_WORDS), byte_table(BLANKS, lower=False)
CLASS = np.zeros(256, dtype=np.uint8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 punctuation, 5 blank, 6 line end
CLASS[33:127] = 4
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[list(BLANKS)], CLASS[10] = 1, 2, 3, 5, 6


def variety(distinct: int, total: int) -> int:
    """Feature of how often words repeat: share of distinct words in tenths, by the size of the text."""
    share = 10 * distinct // total if total else 0
    return (1 << WORD_BITS) + (1 << END_BITS) + 16 * min(total.bit_length(), 15) + share


def text_features(texts: list[bytes]) -> list[np.ndarray]:
    """Distinct feature numbers per text: hashed words, and the last two bytes of every token."""
    out = []
    for lo, hi in batches([len(t) for t in texts]):
        words, raw = Words(texts[lo:hi], WORDS_TABLE), Words(texts[lo:hi], RAW_TABLE)
        h = (words.hash(words.starts, words.ends) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        end = raw.bytes[raw.ends - 1].astype(np.uint64) << np.uint64(8)
        end |= np.where(raw.ends - raw.starts > 1, raw.bytes[np.maximum(raw.ends - 2, 0)], 0).astype(np.uint64)
        e = (mix(end) >> np.uint64(64 - END_BITS)).astype(np.int64) + (1 << WORD_BITS)
        for k in range(hi - lo):
            a, b = int(words.first[k]), int(words.count_to[k])
            c, d = int(raw.first[k]), int(raw.count_to[k])
            own = np.unique(h[a:b])
            out.append(np.concatenate([own, np.unique(e[c:d]), [variety(len(own), b - a)]]))
    return out


def name_number(name: str | None) -> int:
    value = np.uint64(sum((i + 1) * b for i, b in enumerate((name or "").encode())) + 1)
    return int(mix(np.array([value]))[0] % np.uint64(NAME_SIZE))


def meta_features(texts: list[bytes], sources: list, langs: list, lengths: list) -> np.ndarray:
    out = np.zeros((len(texts), META_SIZE), dtype=np.float32)
    for k, (t, s, g, n) in enumerate(zip(texts, sources, langs, lengths)):
        counts = np.bincount(CLASS[np.frombuffer(t, dtype=np.uint8)], minlength=7)
        size = max(1, len(t))
        n = len(t) if n is None else max(0, n)
        out[k, name_number(s)] = out[k, NAME_SIZE + name_number(g)] = 1
        out[k, 2 * NAME_SIZE :] = (*(counts[1:6] / size), counts[6] * 50 / size, np.log1p(n) / 10, counts[2] / max(1, counts[1] + counts[2]))
    return out


@dataclass
class View:
    """Weights, bias, and the scale and shift that calibrate its log-odds."""

    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return self.scale * raw + self.shift


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Sparse:
    """Rows of feature numbers, each present or not; features of few rows are left out when fitting.

    The features of all rows lie behind each other, and only where each row begins is held beside them. Sums go over SLICE entries at
    a time, in order, so the driver holds no further copy of all entries.
    """

    def __init__(self, rows: list[np.ndarray]):
        self.begin = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)])
        self.feature = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.n, self.size = len(rows), TEXT_SIZE

    @property
    def row(self) -> np.ndarray:
        """The row of every entry, made anew."""
        return np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.begin))

    def entries(self):
        """Rows and features of SLICE entries after SLICE entries."""
        for k in range(0, len(self.feature), SLICE):
            stop = min(k + SLICE, len(self.feature))
            lo, hi = np.searchsorted(self.begin, k, "right") - 1, np.searchsorted(self.begin, stop)
            yield np.repeat(np.arange(lo, hi), np.diff(np.clip(self.begin[lo : hi + 1], k, stop))), self.feature[k:stop]

    def times(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for row, feature in self.entries():
            np.add.at(out, row, w[feature].astype(np.float64, copy=False))
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size)
        for row, feature in self.entries():
            np.add.at(out, feature, r[row].astype(np.float64, copy=False))
        return out

    def norms(self) -> np.ndarray:
        return np.diff(self.begin)

    def held(self) -> np.ndarray:
        """How many rows have a feature."""
        out = np.zeros(self.size, np.int64)
        for _, feature in self.entries():
            out += np.bincount(feature, minlength=self.size)
        return out


class Dense:
    def __init__(self, rows: np.ndarray):
        self.rows, self.n, self.size = rows, len(rows), META_SIZE

    def times(self, w):
        return self.rows @ w

    def back(self, r):
        return self.rows.T @ r

    def norms(self):
        return self.rows.sum(axis=1)  # no feature is below 0

    def held(self):
        return np.full(self.size, np.inf)


@dataclass
class Pool:
    """Sums over the unlabelled documents that take part in fitting a view, where its weights are those of `at`.

    slope and bend: gradient, and a bound of the curvature, per feature and for the bias, which comes last; held:
    documents that have the feature; n: all.
    """

    slope: np.ndarray
    bend: np.ndarray
    held: np.ndarray
    n: float
    at: View


def fit(x, y: np.ndarray, weight: np.ndarray, pool: Pool | None = None, steps: int = 150, ridge: float = 0.3) -> View:
    """Logistic regression by steps scaled per feature; weight is 0 for rows that take no part.

    The documents of the pool have one weight, 1, or less where they would outweigh the rows.
    """
    n, held = x.n, x.held()
    if pool is not None and pool.n:
        share = min(1.0, weight.sum() / pool.n)
        n, held = n + share * pool.n, held + share * pool.held
        slope, bend, at = share * pool.slope, share * pool.bend, np.append(pool.at.weights, pool.at.bias)
    else:
        slope = bend = at = np.zeros(x.size + 1)
    use = held >= max(3, n // 1000)
    w, bias = np.zeros(x.size), 0.0
    seen, seen_bias = np.full(x.size, 1e-6), 1e-6
    for _ in range(steps):
        r = (sigmoid(x.times(w) + bias) - y) * weight
        g = (x.back(r) + slope[:-1] + bend[:-1] * (w - at[:-1]) + ridge * w) * use
        g_bias = r.sum() + slope[-1] + bend[-1] * (bias - at[-1])
        seen += g * g
        seen_bias += g_bias**2
        w -= 0.3 * g / np.sqrt(seen)
        bias -= 0.3 * g_bias / np.sqrt(seen_bias)
    return View(w.astype(np.float32), float(bias))


def line(columns: list[np.ndarray], y: np.ndarray, steps: int = 60) -> np.ndarray:
    """Coefficients and intercept of a small logistic regression, by Newton steps with a little ridge."""
    x = np.column_stack([*columns, np.ones(len(y))])
    beta = np.zeros(x.shape[1])
    beta[: len(columns)] = 1 / len(columns)
    for _ in range(steps):
        p = sigmoid(x @ beta)
        h = x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (p - y) + 0.05 * (beta - np.append(np.full(len(columns), 1 / len(columns)), 0)))
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


@dataclass
class Model:
    text: View
    meta: View
    mix: np.ndarray
    threshold: float

    def scores(self, raw_text: np.ndarray, raw_meta: np.ndarray):
        t, m = self.text.calibrated(raw_text), self.meta.calibrated(raw_meta)
        return sigmoid(t), sigmoid(m), sigmoid(self.mix[0] * t + self.mix[1] * m + self.mix[2])


def told(sides: tuple, past: list, sure: float) -> list[np.ndarray]:
    """Labels of unlabelled documents for the text view and the other: 1, 0, or -1 where nothing is sure."""
    labels = [np.full(x.n, -1) for x in sides]
    for views in past:
        p = [sigmoid(v.calibrated(x.times(v.weights) + v.bias)) for x, v in zip(sides, views)]
        for own, other in ((0, 1), (1, 0)):
            free = labels[other] < 0
            labels[other] = np.where(free & (p[own] >= sure), 1, np.where(free & (p[own] <= 1 - sure), 0, labels[other]))
    return labels


SUMS = [3 * (TEXT_SIZE + 1), 3 * (META_SIZE + 1)]


def partial_sums(tables, shared):
    """Slope, bend and held of both views, over the documents of a partition, in one row."""
    past, views, sure = shared.value
    total = [np.zeros(n) for n in SUMS]
    for batch in tables:
        if not batch.num_rows:
            continue
        text = Sparse([np.frombuffer(r, np.int32) for r in batch.column("text").to_pylist()])
        meta = Dense(np.frombuffer(b"".join(batch.column("meta").to_pylist()), np.float32).reshape(-1, META_SIZE))
        for t, x, v, y in zip(total, (text, meta), views, told((text, meta), past, sure)):
            part = (y >= 0).astype(float)
            r = (sigmoid(x.times(v.weights) + v.bias) - (y == 1)) * part
            bend = 0.25 * (x.norms() + 1) * part  # x x' is never above |x| diag(x)
            t += np.concatenate([z for u in (r, bend, part) for z in (x.back(u), [u.sum()])])
    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(total).tobytes()], pa.binary())], ["sums"])


def added(tables):
    """The sum of the rows of a partition, in one row; none for an empty partition."""
    total = None
    for batch in tables:
        for row in batch.column("sums").to_pylist():
            total = np.frombuffer(row) if total is None else total + np.frombuffer(row)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def pooled(others: DataFrame, past: list, views: list, sure: float) -> list[Pool | None]:
    """Sums for both views over all unlabelled documents."""
    shared = others.sparkSession.sparkContext.broadcast((past, views, sure))
    rows = others.select("text", "meta").mapInArrow(lambda t: partial_sums(t, shared), "sums binary")
    # added up on executors, a few partitions first, so that one row of fixed size reaches the driver
    few = rows.repartition(max(1, math.isqrt(spread(others.sparkSession)))).mapInArrow(added, "sums binary")
    row = few.repartition(1).mapInArrow(added, "sums binary").first()
    shared.destroy()
    if row is None:
        return [None, None]
    sums = np.frombuffer(row.sums)
    parts = [np.split(t, 3) for t in np.split(sums, [SUMS[0]])]
    return [Pool(slope, bend, held[:-1], float(held[-1]), v) for (slope, bend, held), v in zip(parts, views)]


def co_train(text: Sparse, meta: Dense, label: np.ndarray, others: DataFrame | None = None, rounds: int = ROUNDS, sure: float = SURE) -> Model | None:
    """label: 1 good, 0 bad; others: packed features of the unlabelled documents. None if a class is missing."""
    aside = np.zeros(len(label), dtype=bool)
    aside[::HELD_OUT] = True
    for part in (label[aside], label[~aside]):
        if not (0 < (part == 1).sum() < len(part)):
            return None

    def fitted(pools: list) -> list[View]:
        views = [fit(x, (label == 1).astype(float), (~aside).astype(float), pool) for x, pool in zip((text, meta), pools)]
        for x, v in zip((text, meta), views):
            v.scale, v.shift = line([(x.times(v.weights) + v.bias)[aside]], label[aside] == 1)
        return views

    views, past = fitted([None, None]), []
    for _ in range(rounds if others is not None else 0):
        past.append(views)
        for _ in range(PASSES):
            views = fitted(pooled(others, past, views, sure))
    raw_t = text.times(views[0].weights) + views[0].bias
    raw_m = meta.times(views[1].weights) + views[1].bias
    t, m = views[0].calibrated(raw_t), views[1].calibrated(raw_m)
    beta = line([t[aside], m[aside]], label[aside] == 1)
    model = Model(views[0], views[1], beta, 0.5)
    good = model.scores(raw_t[aside & (label == 1)], raw_m[aside & (label == 1)])[2]
    model.threshold = float(min(0.5, np.quantile(good, 1 - CLEAN_KEPT)))
    return model


def columns_of(batch) -> tuple[list[bytes], np.ndarray]:
    texts = texts_of(batch.column("text"))
    return texts, meta_features(texts, *(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")))


def packed(tables, without=None):
    """Packed features; documents of the broadcast `without` are left out."""
    for batch in tables:
        if without is not None:
            batch = batch.filter(pc.invert(pc.is_in(batch.column("doc_id"), without.value)))
        texts, meta = columns_of(batch)
        rows = [f.astype(np.int32).tobytes() for f in text_features(texts)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary()), pa.array([m.tobytes() for m in meta], pa.binary())],
            ["doc_id", "label", "text", "meta"],
        )


def docs_type(name: str) -> pa.DataType | None:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(name)


def sample(docs: DataFrame, labels: DataFrame, labelled: int):
    """Features and labels of at most so many labelled documents, and the packed features of all others.

    The texts of the others are not dealt for that: the ids of the sample, at most `labelled`, go to them.
    """
    judged = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    judged = judged.filter("doc_id is not null and q is not null")
    good = (F.col("q") == 1) & (F.coalesce("t", F.lit(0)) == 0)
    ids = docs.select("doc_id").distinct()
    mark = F.xxhash64("doc_id", F.lit("sample"))
    known = ids.join(judged, "doc_id").select("doc_id", good.cast("int").alias("label")).orderBy(mark, "doc_id").limit(labelled)
    one = F.min(F.struct("text", "source", "lang", "n_chars")).alias("row")  # of rows that repeat a doc_id the first in order
    rows = docs.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(one).select("doc_id", "label", "row.*")
    others = docs.withColumn("label", F.lit(-1)).select("doc_id", "label", "text", "source", "lang", "n_chars")
    type_ = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {type_}, label int, text binary, meta binary"
    found = rows.mapInArrow(packed, schema).toArrow()
    order = pc.sort_indices(found.column("doc_id"))  # the order alone is sorted, the features stay where they came in
    parts = lambda name, kind: (np.frombuffer(found.column(name)[i].as_buffer(), kind) for i in order.to_pylist())
    text = Sparse(list(parts("text", np.int32)))
    meta = np.zeros((len(order), META_SIZE), np.float32)
    for own, part in zip(meta, parts("meta", np.float32)):
        own[:] = part
    ids, labels_of = (found.column(c).take(order) for c in ("doc_id", "label"))
    without = docs.sparkSession.sparkContext.broadcast(pa.array(ids.to_pylist(), docs_type(type_)))
    return text, Dense(meta), np.array(labels_of.to_pylist(), dtype=np.int64), others.mapInArrow(lambda t: packed(t, without), schema)


def score(tables, shared):
    model = shared.value
    for batch in tables:
        texts, meta = columns_of(batch)
        if model is None:
            ones = np.ones(len(texts))
            p, q, s, kept = ones, ones, ones, ones > 0
        else:
            raw = np.array([model.text.weights[f].sum(dtype=np.float64) for f in text_features(texts)]) + model.text.bias
            p, q, s = model.scores(raw, meta @ model.meta.weights + model.meta.bias)
            kept = s >= model.threshold
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, (p, q, s, kept))], ["doc_id", "p_text", "p_meta", "score", "kept"])


def classified(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """One row per document: doc_id, p_text, p_meta, score, kept.

    Good documents are those labelled of quality 1 and not toxic. Null text, source and language count as
    empty, a null length as that of the text. Labels of documents that are not there, or without a quality,
    count for nothing; of several labels of one document the worse holds. Without labels of both classes
    everything is kept with score 1. Repeated rows are scored again, and without a label take part again; of those with one
    the first in order of text, source, lang and n_chars is learnt from. An empty table gives an empty result.
    Only doc_id, text, source, lang and n_chars are read.
    """
    docs = docs.select("doc_id", "text", "source", "lang", F.col("n_chars").cast("long").alias("n_chars"))
    text, meta, label, others = sample(docs, labels, labelled)
    model = None
    if len(np.unique(label)) == 2:
        others = saved(others, "features")
        model = co_train(text, meta, label, others)
        removed(others)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # TEXT_SIZE + META_SIZE numbers
    type_ = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(lambda t: score(t, shared), f"doc_id {type_}, p_text double, p_meta double, score double, kept boolean")
