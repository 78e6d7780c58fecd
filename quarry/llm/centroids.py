"""Clustering by rounds of nearest centroids, with lower bounds from pairs of pivots.

Vectors of integers meet k centroids. Ptolemy's inequality says that for two pivots p and s
|d(x,p) d(c,s) - d(x,s) d(c,p)| / d(p,s) is at most d(x,c). The pivots are starting vectors and stay the same, so the
distances from vectors to pivots are reckoned once and kept beside the vectors; a round only adds those from the few centroids to pivots.
Per vector the centroid of the least bound is measured first; others whose bound exceeds that distance are out. Bounds are
rounded down by more than floating point can err, and all that survive are measured in integers, so the result is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.storage import saved

DIMS, SCALE, K, ROUNDS, SEED = 64, 64, 16, 3, 1
PAIRS = 8
#: Components beyond this bound raise, as squared distances and sums of all vectors would leave 64 bits.
MOST = 1 << 26
BATCH = 4096
EPS = 2.0**-48


def quantised(vectors: DataFrame, vec_id: str, embedding: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, v): vectors of `dims` finite components as integers floor(scale * x); others are left out."""
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    x = lambda e: e.cast("double") * F.lit(float(scale))
    checked = lambda e: F.when(F.abs(x(e)) <= MOST, F.floor(x(e)).cast("int")).otherwise(F.raise_error(F.lit(f"component beyond {MOST} after scaling")).cast("int"))
    rows = vectors.filter((F.size(embedding) == dims) & F.coalesce(whole, F.lit(False)))
    return rows.select(F.col(vec_id).alias("vec_id"), F.transform(embedding, checked).alias("v"))


def draw(vec_id: str | Column, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(vec_id).cast("string")), 256)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, exact."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1) if len(b) else np.empty((len(a), 0), dtype=np.int64)


def lower_bounds(near: np.ndarray, centroid_near: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Lower bounds, vectors by centroids, of the distance; pivots 2j and 2j+1 are pair j.

    near: exact squared distances of vectors to pivots; centroid_near: of centroids to pivots; apart: of each pair.
    """
    x, c = np.sqrt(near.astype(np.float64)), np.sqrt(centroid_near.astype(np.float64))
    best = np.zeros((len(x), len(c)))
    for j, gap in enumerate(np.sqrt(apart.astype(np.float64)).tolist()):
        if gap == 0:
            continue
        one, two = np.outer(x[:, 2 * j], c[:, 2 * j + 1]), np.outer(x[:, 2 * j + 1], c[:, 2 * j])
        bound = (np.abs(one - two) - (one + two) * EPS) / gap * (1 - EPS)
        np.maximum(best, bound, out=best)
    return best


def nearest(v: np.ndarray, near: np.ndarray, centroids: np.ndarray, pivots: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each vector, ties to the smaller number; and how many distances were measured."""
    low = lower_bounds(near, squared(centroids, pivots), apart)
    guess = low.argmin(axis=1)
    distance = ((v - centroids[guess]) ** 2).sum(axis=1)
    open_ = low * low * (1 - EPS) <= distance[:, None].astype(np.float64) * (1 + EPS)
    open_[np.arange(len(v)), guess] = False
    cluster = guess.copy()
    for c in np.flatnonzero(open_.any(axis=0)).tolist():
        rows = np.flatnonzero(open_[:, c])
        d = ((v[rows] - centroids[c]) ** 2).sum(axis=1)
        better = (d < distance[rows]) | ((d == distance[rows]) & (c < cluster[rows]))
        distance[rows[better]], cluster[rows[better]] = d[better], c
    return cluster, distance, len(v) + int(open_.sum())


def pieces_of(tables, width: int, pivots: int):
    """Batches of (ids, vectors, pivot distances), BATCH rows at a time."""
    for t in tables:
        for start in range(0, t.num_rows, BATCH):
            part = t.slice(start, BATCH)
            at = lambda name: part.column(part.schema.names.index(name))  # noqa: B023, E731
            yield at("vec_id"), matrix(at("v"), width).astype(np.int64), matrix(at("near"), pivots)


def clustered(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = SEED, pairs: int = PAIRS
) -> DataFrame:
    """One row per vector kept: vec_id, cluster, distance, cluster_inertia, inertia, centroid (array<long>), centroid_sha256.

    Vectors with another number of components, or with a null or non-finite one, are left out, as is a null vector. The k
    vectors of smallest hash start; with fewer, each starts a centroid. Of vectors of equal hash (repeated rows) the one of
    smaller components comes first; vectors without vec_id are clustered but never start. A centroid without vectors stays.
    An empty table gives an empty one. A component beyond MOST after scaling raises an error. Other columns are not read.

    The vectors are written once to the shared folder with their pivot distances; each round reads them without a
    shuffle of vectors. k * dims sums reach the driver per round, and k centroids go out: both bounded by parameters.
    """
    spark = vectors.sparkSession
    type_ = vectors.schema[vec_id].dataType.simpleString()
    kept = quantised(vectors, vec_id, embedding, dims, scale)
    first = kept.filter("vec_id is not null").orderBy(draw("vec_id", seed), "v").limit(k).collect()  # k vectors
    schema = f"vec_id {type_}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r.v for r in first], dtype=np.int64)
    pivots = centroids[: 2 * pairs]
    pivots = np.concatenate([pivots, pivots[-1:]]) if len(pivots) % 2 else pivots
    apart = ((pivots[::2] - pivots[1::2]) ** 2).sum(axis=1)

    def measured(tables):
        for t in tables:
            v = matrix(t.column(t.schema.names.index("v")), dims).astype(np.int64)
            near = squared(v, pivots)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * len(pivots), pa.int32()), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*t.columns, flat], names=[*t.schema.names, "near"])

    kept = saved(kept.mapInArrow(measured, f"vec_id {type_}, v array<int>, near array<long>"), "vectors")
    for _ in range(rounds):
        centroids = moved(kept, centroids, pivots, apart)

    def assigned(tables):
        for ids, v, near in pieces_of(tables, dims, len(pivots)):
            cluster, distance, _ = nearest(v, near, centroids, pivots, apart)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    found = saved(kept.mapInArrow(assigned, f"vec_id {type_}, cluster int, distance long"), "clusters")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # k rows
    total = sum(r.cluster_inertia for r in sums)
    own = {r.cluster: r.cluster_inertia for r in sums}
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    about = [(c, own[c], total, row, sha(row)) for c, row in enumerate(centroids.tolist()) if c in own]
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")


def moved(kept: DataFrame, centroids: np.ndarray, pivots: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of the mean of each one's vectors, or as before without any."""
    k, dims = centroids.shape

    def totals(tables):
        sums, counts = np.zeros((k, dims), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for _, v, near in pieces_of(tables, dims, len(pivots)):
            cluster, _, _ = nearest(v, near, centroids, pivots, apart)
            np.add.at(sums, cluster, v)
            counts += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(counts)
        part = lambda x: pa.array(x, pa.int64())
        yield pa.RecordBatch.from_arrays([part(np.repeat(used, dims)), part(np.tile(np.arange(dims), len(used))), part(sums[used].ravel()), part(np.repeat(counts[used], dims))], names=["cluster", "axis", "total", "n"])

    sums = kept.mapInArrow(totals, "cluster long, axis long, total long, n long").groupBy("cluster", "axis").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in sums.collect():  # k * dims rows
        out[r.cluster, r.axis] = r.total // r.n
    return out
