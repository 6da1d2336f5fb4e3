"""Exact integer k-means over a LAESA pivot table.

Vectors are quantised to integers once and stored with their distances to a few fixed
pivots.  In every round a centroid costs one look at that table: by the triangle
inequality |d(v, p) - d(c, p)| is never more than d(v, c).  The centroid with the least
bound is measured first; the others are measured only where their bound does not exceed
that distance.  Measured distances are exact 64-bit integers, bounds carry a margin for
the rounding of their square roots, so pruning never changes a result.

Per round each task sends one sum and count per centroid and component; the driver holds
the k centroids and the pivots, nothing that grows with the vectors.

Defined cases: vectors of another length, or with a null, NaN or infinite component, are
left out; with fewer than k vectors left every one of them starts a centroid; rows that
repeat an id are separate vectors, ordered by their components where the hash ties; a
null id hashes as the empty text; an empty table gives an empty result; further columns
are ignored.  Components of 2^19 or more in size would overflow 64-bit distances and raise.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsanalytics.llm.catalogue import corpus_query
from opsanalytics.llm.store import saved, table

DIM, SCALE, K, ROUNDS, PIVOTS, SEED = 64, 256, 40, 5, 12, 2
LARGEST = 1 << 27  # of a quantised component: 64 squared differences stay below 2^62
MARGIN = 1e-9      # relative, of a difference of two rounded square roots


def quantised(vectors: DataFrame, id_col: str, vec_col: str, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): the usable vectors as integers floor(scale * x)."""
    x = F.col(vec_col).cast("array<double>")

    def whole(v):
        fits = F.when(F.abs(v * scale) < LARGEST, v * scale)
        return F.floor(fits.otherwise(F.raise_error(F.lit("component too large for 64-bit distances")).cast("double"))).cast("int")

    usable = (F.size("x") == dim) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), x.alias("x")).where(F.coalesce(usable, F.lit(False)))
    return rows.select("vec_id", F.transform("x", whole).alias("q"))


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors with the least hash of their id, in the order of the hashes."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    least = rows.select("q", F.sha2(name, 256).alias("h")).orderBy("h", "q").limit(k).collect()
    return np.array([r["q"] for r in least], np.int64)


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Pivots: the first point, then each time the point farthest from those taken."""
    taken = [0]
    near = squared(points, points[0])
    while len(taken) < min(n, len(points)):
        taken.append(int(near.argmax()))
        near = np.minimum(near, squared(points, points[taken[-1]]))
    return points[taken]


def squared(q: np.ndarray, point: np.ndarray) -> np.ndarray:
    d = q - point
    return np.einsum("ij,ij->i", d, d)


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype, copy=False).reshape(len(column), -1)


def _with_pivots(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            q = _matrix(batch.column("q"), np.int64)
            d = np.stack([np.sqrt(squared(q, p)) for p in pivots], axis=1)
            off = pa.array(np.arange(0, d.size + 1, d.shape[1], dtype=np.int32))
            lists = pa.ListArray.from_arrays(off, pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("q"), lists], names=["vec_id", "q", "d"])
    return run


def nearest(q: np.ndarray, d: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: the smaller number), its squared distance, and how many distances were measured."""
    n, k = len(q), len(centroids)
    c = np.stack([np.sqrt(squared(centroids, p)) for p in pivots], axis=1)
    low = np.zeros((n, k))
    for j in range(d.shape[1]):
        gap = np.abs(d[:, j, None] - c[None, :, j]) - MARGIN * (d[:, j, None] + c[None, :, j])
        np.maximum(low, gap, out=low)
    np.square(low, out=low)
    first = low.argmin(axis=1)
    best = np.empty(n, np.int64)
    for j in range(k):
        at = np.flatnonzero(first == j)
        best[at] = squared(q[at], centroids[j])
    at_best, measured = first.copy(), n
    # What was measured first keeps its place among ties by comparing numbers.
    for j in range(k):
        at = np.flatnonzero((low[:, j] <= best * (1 + MARGIN)) & (first != j))
        found = squared(q[at], centroids[j])
        measured += len(at)
        better = (found < best[at]) | ((found == best[at]) & (j < at_best[at]))
        best[at[better]], at_best[at[better]] = found[better], j
    return at_best, best, measured


SUMS = "cluster int, place int, total bigint, n bigint"
BLOCK = 4096


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray):
    for batch in batches:
        for i in range(0, len(batch), BLOCK):
            part = batch.slice(i, BLOCK)
            q = _matrix(part.column("q"), np.int64)
            at, dist, _ = nearest(q, _matrix(part.column("d"), np.float64), centroids, pivots)
            yield part, q, at, dist


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    """Sums and counts per centroid and component, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(centroids.shape, np.int64)
        n = np.zeros(len(centroids), np.int64)
        for _, q, at, _ in _assigned(batches, centroids, pivots):
            np.add.at(total, at, q)
            n += np.bincount(at, minlength=len(centroids))
        rows = np.flatnonzero(n)
        k, dim = len(rows), centroids.shape[1]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(rows, dim).astype(np.int32)), pa.array(np.tile(np.arange(dim, dtype=np.int32), k)),
            pa.array(total[rows].ravel()), pa.array(np.repeat(n[rows], dim))], names=["cluster", "place", "total", "n"])
    return run


def _final(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, at, dist in _assigned(batches, centroids, pivots):
            yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(dist)],
                                             names=["vec_id", "cluster", "distance"])
    return run


def moved(stored: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """One round: every centroid with vectors goes to floor(sum / count) of each component."""
    sums = (stored.mapInArrow(_sums(centroids, pivots), SUMS).groupBy("cluster", "place")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    out = centroids.copy()
    for r in sums:
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out


def clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dim: int = DIM, scale: int = SCALE,
             k: int = K, rounds: int = ROUNDS, n_pivots: int = PIVOTS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) per usable vector, final centroids in the order of their numbers)."""
    rows = quantised(vectors, id_col, vec_col, dim, scale)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), centroids
    pivots = far_apart(centroids, n_pivots)
    stored = saved(rows.mapInArrow(_with_pivots(pivots), "vec_id bigint, q array<int>, d array<double>"), "pivots")
    for _ in range(rounds):
        centroids = moved(stored, centroids, pivots)
    return saved(stored.mapInArrow(_final(centroids, pivots), "vec_id bigint, cluster int, distance bigint"), "clusters"), centroids


def report(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds the inertia of each cluster and of all, and the digest of each final centroid."""
    spark = found.sparkSession
    per = {r["cluster"]: int(r["s"]) for r in
           found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(per.values())
    rows = [(j, per.get(j), total, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for j, c in enumerate(centroids)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(  # one row per centroid
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    steps = [f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
           FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
e AS (SELECT r, unnest(range(1, {DIM + 1})) AS i, unnest(q) AS x FROM v),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS c FROM v),
c0 AS (SELECT c, i, x FROM s JOIN e USING (r) WHERE c < {K})"""]
    for n in range(ROUNDS + 1):
        steps.append(f"""
d{n} AS (SELECT e.r, c.c, sum((e.x - c.x) * (e.x - c.x))::BIGINT AS d FROM e JOIN c{n} c USING (i) GROUP BY e.r, c.c),
a{n} AS (SELECT r, c, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if n < ROUNDS:
            steps.append(f"""
m{n} AS (SELECT c, i, sum(x) AS t, count(*) AS k FROM a{n} JOIN e USING (r) GROUP BY c, i),
c{n + 1} AS (SELECT c, i, coalesce(((t - ((t % k) + k) % k) // k)::BIGINT, o.x) AS x FROM c{n} o LEFT JOIN m{n} USING (c, i))""")
    a, c = f"a{ROUNDS}", f"c{ROUNDS}"
    return ",".join(steps) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, h AS centroid_sha256
FROM {a} JOIN v USING (r) JOIN (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS h FROM {c} GROUP BY c) USING (c)
"""


@corpus_query("op13_laesa_clusters", _sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*clusters(table(spark, sf_dir, "embeddings")))
