"""Centroid clustering whose assignment is an Orchard search.

Every centroid has a list of the other centroids by distance.  A vector starts at
one centroid and walks down that centroid's list.  A centroid that is closer (or as
close with a smaller number) becomes the current one, and the walk goes on at the
head of *its* list; centroids looked at are marked and not looked at again.  By the
triangle inequality a centroid beyond twice the current distance can't be closer or
as close, so the walk ends strictly beyond it.  All arithmetic is in integers, so
results don't depend on how rows are dealt.

Each round is one scan: tasks assign their rows and return at most one row of
counts and sums for each centroid, which Spark adds up.  The driver holds the
centroids (a parameter's number of them) and nothing else.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written
from .vectors import matrices, packed, vector_column


def component_limit(dim: int) -> int:
    """Scaled components below this have squared distances that fit a long (2^27 for 64 components)."""
    return math.isqrt((1 << 60) // max(dim, 1))


def quantised_vectors(df: DataFrame, dim: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, q``: ``floor(scale * x)`` of the vectors with exactly ``dim`` finite components, packed 32-bit integers."""
    def run(batches):
        for batch in batches:
            for rows, x in matrices(batch.column(1)):
                if x.shape[1] != dim:
                    continue
                with np.errstate(over="ignore"):
                    q = np.floor(scale * x)
                fits = (np.abs(q) < component_limit(dim)).all(1)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows[fits])), packed(q[fits], "<i4")], names=["vec_id", "q"])
        release()

    src = df.select(F.col(id_col).cast("bigint").alias("vec_id"), vector_column(df, vector_col).alias("q"))
    return src.mapInArrow(run, "vec_id bigint, q binary")


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid the others by distance (ties: smaller number first), and those squared distances."""
    gap = centroids[:, None, :] - centroids[None, :, :]
    between = np.einsum("ijk,ijk->ij", gap, gap)
    np.fill_diagonal(between, -1)  # itself first, then dropped
    order = np.argsort(between, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(between, order, axis=1)


def orchard(x: np.ndarray, centroids: np.ndarray, lists=None) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of every row of ``x``, and how many distances were worked out."""
    order, apart = lists or neighbour_lists(centroids)
    n, k = len(x), len(centroids)

    def distance(rows, to):
        gap = x[rows] - centroids[to]
        return np.einsum("ij,ij->i", gap, gap)

    best, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    near = distance(np.arange(n), best)
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    walking, looked = np.arange(n), n
    while len(walking):
        walking = walking[place[walking] < k - 1]
        at, where = best[walking], place[walking]
        # Ends strictly beyond twice the distance: squared, beyond four times (as quarters, so that nothing overflows).
        walking = walking[-(-apart[at, where] // 4) <= near[walking]]
        if not len(walking):
            break
        to = order[best[walking], place[walking]]
        place[walking] += 1
        fresh = ~seen[walking, to]
        rows, to = walking[fresh], to[fresh]
        seen[rows, to] = True
        d = distance(rows, to)
        looked += len(rows)
        closer = (d < near[rows]) | ((d == near[rows]) & (to < best[rows]))
        rows, to, d = rows[closer], to[closer], d[closer]
        best[rows], near[rows], place[rows] = to, d, 0
    return best, near, looked


STEP = 8192


def _integers(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<i4").reshape(len(column), -1).astype(np.int64)


def _assign(centroids: np.ndarray):
    lists = neighbour_lists(centroids)

    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, STEP):
                piece = batch.slice(part, STEP)
                best, near, _ = orchard(_integers(piece.column(1)), centroids, lists)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(best.astype(np.int32)), pa.array(near)],
                                                 names=["vec_id", "cluster", "distance"])
    return run


def _sums(centroids: np.ndarray):
    """Rows -> one row of count and componentwise sums for each centroid that the task's rows chose."""
    lists = neighbour_lists(centroids)

    def run(batches):
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros_like(centroids)
        for batch in batches:
            for part in range(0, batch.num_rows, STEP):
                x = _integers(batch.column(1).slice(part, STEP))
                best, _, _ = orchard(x, centroids, lists)
                count += np.bincount(best, minlength=len(centroids))
                for c in np.unique(best):
                    total[c] += x[best == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
            names=["cluster", "n", "s"])
    return run


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``<seed>:<vec_id>`` (a null id reads ``null``; ties by the vector)."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    rows = vectors.orderBy(order, "q").limit(k).collect()
    return np.array([np.frombuffer(r["q"], "<i4") for r in rows], np.int64)


def updated(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid with vectors becomes their componentwise floor of the mean."""
    dim = centroids.shape[1]
    parts = vectors.mapInArrow(_sums(centroids), "cluster int, n bigint, s array<bigint>")
    wide = F.lit(0).cast("decimal(38,0)")
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(
        *(F.sum(F.col("s")[i] + wide) for i in range(dim))).alias("s")).collect()  # at most one row a centroid
    out = centroids.copy()
    for r in rows:
        out[r["cluster"]] = [int(s) // r["n"] for s in r["s"]]
    return out


def centroid_clusters(df: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: int = 1,
                      id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` for each kept vector, and the centroids after ``rounds`` rounds.

    Kept are vectors with exactly ``dim`` components, none null or non-finite, and no
    scaled component of 2^27 or more (a squared distance must fit a long); other rows
    are left out.  Ties in distance go to the smaller centroid number.  With fewer than
    ``k`` kept vectors there are as many centroids as vectors; an empty table gives an
    empty result.  Repeated rows each count, a null id is an id like others, other
    columns are ignored.
    """
    vectors = quantised_vectors(df, dim, scale, id_col, vector_col)
    centroids = first_centroids(vectors, k, seed).reshape(-1, dim)
    if not len(centroids):
        return vectors.selectExpr("vec_id", "cast(null as int) cluster", "cast(null as bigint) distance").where("false"), centroids
    for _ in range(rounds):
        centroids = updated(vectors, centroids)
    return vectors.mapInArrow(_assign(centroids), "vec_id bigint, cluster int, distance bigint"), centroids


def cluster_report(df: DataFrame, **how) -> DataFrame:
    """Every kept vector with its cluster, distance, its cluster's and the whole inertia, and its centroid's SHA-256.

    Sums that don't fit a long are null.
    """
    placed, centroids = centroid_clusters(df, **how)
    placed = written(placed, "clusters")
    wide = F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(wide).collect()}  # one row a centroid
    fits = lambda v: v if v < 1 << 63 else None
    whole = fits(sum(sums.values()))
    rows = [(i, fits(sums.get(i, 0)), whole, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(centroids.tolist())]
    named = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(named), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


ORACLE = """
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS INTEGER) AS cluster, q AS c
  FROM kept QUALIFY row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) <= 16),
{rounds}
totals AS (SELECT cluster, sum(distance) AS s FROM a{last} GROUP BY cluster)
SELECT a.vec_id, a.cluster, a.distance, CAST(t.s AS BIGINT) AS cluster_inertia,
  CAST((SELECT sum(s) FROM totals) AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{last} a JOIN totals t USING (cluster) JOIN c{last} c USING (cluster)
"""
_ROUND = """
a{i} AS (
  SELECT rid, vec_id, q, r.k AS cluster, r.d AS distance FROM (
    SELECT rid, any_value(vec_id) AS vec_id, any_value(q) AS q, min({{'d': d, 'k': cluster}}) AS r FROM (
      SELECT kept.*, cluster,
        CAST(list_sum(list_transform(range(1, 65), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) AS BIGINT) AS d
      FROM kept, c{i}) p GROUP BY rid) g),"""
_MEANS = """
c{j} AS (
  SELECT c{i}.cluster, coalesce(m.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT cluster, u.i, CAST(sum(q[u.i]) AS BIGINT) AS s, count(*) AS n
      FROM a{i}, (SELECT unnest(range(1, 65)) AS i) u GROUP BY cluster, u.i) t GROUP BY cluster) m USING (cluster)),"""


def oracle(rounds: int = 3) -> str:
    """DuckDB SQL for the registered query: the rounds written out one after the other."""
    steps = "".join(_ROUND.format(i=i) + (_MEANS.format(i=i, j=i + 1) if i < rounds else "") for i in range(rounds + 1))
    return ORACLE.format(rounds=steps, last=rounds)
