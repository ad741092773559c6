"""Hard negatives, embedding near-dedup and centroid clustering against brute force."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.llm import clustering as CL
from parley.llm import embedding_dedup as ED
from parley.llm import hard_negatives as HN

SCHEMA = ("vec_id bigint, embedding array<float>, label int, key string, slot int, norm string, place int, part int, block int, "
          "node string, n int, root string, cluster string, distance int, dim int, q int, score int, id int, rank int, vec int, w int")
@pytest.fixture(autouse=True)
def spread(spark):
    """Shuffle partitions stay apart, as on a cluster."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


NAN, INF = float("nan"), float("inf")

#: Nulls in any column, empty, zero, non-finite and short vectors, repeated rows, large and negative components.
ODD_VECTORS = [(900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [NAN] + [0.5] * 7, 1), (904, [INF] + [0.5] * 7, 2),
               (905, [None] + [0.5] * 7, 2), (906, [0.25] * 8, None), (None, [0.25] * 8, 1), (907, [0.25] * 8, 1), (907, [0.25] * 8, 1),
               (908, [0.5] * 8, 1), (909, [-0.25] * 8, 1), (910, [0.25] * 3, 1), (911, [0.25] * 3, 1), (912, [3e38] * 8, 1),
               (913, [1e-38] * 8, 1), (900, [0.125] * 8, 2), (1000, [0.25] * 8, 3), (1000, [0.25] * 8, 3)]


@pytest.fixture(scope="session")
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, k, "x", 1, "n", 2, 3, 4, "o", 5, "r", "c", 6, 7, 8, 9, 10, 11, 12, 13) for i, v, k in rows], SCHEMA)
    return make


def blobs(seed, n, dim=8, labels=3, spread=0.12, copies=0.1):
    """Clustered vectors, some exact copies; ids out of order."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((6, dim))
    x = (centre[rng.integers(0, 6, n)] + spread * rng.standard_normal((n, dim))).astype(np.float32)
    for i in np.flatnonzero(rng.random(n) < copies):
        x[i] = x[rng.integers(0, n)]
    return [(int(i), v.tolist(), int(k)) for i, v, k in zip(rng.permutation(n), x, rng.integers(0, labels, n))]


def finite(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


# ------------------------------------------------------------------ hard negatives
def brute_negatives(rows, anchor, k=5, m=5, low=80, high=100, scale=256):
    part = []
    for i, v, label in rows:
        if i is not None and label is not None and finite(v):
            q = [math.floor(scale * c) for c in v]
            if sum(c * c for c in q) < HN.NORM_LIMIT:
                part.append((i, label, q))
    out, done = [], set()
    for i, label, q in part:
        if not anchor(i) or (i, label, tuple(q)) in done:
            continue
        done.add((i, label, tuple(q)))
        dot = [(sum(a * b for a, b in zip(q, p)), j, other) for j, other, p in part if len(p) == len(q)]
        best = sorted((-s, j) for s, j, other in dot if other == label and j != i)[:k]
        for s, j in best:
            fits = sorted((-t, z) for t, z, other in dot if other != label and low * -s <= 100 * t <= high * -s)[:m]
            out += [(i, j, r, z, -s, -t) for r, (t, z) in enumerate(fits, 1)]
    return sorted(out)


def negative_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed,n,labels", [(1, 300, 3), (2, 120, 1), (3, 250, 40)])
def test_hard_negatives_equal_brute_force(vectors, monkeypatch, seed, n, labels):
    monkeypatch.setattr(HN, "PART_ROWS", 40)
    monkeypatch.setattr(HN, "BLOCK_BYTES", 300)
    rows = blobs(seed, n, labels=labels) + ODD_VECTORS
    got = HN.hard_negatives(vectors(rows), F.col("vec_id") % 10 == 0)
    assert negative_rows(got) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_ties_and_empty(vectors):
    rows = [(i, [0.5, 0.5], i % 2) for i in range(0, 40)]  # all scores tie
    got = HN.hard_negatives(vectors(rows), F.col("vec_id") % 7 == 0, positives=3, negatives=2)
    assert negative_rows(got) == brute_negatives(rows, lambda i: i % 7 == 0, 3, 2)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert HN.hard_negatives(vectors([]), F.col("vec_id") == 0).count() == 0
    assert HN.hard_negatives(vectors(rows), F.lit(None).cast("boolean")).count() == 0


def test_large_components_are_scored_exactly(vectors):
    rows = [(i, [float(20_000 + i), float(30_000 - i * i), 1.0 * i], i % 2) for i in range(30)]
    got = HN.hard_negatives(vectors(rows), F.col("vec_id") < 6)
    assert negative_rows(got) == brute_negatives(rows, lambda i: i < 6)


def test_score_bounds_hold_and_windows_are_skipped():
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((20, 16)) * 300
    x = np.floor(centre[rng.integers(0, 20, 2000)] + 8 * rng.standard_normal((2000, 16)))
    x[:5] = 0
    a, refs = x[rng.integers(0, 2000, 60)], x[rng.choice(2000, 16, replace=False)] + 1
    refs = refs / np.linalg.norm(refs, axis=1, keepdims=True)

    def angles(v):
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return np.arccos(np.clip(np.where(norm > 0, v @ refs.T / np.where(norm > 0, norm, 1), 0), -1, 1)).astype(np.float32).astype(float)

    norm = lambda v: np.linalg.norm(v, axis=1)
    for lo in range(0, 2000, 100):
        w = x[lo:lo + 100]
        down, up = HN.score_bounds(angles(a), norm(a), angles(w).min(0), angles(w).max(0), norm(w).min(), norm(w).max())
        s = a @ w.T
        assert (s >= down[:, None]).all() and (s <= up[:, None]).all()

    def part(v, **more):
        return pa.table({"vec_id": np.arange(len(v)), "label": ["l"] * len(v), "norm": norm(v), "q": HN.packed(v, "<i4"),
                         "angles": HN.packed(angles(v), "<f4"), **more})
    best, scored = HN.positives_of(part(x), part(a), 5)
    assert len(best.ids) == 5 * len(a) and scored < 0.5 * len(a) * len(x)


# ------------------------------------------------------------------ near-duplicate vectors
def brute_links(rows, threshold):
    def cosine(a, b):
        a, b = [x / max(map(abs, a)) for x in a], [x / max(map(abs, b)) for x in b]
        return math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(y * y for y in b))

    fine = [label is not None and finite(v) and any(v) for _, v, label in rows]
    near = [[j for j in range(len(rows)) if j != i and fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
             and cosine(rows[i][1], rows[j][1]) >= threshold] for i in range(len(rows))]
    out, part = [], {}
    for i in range(len(rows)):
        if i not in part:
            seen, todo = {i}, [i]
            while todo:
                for j in near[todo.pop()]:
                    if j not in seen:
                        seen.add(j)
                        todo.append(j)
            ids = [rows[j][0] for j in seen if rows[j][0] is not None]
            part |= dict.fromkeys(seen, min(ids) if ids else None)
        out.append((rows[i][0], len(near[i]), part[i], rows[i][0] == part[i]))
    return sorted(out, key=str)


def link_rows(df):
    return sorted((tuple(r) for r in df.select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


@pytest.mark.parametrize("seed,labels,group,small", [(1, 3, 1024, 24), (2, 1, 16, 4), (3, 2, 40, 10_000)])
def test_near_duplicate_vectors_equal_brute_force(vectors, monkeypatch, seed, labels, group, small):
    monkeypatch.setattr(ED.bucket_links, "__defaults__", (group,))
    monkeypatch.setattr(ED, "SMALL", small)
    rows = blobs(seed, 220, labels=labels, spread=0.2) + ODD_VECTORS
    got = link_rows(ED.near_duplicate_vectors(vectors(rows), threshold=0.97, tables=60, bits=6))
    assert got == brute_links(rows, 0.97)


def test_recall_at_the_threshold():
    """Pairs at cosine 0.93 exactly, the hardest that link, are found in at least one table with 0.99."""
    rng = np.random.default_rng(3)
    a = ED.unit_rows(rng.standard_normal((4000, 64)))
    b = rng.standard_normal((4000, 64))
    b = ED.unit_rows(b - (a * b).sum(1, keepdims=True) * a)
    b = 0.93 * a + math.sqrt(1 - 0.93 ** 2) * b
    assert (ED.signatures(a) == ED.signatures(ED.unit_rows(b))).any(axis=1).mean() > 0.99


def test_threshold_and_empty_table(vectors):
    assert ED.near_duplicate_vectors(vectors([])).count() == 0
    right = [(1, [1.0, 0.0], 1), (2, [0.75, math.sqrt(1 - 0.75 ** 2)], 1), (3, [4.0, 3.0], 2), (4, [4.0, 0.0], 2)]  # 3 and 4 at exactly 0.8
    got = {r[0]: r[1:] for r in link_rows(ED.near_duplicate_vectors(vectors(right), threshold=0.8, tables=200, bits=2))}
    assert got == {1: (0, 1, True), 2: (0, 2, True), 3: (1, 3, True), 4: (1, 3, False)}


def test_a_hot_group_sends_one_row_a_vector_and_bucket(vectors):
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(8) + 0.01 * rng.standard_normal(8)).tolist(), 0) for i in range(400)]
    got = link_rows(ED.near_duplicate_vectors(vectors(rows)))
    assert got == sorted(((i, 399, 0, i == 0) for i in range(400)), key=str)


# ------------------------------------------------------------------ clustering
def brute_clusters(rows, k=16, rounds=3, dim=64, scale=64):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v, _ in rows if finite(v) and len(v) == dim]
    kept = [(i, q) for i, q in kept if all(abs(c) < CL.component_limit(dim) for c in q)]
    key = lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes())
    centroids = [q for _, q in sorted(kept, key=key)[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        mine = [nearest(q)[1] for _, q in kept]
        for j in range(len(centroids)):
            own = [q for (_, q), c in zip(kept, mine) if c == j]
            if own:
                centroids[j] = [sum(c) // len(own) for c in zip(*own)]
    placed = [(i, *nearest(q)[::-1]) for i, q in kept]
    inertia = [sum(d for _, c, d in placed if c == j) for j in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), names[c]) for i, c, d in placed), key=str)


@pytest.mark.parametrize("seed,n,k", [(1, 200, 16), (2, 10, 16), (3, 90, 1)])
def test_clusters_equal_brute_force(vectors, seed, n, k):
    rows = blobs(seed, n) + ODD_VECTORS
    got = CL.cluster_report(vectors(rows), k=k, rounds=3, dim=8, scale=64)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(rows, k, dim=8)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_clusters_of_an_empty_table(vectors):
    assert CL.cluster_report(vectors([]), dim=8).count() == 0


def test_empty_clusters_stay(vectors):
    rows = [(i, [1.0, 1.0], 0) for i in range(20)]  # all centroids are equal: ties go to number 0
    got = CL.cluster_report(vectors(rows), k=4, dim=2).collect()
    assert {(r.cluster, r.distance, r.cluster_inertia) for r in got} == {(0, 0, 0)} and len(got) == 20


@pytest.mark.parametrize("seed", range(4))
def test_orchard_search_is_exact_and_looks_at_few(seed):
    rng = np.random.default_rng(seed)
    centre = rng.integers(-40, 40, (16, 3))
    x = centre[rng.integers(0, 16, 500)] + rng.integers(-2, 3, (500, 3))  # many ties
    best, near, looked = CL.orchard(x, centre)
    full = ((x[:, None, :] - centre[None]) ** 2).sum(-1)
    assert (best == full.argmin(1)).all() and (near == full.min(1)).all()
    assert looked < 0.75 * 16 * len(x)
