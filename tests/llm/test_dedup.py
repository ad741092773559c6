"""Substring dedup and SimHash near-dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm.cases import ODD
from parley.llm import simhash as SH
from parley.llm import substring_dedup as SD
from parley.llm.components import components

BIG = 1 << 70


def brute_substring(rows, window=13):
    """Row by row: (doc_id, n_words, n_removed, kept)."""
    key = lambda i: BIG if i is None else i
    first: dict = {}
    words = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            first[g] = min(first.get(g, BIG + 1), key(i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < key(i):
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def passages(seed, n=120):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)]
    shared = [[rnd.choice(vocabulary) for _ in range(rnd.randint(10, 60))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randint(0, len(words))
            part = rnd.choice(shared)
            words[at:at] = part[rnd.randint(0, 5):]
        if rnd.random() < 0.2:
            words += [rnd.choice(["the", "a"])] * rnd.randint(5, 40)  # runs
        rows.append((rnd.randint(0, n), rnd.choice([" ", "\n", "\t "]).join(words)))
    return rows


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,window,chunk", [(1, 13, 3000), (2, 13, 1 << 24), (3, 5, 700), (4, 2, 2000), (5, 1, 4000)])
def test_substring_equals_brute_force(frame, seed, window, chunk):
    rows = passages(seed)
    got = SD.substring_dedup(frame(rows), window=window, chunk_bytes=chunk, bucket_bytes=2 * chunk)
    assert rows_of(got) == sorted(brute_substring(rows, window), key=str)


def test_substring_odd_rows(odd, frame):
    rows = ODD + [(11, "one two three " * 10), (None, "one two three " * 10)]
    assert rows_of(SD.substring_dedup(frame(rows))) == sorted(brute_substring(rows), key=str)
    assert SD.substring_dedup(odd.where("false")).count() == 0


def test_substring_spans_and_untidy_texts(frame):
    same = " ".join(f"p{k}" for k in range(20))
    rows = [(1, f"{same}\n  own   words"), (2, f"start {same} middle {same} end"), (3, "left \n as it is")]
    got = {r.doc_id: r for r in SD.substring_dedup(frame(rows), keep=("doc_id", "source"), tidy=False).collect()}
    assert [tuple(x) for x in got[2].removed] == [(1, 20), (22, 20)] and got[2].kept == "start middle end"
    assert got[3].kept == "left \n as it is" and got[1].kept == rows[0][1] and got[1].source == "s"


@pytest.mark.parametrize("far", [1 << 53, (1 << 63) - 200, -(1 << 63)])
def test_substring_large_ids(frame, far):
    rows = [(far + i, t) for i, t in passages(7, 60)]
    assert rows_of(SD.substring_dedup(frame(rows), chunk_bytes=900, bucket_bytes=2000)) == sorted(brute_substring(rows), key=str)


def test_substring_chunks_hold_few_bytes_whatever_the_ids(frame):
    """Null and equal ids and long texts are spread over chunks of bounded bytes."""
    long = " ".join(f"v{k % 700}" for k in range(4000))
    rows = [(None, f"{long} {i}") for i in range(6)] + [(7, f"seven {i} " * 40) for i in range(30)] + [(i, f"{long} x{i}") for i in range(4)]
    packed = frame(rows).coalesce(1).selectExpr("doc_id", "text").mapInArrow(SD._pack_text(5000), "chunk bigint, rows binary, data binary, kept binary")
    sizes = [[int(v) for v in np.frombuffer(r["rows"], np.int64).reshape(2, -1)[1]] for r in packed.collect()]
    assert len(sizes) > 12 and all(len(s) == 1 or sum(s) <= 5000 for s in sizes) and sum(map(len, sizes)) == len(rows)
    assert rows_of(SD.substring_dedup(frame(rows), chunk_bytes=5000)) == sorted(brute_substring(rows), key=str)


def test_substring_kept_columns(frame):
    rows = [(1, "a b"), (2, "c")]
    got = SD.substring_dedup(frame(rows), keep=("doc_id", "doc_id", "bucket", "score"))
    assert got.columns == ["doc_id", "bucket", "score", "n_words", "n_removed", "kept", "removed"] and got.count() == 2
    with pytest.raises(ValueError, match="kept"):
        SD.substring_dedup(frame(rows).withColumn("kept", F.lit(1)), keep=("doc_id", "kept"))


def test_word_names():
    """One name a word wherever it stands; words apart by one byte, by length or by order have names of their own."""
    words = [b"ab", b"ba", b"a", b"aa", b"a" * 64, b"a" * 65, b"a" * 128 + b"b", b"a" * 129, b"b" + b"a" * 128, b"x" * 4096, b"x" * 4097, b"x" * 5000,
             "é".encode(), b"\x85", b"\x00", b"\x00\x00"]
    texts = [b" ".join(words), b"", b" \n\t", *(b"  " + w + b"\x0b" for w in words)]
    a, b, counts = SD._names(texts)
    assert counts.tolist() == [len(t.split()) for t in texts]
    n = len(words)
    assert (a[:n] == a[n:]).all() and (b[:n] == b[n:]).all() and len(set(a.tolist())) == n == len(set(b.tolist()))
    assert [len(x) for x in SD._names([])] == [0, 0, 0]


def test_equal_contexts_give_equal_symbols():
    rnd = np.random.default_rng(0)
    core = rnd.integers(0, 9, 60).astype(np.uint64)
    a = np.concatenate((rnd.integers(0, 9, 17).astype(np.uint64), core, rnd.integers(0, 9, 5).astype(np.uint64)))
    keys = []
    for h, at in ((a, 17), (core, 0)):
        name, lo, hi = SD._keys(SD.mix(h), np.array([len(h)]), 13, 3)
        inside = (lo >= at) & (hi < at + 60)
        keys.append({(int(n), int(x) - at) for n, x in zip(name[inside], lo[inside])})
    assert keys[1] <= keys[0] and keys[1]


# ------------------------------------------------------------------ SimHash
def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[k:k + shingle]) for k in range(len(words) - shingle + 1)] if len(words) >= shingle else \
        [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(fps, bits=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(fps))]


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_roots(fps)
    least: dict = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(least.get(r, BIG), i)
    return [(i, f, least.get(r)) for (i, _), f, r in zip(rows, fps, roots)]


def near_rows(df):
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in df.collect()), key=str)


def near_texts(seed, n=150):
    rnd = random.Random(seed)
    base = [[f"t{rnd.randint(0, 999)}" for _ in range(rnd.randint(60, 200))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = f"t{rnd.randint(0, 999)}"
        rows.append((i, " ".join(words)))
    return rows


def test_near_duplicates_equal_brute_force(frame):
    rows = near_texts(3)
    assert near_rows(SH.near_duplicates(frame(rows))) == sorted(brute_components(rows), key=str)


def test_near_duplicates_odd_rows(odd):
    assert near_rows(SH.near_duplicates(odd)) == sorted(brute_components(ODD), key=str)
    assert SH.near_duplicates(odd.where("false")).count() == 0


@pytest.mark.parametrize("group", [8192, 7])
def test_links_connect_all_close_fingerprints(spark, group):
    rnd = random.Random(5)
    fps = {rnd.getrandbits(64) for _ in range(40)}
    for f in list(fps)[:20]:
        for _ in range(25):
            for _ in range(rnd.randint(1, 4)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    edges = [(r.u % (1 << 64), r.v % (1 << 64)) for r in SH.links(df, group=group).collect()]
    assert all((u ^ v).bit_count() <= 64 for u, v in edges)
    at = {f: k for k, f in enumerate(fps)}
    want = brute_roots(fps)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        x, y = find(at[u]), find(at[v])
        root[max(x, y)] = min(x, y)
    assert [find(k) for k in range(len(fps))] == want


def test_one_of_each_keeps_the_smallest(frame, odd):
    rows = near_texts(4)
    least = {c for _, _, c in brute_components(rows)}
    out = SH.one_of_each(frame(rows))
    assert {r.doc_id for r in out.collect()} == least and out.columns[:2] == ["doc_id", "text"]
    got = [(r.doc_id, r.text) for r in SH.one_of_each(odd).collect()]
    assert len(got) == len(set(brute_roots([brute_fingerprint(t) for _, t in ODD])))


def test_components_of_a_long_path(spark):
    rnd = random.Random(1)
    ids = rnd.sample(range(10_000), 300)
    edges = [(a, b) for a, b in zip(ids, ids[1:])] + [(20_000, 20_001), (5, 5)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert {v for k, v in got.items() if k < 20_000} == {min(ids)} and len(got) == 300
    assert got[20_001] == 20_000
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_query_digest(spark):
    from parley.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(sf + "/documents.parquet").collect()]
    got = QUERIES["op1_substring_dedup"](spark, sf)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = [(i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k in brute_substring(rows)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    got = QUERIES["op2_simhash_near_dedup"](spark, sf)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()) == sorted(
        (i, f"{f:016x}", c) for i, f, c in brute_components(rows))


def test_one_of_each_keeps_columns_of_any_name(frame):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (3, "x"), (3, "x"), (None, "x")]
    names = ["__id", "__hash", "__n", "__first", "__first_hash", "id", "hash", "n", "row", "fp", "root", "component_id"]
    docs = frame(rows).selectExpr("*", *(f"{77 + k} AS `{c}`" for k, c in enumerate(names)))
    got = SH.one_of_each(docs)
    assert got.columns == docs.columns and got.count() == 2
    assert all([r[c] for c in names] == list(range(77, 77 + len(names))) for r in got.collect())
