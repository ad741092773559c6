"""Quality rules, quality classifier, fingerprints."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.cases import ODD
from parley.llm import digest as D
from parley.llm import quality_classifier as QC
from parley.llm import quality_rules as QR

SF = "/root/testdata/sf0.01"


def brute_statistics(text):
    text = text or ""
    w = text.encode().split()
    grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    hit = [False] * len(w)
    for k in range(len(w) - 2):
        if grams[tuple(w[k:k + 3])] > 1:
            hit[k:k + 3] = [True] * 3
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), sum(hit))


def some_texts(seed):
    rnd = random.Random(seed)
    out = []
    for _ in range(200):
        words = [rnd.choice(["ä", "the", "x#", "|", "<b>", "wörd", "aa", "$$"]) for _ in range(rnd.randint(0, 60))]
        out.append("".join(w + rnd.choice([" ", "  ", "\n", "\n\n", "\t"]) for w in words))
    return out


def test_statistics_equal_brute_force():
    texts = some_texts(1) + [t for _, t in ODD]
    got = QR.rule_statistics([(t or "").encode() for t in texts])
    assert [tuple(r) for r in got.tolist()] == [brute_statistics(t) for t in texts]


def test_repeats_with_a_large_vocabulary():
    words = np.random.default_rng(0).integers(0, 1 << 22, 500)
    ids = np.concatenate((words, words[100:110], words[:3]))
    big = QR._repeat_words(ids, 1 << 22, np.array([len(ids)]))
    _, small = np.unique(ids, return_inverse=True)
    assert big == QR._repeat_words(small, 600, np.array([len(ids)])) == 26


def test_forest_scores_strangers_higher():
    rng = np.random.default_rng(1)
    x = np.concatenate((rng.normal(size=(2000, 4)), rng.normal(loc=9, size=(20, 4))))
    f = QR.fit_forest(x, (0, 1, 2, 3))
    s = f.scores(x)
    assert s[2000:].min() > np.quantile(s[:2000], 0.99)
    # a path length by hand: the depth of a leaf and what an average tree adds below it
    t = QR.Forest(np.array([[0, -1, -1]]), np.array([[0.5, 0, 0]]), np.array([[1, 0, 0]]), np.array([[0, 1.0, 3.0]]), 2.0, (0,))
    assert t.scores(np.array([[0.2], [0.7]])) == pytest.approx([2 ** -0.5, 2 ** -1.5])


def test_rules_on_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = QR.quality_rules(docs, QR.fit_rules(docs, labels)).join(labels, "doc_id").toPandas()
    passed = out[~out.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.98 and passed[passed.quality == 0].kept.mean() < 0.1
    assert not out[out.base_failed].kept.any()


def test_rules_on_odd_rows(spark, odd, frame):
    got = QR.quality_rules(odd, None).collect()
    want = sorted(((i, *brute_statistics(t)) for i, t in ODD), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=str) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed)
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (None, 1, 0), (8, 0, None), (7, None, 1)], "doc_id bigint, quality int, toxic int")
    forests = QR.fit_rules(odd, labels)
    assert QR.quality_rules(odd, forests).count() == len(ODD)
    assert QR.fit_rules(odd, labels.where("false")) is None and QR.fit_rules(odd.where("false"), labels) is None
    assert QR.quality_rules(odd.where("false"), forests).count() == 0


def test_rules_are_fitted_on_all_labelled_rows(spark, frame):
    """Thresholds are exact quantiles over every clean row, and trees draw among all of them."""
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["ab", "abc", "d#", "efgh", f"w{rnd.randint(0, 999)}"]) for _ in range(60)) for _ in range(400)]
    n = 24_000
    docs = spark.range(n).withColumn("text", F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % len(texts) + 1).cast("int"))).withColumnRenamed("id", "doc_id")
    labels = docs.select("doc_id", (F.col("doc_id") % 50 != 0).cast("int").alias("quality"))
    x = QR.features(QR.rule_statistics([t.encode() for t in texts]))
    forests = QR.fit_rules(docs, labels)
    clean = np.array([i % len(texts) for i in range(n) if i % 50])
    for f in forests:
        assert f.threshold == np.quantile(f.scores(x)[clean], 1 - QR.CLEAN_LOSS, method="higher")
    rows = docs.join(labels.withColumnRenamed("quality", "label"), "doc_id")
    samples = QR.tree_samples(QR.append_statistics(rows, ["doc_id", "label"]), len(clean), n - len(clean), trees=8)
    assert [len(s) for s in samples] == [QR.TREE_ROWS] * 8 and len({s.tobytes() for s in samples}) == 8


# ----------------------------------------------------------------- classifier
def test_votes_equal_brute_force():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "b!", "C", "dd", "e|", "12"], 40)) .encode() for _ in range(300)]
    label = rng.integers(0, 2, 200).astype(float)
    model = QC.fit_vectors(texts[:200], label, dimensions=8)
    got = model.scores(texts[200:], QC.Terms())
    for t, s in zip(texts[200:], got):
        v = QC.term_shares([t], QC.Terms())[0] @ model.project
        cosine = model.vectors @ (v / np.linalg.norm(v))
        near = np.argsort(-cosine, kind="stable")[:QC.NEIGHBOURS]
        w = np.maximum(cosine[near], 0) ** 2
        assert s == pytest.approx((w * model.label[near]).sum() / w.sum(), abs=1e-3)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = QC.fit_classifier(docs, labels, ~QC.held_out(F.col("doc_id")))
    out = QC.quality_scores(docs, model).join(labels, "doc_id").where(QC.held_out(F.col("doc_id"))).toPandas()
    good, bad = out[out.quality == 1].score, out[out.quality == 0].score
    assert len(bad) >= 10 and out.score.between(0, 1).all()
    assert np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad]) > 0.97
    assert (out.predicted == out.quality).mean() > 0.95


def test_classifier_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1), (8, 0), (7, 0), (None, 1), (6, None)], "doc_id bigint, quality int")
    model = QC.fit_classifier(odd, labels, F.lit(True))
    got = QC.quality_scores(odd, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in ODD)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    empty = [r.score for r in got if r.doc_id in (1, 2, 3)]
    assert empty == [model.prior] * 3
    assert all(r.score == 0.5 for r in QC.quality_scores(odd, QC.fit_classifier(odd, labels.where("false"), F.lit(True))).collect())
    assert QC.quality_scores(odd.where("false"), model).count() == 0


def test_shapes():
    assert QC.shape(b"Ab12!!") == b"Aa0!" and QC.shape("été".encode()) == b"a" and QC.shape(b"|") == b"|"


# --------------------------------------------------------------- fingerprints
def test_entropy_of_every_window():
    rng = np.random.default_rng(0)
    for n in (0, 5, 31, 32, 33, 200):
        x = rng.integers(97, 103, n).astype(np.uint8)
        got = D.entropy_bins(x)
        assert len(got) == max(0, n - 31)
        for i, b in enumerate(got):
            total = sum(int(D._TERM[c]) for c in Counter(x[i:i + 32].tolist()).values())
            assert b == D.BINS - total * D.BINS // D._TERM[32]


def test_votes_for_the_rarest_window():
    rng = np.random.default_rng(2)
    bins = [rng.integers(0, 30, n).astype(np.int16) for n in (0, 3, 63, 64, 65, 400)]
    ranks = np.arange(D.BINS + 1)
    for b, got in zip(bins, D.select_features(bins, ranks)):
        votes = np.zeros(len(b), int)
        for i in range(len(b) - D.NEIGHBOURS + 1):
            votes[i + int(np.argmin(b[i:i + D.NEIGHBOURS]))] += 1
        if len(b):
            votes[int(np.argmin(b))] += D.NEIGHBOURS
        assert got.tolist() == np.flatnonzero(votes >= D.VOTES).tolist()


def test_likeness():
    ranks = np.arange(D.BINS + 1)
    rnd = random.Random(1)
    text = lambda n: "".join(rnd.choice("abcdefghij \n") for _ in range(n)).encode()
    a, b = text(9000), text(9000)
    fa, fb, mixed, none = D.fingerprint([a, b, a[:6000] + b[:3000], b""], ranks)
    assert len(fa) > 1 and D.likeness(fa, fa) == 1.0 and D.likeness(none, none) == 1.0 and D.likeness(fa, none) == 0.0
    assert D.likeness(fa, fb) < 0.1 < 0.4 < D.likeness(fa, mixed) < 1


def brute_digest(rows, ranks):
    rows = sorted(rows, key=lambda r: (D.LAST if r[0] is None else r[0], (r[1] or "").encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[:len(t) - half] + nxt[:half]
        fa, fe, fn = D.fingerprint([x.encode() for x in (t, new, nxt)], ranks)
        out.append((i, len(t), sha256(new.encode()).hexdigest(), fa.tobytes().hex(), fe.tobytes().hex(),
                    round(D.likeness(fa, fe), 9), round(D.likeness(fa, fn), 9)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [400, 20_000, 1 << 24])
def test_digests_with_the_next_document(spark, frame, chunk):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 10_000), " ".join(rnd.choice(["wörd", "xy", "the", "ß"]) for _ in range(rnd.randint(0, 60)))) for _ in range(150)]
    df = frame(rows).repartition(3)
    ranks = D.rarity_ranks(df.select("text"))
    got = D.document_fingerprints(df, chunk_bytes=chunk).collect()
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=str) == brute_digest(rows, ranks)


@pytest.mark.parametrize("far", [(1 << 53) + 1, (1 << 63) - 500, -(1 << 63)])
def test_digests_of_large_ids(frame, far):
    rnd = random.Random(3)
    rows = [(far + 3 * i, " ".join(rnd.choice(["one", "two", "three"]) for _ in range(rnd.randint(0, 40)))) for i in range(40)] + [(None, "no id")]
    df = frame(rows).repartition(4)
    ranks = D.rarity_ranks(df.select("text"))
    got = D.document_fingerprints(df, chunk_bytes=300).collect()
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=str) == brute_digest(rows, ranks)


def test_digests_of_odd_rows(odd, frame):
    ranks = D.rarity_ranks(odd.select("text"))
    got = D.document_fingerprints(odd, chunk_bytes=60_000).collect()
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got), key=str) == brute_digest(ODD, ranks)
    assert D.document_fingerprints(odd.where("false")).count() == 0
    assert D.document_fingerprints(frame([(3, "alone " * 30)])).collect()[0].near_next == 1.0


def test_classifier_fit_brings_no_texts_to_the_driver(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen, collect = [], type(docs).toPandas

    def to_pandas(df):
        seen.append(df.columns)
        return collect(df)

    monkeypatch.setattr(type(docs), "toPandas", to_pandas)
    model = QC.fit_classifier(docs, labels, F.lit(True))
    monkeypatch.undo()
    assert seen == [["label", "terms", "shares"]]
    rows = (QC.labelled_sample(docs, labels, "quality", F.lit(True), QC.SAMPLE)
            .orderBy("label", F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).toPandas())
    want = QC.fit_vectors([t.encode() for t in rows["text"]], rows["label"].to_numpy())
    assert np.array_equal(model.label, want.label) and model.prior == want.prior
    assert np.allclose(model.vectors @ model.vectors.T, want.vectors @ want.vectors.T, atol=1e-3)
