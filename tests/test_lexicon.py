"""The in-row lexicon sums: equal to the scorer by exploded tokens, and without an exchange of tokens."""

import random

import pytest
from pyspark.sql import functions as F

from parley.functions import lexicon as L
from parley.operators import features as FE
from parley.operators import sentiment as N

WORDS = ["good", "Good", "GOOD", "bad", "not", "NOT", "very", "VERY", "barely", "but", "slow", "ok", "it's", "Straße", "STRASSE",
         "ΟΔΌΣ", "οδός", "Élan", "ÉLAN", "x2", "42", "İyi", "!", "??", "?!", "-", " ", "\t", "😀", "", "\x1c", "a.b", "d'or"]
LISTS = dict(negators=["not"], boosters=["very"], dampeners=["barely"])
LEXICON = [("good", 2.0), ("bad", -2.0), ("slow", -1.0), ("élan", 1.5), ("οδός", -0.5), ("x2", 0.7), ("nil", 0.0)]


@pytest.fixture(scope="module")
def rules(spark):
    return N.sentiment_rules(spark, LEXICON, **LISTS)


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(5)
    rows = [(i, 0, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 12)))) for i in range(800)]
    rows += [(900, 0, None), (901, 0, ""), (902, 0, "GOOD VERY"), (903, 0, "nil"), (904, 0, "good good"), (904, 0, "BAD!!!!! ok"),
             (None, 0, "good"), (905, None, "good"), (906, 0, "x" * 300 + " good\nbad"), (907, 0, "good " * 3000)]
    return spark.createDataFrame(rows, "call_id bigint, pos int, text string")


def test_in_row_sums_equal_exploded_tokens(spark, rules, texts, monkeypatch):
    monkeypatch.setattr(L, "STEP_CHARS", 500)
    key = lambda d: {(r.call_id, r.pos): (r._s, r._e) for r in d.collect()}
    in_row = N.text_sums(spark, rules)
    got = key(texts.select("call_id", "pos", in_row("text").alias("x")).where("x.s IS NOT NULL").groupBy("call_id", "pos")
              .agg(F.sum("x.s").alias("_s"), F.max("x.e").alias("_e")))
    want = key(N._hit_sums(texts, ["call_id", "pos"], F.col("text"), rules))
    assert len(want) > 500 and set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9), k


def test_words_equal_the_library_count(spark, rules, texts):
    from parley.functions.text import word_count
    in_row = N.text_sums(spark, rules)
    assert texts.select(in_row("text").words.alias("a"), word_count("text").alias("b")).where("a <> b OR a IS NULL").collect() == []


def test_turn_features_of_repeated_and_null_keys(spark, rules, texts, monkeypatch):
    """Rows of one call and position share the score of their texts, as by the join on both; null keys score 0."""
    turns = texts.withColumn("speaker", F.lit("AGENT")).withColumn("n_turns", F.lit(1)).withColumn("prev_speaker", F.lit(None).cast("string"))
    pick = lambda: {r.call_id: r for r in FE.turn_table_features(turns, rules).collect()}
    got = pick()
    monkeypatch.setattr(FE, "text_sums", lambda *a: None)
    monkeypatch.setattr(N, "text_sums", lambda *a: None)
    want = pick()
    assert set(got) == set(want) and got[None].mean_sentiment == 0.0 and got[905].mean_sentiment == 0.0
    for k, r in want.items():
        assert list(got[k].asDict().values())[1:] == pytest.approx(list(r.asDict().values())[1:], abs=1e-9, nan_ok=True)


def test_turn_features_read_texts_once_and_shuffle_no_tokens(spark, rules, texts):
    turns = texts.withColumn("speaker", F.lit("AGENT")).withColumn("n_turns", F.lit(1)).withColumn("prev_speaker", F.lit(None).cast("string"))
    plan = FE.turn_table_features(turns, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Generate" not in plan and "Join" not in plan


def test_entries_of_several_tokens_keep_the_pattern(spark):
    assert N.text_sums(spark, N.sentiment_rules(spark, [("kiss of death", -2.0), ("good", 1.0)])) is None


def test_texts_of_single_bytes_go_apart_and_score_the_same(spark, monkeypatch):
    rows = [("good", 2.0, 1, 0, 0.0, 0), ("élan", 1.5, 1, 0, 0.0, 0), ("οδός", -0.5, 1, 0, 0.0, 0), ("µ", 0.3, 1, 0, 0.0, 0),
            ("not", 0.0, 0, 1, 0.0, 0), ("very", 0.0, 0, 0, 0.293, 0), ("but", 0.0, 0, 0, 0.0, 1)]
    rnd, rules = random.Random(3), L.Rules(rows)
    words = [*WORDS, "µ", "²", "\x85", "\xa0", "ÿ", "goodness"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 9))) for _ in range(500)] + [None, "", "good", "x" * 400]
    sizes, whole = [], L._sums
    monkeypatch.setattr(L, "_sums", lambda part, r: (sizes.append(L._bytes("".join(part)) is not None), whole(part, r))[1])
    got = L.text_sums(texts, rules)
    assert set(sizes) == {True, False}
    monkeypatch.setattr(L, "_bytes", lambda text: None)
    want = L.text_sums(texts, rules)
    assert got[2].sum() > 100 and (got[2] == want[2]).all() and (got[3] == want[3]).all()
    for a, b in zip(got[:2], want[:2]):
        assert a[got[2]] == pytest.approx(b[got[2]], abs=1e-12)
