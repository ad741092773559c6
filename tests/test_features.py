import pytest
from conftest import calls_df
from pyspark.sql import functions as F

from parley.functions import rules as R
from parley.operators import features as FE
from parley.operators import parse as P
from parley.operators import structure as S

FIVE = """Turn 1: AGENT: Hello how can I help
Turn 2: CUSTOMER: My internet is not working
Turn 3: AGENT: Okay
Turn 4: CUSTOMER: Still slow
Turn 5: AGENT: Fixed that for you"""


def test_five_turn_case(spark):
    turns = P.parse_transcripts(calls_df(spark, [FIVE]))
    r = S.conversation_features(turns).collect()[0]
    assert r.talk_time_ratio == pytest.approx(0.6)
    assert r.avg_agent_words == pytest.approx(10 / 3)
    assert r.avg_customer_words == pytest.approx(3.5)
    assert r.interruption_count == 3
    assert r.resolution_flag == 1
    a = S.agent_behaviour(turns).collect()[0]
    assert (a.empathy_density, a.apology_count, a.transfer_count) == (0.0, 0.0, 0.0)


def test_agent_behaviour_counts_turns(spark):
    text = ("Turn 1: AGENT: I understand, sorry, so sorry\nTurn 2: CUSTOMER: hmm\n"
            "Turn 3: AGENT: let me transfer you to a specialist\nTurn 4: AGENT: I apologise")
    a = S.agent_behaviour(P.parse_transcripts(calls_df(spark, [text]))).collect()[0]
    assert a.empathy_density == pytest.approx(1 / 3)
    assert a.apology_count == 2          # turns, not hits
    assert a.transfer_count == 1


def test_transcript_features(spark):
    df = calls_df(spark, ["I called before. Transfer, transfer! Sorry, I understand the inconvenience"])
    r = S.transcript_features(df).collect()[0]
    assert (r.tx_repeat_contact, r.tx_transfer_count, r.tx_empathy_words) == (1.0, 2.0, 3.0)


def test_duration_rules(spark):
    df = spark.createDataFrame([(s,) for s in [None, 0.0, 120.0, 240.0, 300.0, 420.0, 600.0, 720.0]],
                               "s double")
    rows = df.select(R.duration_ordinal_train("s").alias("t"), R.duration_ordinal_crm("s").alias("c"),
                     R.duration_label("s").alias("l"), R.duration_label_total("s").alias("m")).collect()
    assert [r.t for r in rows] == [0, -1, -1, -1, 0, 0, 1, 1]
    assert [r.c for r in rows] == [-1, -1, -1, 0, 0, 0, 0, 1]
    assert [r.l for r in rows] == ["nan", "nan", "short", "short", "medium", "long", "long", "long"]
    assert [r.m for r in rows] == ["medium", "short", "short", "short", "medium", "long", "long", "long"]


def test_flags_and_keys(spark):
    vals = [" Yes", "no", "1", "1.0", "true", "0.0", None, "maybe"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.f for r in df.select(R.repeat_flag("v").alias("f")).collect()]
    assert got == [1.0, 0.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0]
    df = spark.createDataFrame([(" Resolved\t",), ("unresolved",), (None,)], "v string")
    assert [r.f for r in df.select(R.resolution_from_status("v").alias("f")).collect()] == [1.0, 0.0, 0.0]
    df = spark.createDataFrame([("Billing_Error ",), ("technical_support",), ("other",)], "issue_type string")
    oh = FE.intent_onehot(df).collect()
    assert oh[0].intent_billing == 1.0 and oh[1].intent_technical == 1.0
    assert sum(oh[2][c] for c in oh[2].asDict() if c.startswith("intent_")) == 0.0


def test_feature_matrix_zero_defaults(spark, rules):
    calls = spark.createDataFrame(
        [(1, "billing", 100.0, "yes", "resolved", 4.0, FIVE), (2, "refund", 500.0, "no", None, 2.0, None)],
        "call_id bigint, issue_type string, call_duration_seconds double, repeat_contact string, "
        "resolution_status string, csat_score double, transcript_text string")
    turns = P.parse_transcripts(calls)
    f = {r.call_id: r for r in FE.build_features(calls, turns, rules).collect()}
    assert len(f[1]) == 26
    assert f[1].talk_time_ratio == pytest.approx(0.6) and f[1].resolution_flag == 1.0
    assert f[2].talk_time_ratio == 0.0 and f[2].mean_sentiment == 0.0 and f[2].resolution_flag == 0.0
    assert f[1].duration_ordinal == -1.0 and f[2].duration_ordinal == 1.0
    assert f[1].duration_deviation == 0.0          # its own intent mean
    assert f[2].intent_refund == 1.0 and f[1].repeat_contact == 1.0


def test_phrase_semi_anti(spark):
    from parley.operators import filters as FL
    calls = calls_df(spark, ["Turn 1: AGENT: let me transfer you", "Turn 1: AGENT: hello"])
    turns = P.parse_transcripts(calls)
    w = [r.call_id for r in FL.calls_with_phrase(calls, turns, ["transfer you"]).collect()]
    wo = [r.call_id for r in FL.calls_with_phrase(calls, turns, ["transfer you"], negate=True).collect()]
    assert w == [0] and wo == [1]


def test_carried_prev_speaker_equals_join(spark):
    text = ("Turn 1: AGENT: hi there friend\nTurn 2: SYSTEM: x\nTurn 3: AGENT: ok\nTurn 4: CUSTOMER:   \n"
            "Turn 5: CUSTOMER: no\nTurn 6: AGENT: fine then")
    turns = P.parse_transcripts(calls_df(spark, [text, FIVE]))
    a = {r.call_id: r.interruption_count for r in S.interruption_counts(turns).collect()}
    b = {r.call_id: r.interruption_count for r in S.interruption_counts(turns.drop("prev_speaker")).collect()}
    assert a == b and a[0] == 2.0


ODD_TURNS = [(0, 0, "Tell you WHAT"), (0, 1, "xyz"), (1, 0, ""), (1, 1, None), (2, 0, "ab abc abcd abcde"), (2, 1, "a😀b 漢字漢字 \n é"), (None, 5, "tell you"),
             (0, 0, "tell you what"), (3, 0, "the the the"), (3, 1, "aaaaaaa")]
ODD_PHRASES = ["ell you", "what", "abcd", "ab", "z", "zzzz", "abc abcd", "", "😀b", "漢字漢", "字漢字 ", "b 漢字漢字 \n é", "the t", "aaaa", "aaaaaaaa", "a", "é", "\n", "d a", "%a", ".b"]


def brute_hits(turns, phrases, kind="k"):
    return sorted({((c, p), kind, ph) for c, p, t in turns if t is not None for ph in phrases if ph in t.lower()}, key=str)


def hits(df):
    return sorted({((r.call_id, r.pos), r.kind, r.phrase) for r in df.collect()}, key=str)


def test_phrase_hits_in_the_row_and_by_index(spark, monkeypatch):
    from parley.operators import filters as FL
    turns = spark.createDataFrame(ODD_TURNS, "call_id bigint, pos int, text string")
    want = brute_hits(ODD_TURNS, ODD_PHRASES)
    table = FL.phrase_table(spark, {"k": ODD_PHRASES + ODD_PHRASES[:3]})
    assert hits(FL.phrase_hits(turns, table)) == want
    rows = spark.createDataFrame([("k", p) for p in ODD_PHRASES] + [("k", "ab"), ("k", None), (None, "zz")], "kind string, phrase string")
    got = FL.phrase_hits(turns, rows)
    assert hits(got) == want and got.where("phrase = 'ab'").count() == 1
    assert got.where("phrase = 'what'").count() == 2          # two rows of one key: one hit each
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert FL.phrase_hits(turns, rows.where("false")).count() == 0 and FL.phrase_hits(turns.where("false"), rows).count() == 0


def test_200_000_phrases_with_one_head(spark):
    """Far more phrases than were broadcast, all starting "the ": each is keyed by another run."""
    import random

    from parley.operators import filters as FL
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 7)))
    phrases = {f"the {word()} {word()}" for _ in range(200_000)} | {"the", "e", "th"}
    some = sorted(phrases)
    texts = [" ".join(rnd.choice([rnd.choice(some), word(), "the", "The " + word()]) for _ in range(60)) for _ in range(120)]
    want = set()
    for i, t in enumerate(texts):
        low = t.lower()
        want |= {(i, p) for p in ("the", "e", "th") if p in low}
        at = low.find("the ")
        while at >= 0:
            want |= {(i, low[at:at + n]) for n in range(5, 22) if low[at:at + n] in phrases}
            at = low.find("the ", at + 1)
    turns = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "call_id bigint, pos int, text string")
    table = spark.createDataFrame([("k", p) for p in phrases], "kind string, phrase string")
    runs = turns.select("call_id", "pos", F.explode(FL._runs(F.lower("text"), FL.GRAM)).alias("run"))
    keys = FL.phrase_keys(runs, table.where("length(phrase) >= 4"))
    common = spark.sql("SELECT xxhash64('the ') AS run")
    assert keys.join(common, "run").count() == 0 and keys.count() < len(phrases)
    assert {(r.call_id, r.phrase) for r in FL.phrase_hits(turns, table).collect()} == want and len(want) > 2000


def test_call_turns_of_one_small_file_are_made_by_many_tasks(spark, tmp_path):
    """Each line goes to many calls: the tasks of the join mustn't be as few as its input is small."""
    from parley.sources.fixtures import fx
    sf = str(tmp_path)
    (spark.range(600).selectExpr("id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "250000D AS o_totalprice", "TIMESTAMP'2020-01-01' AS o_orderdate")
     .coalesce(1).write.parquet(f"{sf}/orders.parquet"))
    spark.range(40).selectExpr("id AS doc_id", r"concat('a ', id, '\nb\nc\nd') AS text").coalesce(1).write.parquet(f"{sf}/documents.parquet")
    (spark.createDataFrame([(3, 0, "user", "hello"), (3, 1, "assistant", "well")], "conv_id bigint, turn int, role string, text string")
     .coalesce(1).write.parquet(f"{sf}/conversations.parquet"))
    turns = fx(spark, sf, "fx_call_turns").withColumn("part", F.spark_partition_id())
    rows = turns.collect()
    assert len({r.part for r in rows if r.call_id != 3}) > 1
    lines = {i: [f"a {i}", "b", "c", "d"] for i in range(40)}
    skipped = lambda c: (3 - c // 40 % 3) % 3
    want = sorted((c, k, x) for c in range(600) if c != 3 for k, x in enumerate(lines[c % 40][skipped(c)::3]))
    assert sorted((r.call_id, r.pos, r.text) for r in rows if r.call_id != 3) == want
    assert [r.text for r in sorted(rows, key=lambda r: r.pos) if r.call_id == 3] == ["hello", "well"]
