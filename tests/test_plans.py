"""Plan-shape guards and a skewed-input (hot call) check against brute force."""

import random
import re

import pytest

from parley.operators import features as FE
from parley.operators import parse as P
from parley.operators import structure as S


def _plan(df):
    """The final adaptive plan: the frame itself is executed."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan ==")[0]


def hot_calls(spark, n_hot=3000, n_cold=50, seed=3):
    rnd = random.Random(seed)
    words = ["good", "bad", "not", "very", "slow", "thank", "fine", "ok", "the", "sorry"]
    texts = []
    for cid, n in [(0, n_hot)] + [(i, rnd.randint(1, 6)) for i in range(1, n_cold + 1)]:
        turns = []
        for t in range(n):
            sp = rnd.choice(["AGENT", "CUSTOMER"])
            body = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 8)))
            turns.append(f"Turn {t + 1}: {sp}: {body}")
        texts.append((cid, "\n".join(turns)))
    return spark.createDataFrame(texts, "call_id bigint, transcript_text string"), texts


def test_turn_features_plan_keyed_by_turn(spark, rules):
    calls, _ = hot_calls(spark, 50, 5)
    plan = _plan(FE.turn_table_features(P.parse_transcripts(calls), rules))
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", plan)
    assert windows, plan
    for part in windows:                       # every window partitions by (call_id, pos)
        assert "pos" in part and "call_id" in part, part
    assert "SortMergeJoin" not in plan or re.search(r"SortMergeJoin(?:\(skew=true\))? \[call_id#\d+L, pos", plan)


def test_intent_means_are_broadcast(spark):
    calls = spark.createDataFrame([(i, f"issue{i % 3}", float(60 * i)) for i in range(30)],
                                  "call_id bigint, issue_type string, call_duration_seconds double")
    c = FE.duration_ordinal(calls)
    plan = _plan(FE.with_duration_deviation(c, FE.intent_duration_means(calls)))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def brute(texts):
    out = {}
    for cid, tx in texts:
        turns = [(line.split(": ", 2)[1], line.split(": ", 2)[2]) for line in tx.split("\n")]
        n = len(turns)
        agent = [sp == "AGENT" for sp, _ in turns]
        wc = [len(b.split()) for _, b in turns]
        inter = sum(1 for i in range(1, n) if turns[i][0] != turns[i - 1][0] and wc[i] < 5)
        out[cid] = (sum(agent) / n, inter,
                    sum(w for w, a in zip(wc, agent) if a) / max(1, sum(agent)) if any(agent) else 0.0)
    return out


def test_hot_call_matches_brute_force(spark):
    calls, texts = hot_calls(spark)
    got = {r.call_id: r for r in S.turn_features(P.parse_transcripts(calls)).collect()}
    exp = brute(texts)
    assert set(got) == set(exp)
    for cid, (ratio, inter, aw) in exp.items():
        assert got[cid].talk_time_ratio == pytest.approx(ratio)
        assert got[cid].interruption_count == inter
        assert got[cid].avg_agent_words == pytest.approx(aw)


def test_aligned_predictions_need_no_exchange(spark):
    """Tables bucketed by call join and group where they lie; a broadcast isn't what saves the shuffle."""
    from parley.plans.q_io import bucketed_predictions
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = bucketed_predictions(spark, "/root/testdata/sf0.001")
        assert wide.count() > 0
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_phrase_flags_lower_a_text_once(spark):
    """Each phrase list would lower-case the text again if the optimizer inlined it."""
    turns = P.parse_transcripts(hot_calls(spark, 5, 2)[0])
    plan = S.turn_flags(turns, resolution=["a", "b"], empathy=["c"], apology=["d"], transfer=["e"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Contains(") >= 5 and plan.count("lower(") == 1


def test_calls_and_lines_are_dealt_by_document(spark, tmp_path):
    """Whichever side is broadcast, the join's output comes from as many tasks as the other was dealt to."""
    from parley.sources import fixtures as X
    tables = {"orders": ([(i, i % 7, "F", 1000.0 * i, None) for i in range(1, 41)],
                         "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
              "conversations": ([(5, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(4)], "conv_id bigint, turn bigint, role string, text string"),
              "documents": ([(d, "\n".join(f"line {i}" for i in range(d))) for d in range(6)], "doc_id bigint, text string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    df = X.fx(spark, str(tmp_path), "fx_call_turns")
    assert df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 2
    want = {(5, t): f"turn {t}" for t in range(4)}
    for c in [c for c in range(1, 41) if c != 5]:
        doc, skipped = c % 6, (3 - c // 6 % 3) % 3
        want |= {(c, k): f"line {i}" for k, i in enumerate(range(skipped, doc, 3))}
    assert {(r.call_id, r.pos): r.text for r in df.collect()} == want
