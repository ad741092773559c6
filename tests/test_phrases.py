from conftest import calls_df

from parley.functions import constants as K
from parley.operators import phrases as H

TRANSCRIPT = """
Visitor: it broke again, last time too
Clerk: sorry about the mess
Clerk: I connect you to a colleague
Visitor: fine
"""


def test_map_phrases_by_sign(spark, rules):
    lines = H.transcript_lines(calls_df(spark, [TRANSCRIPT]))
    ev = H.evidence_table(lines, rules)
    attr = spark.createDataFrame([(0, 0, "repeat_contact", -0.4), (0, 1, "empathy_density", 0.3),
                                  (0, 2, "transfer_count", -0.2)], "call_id bigint, ord int, feature string, value double")
    m = H.map_phrases(attr, ev).orderBy("polarity", "rank").collect()
    pos = [r.phrase for r in m if r.polarity == "positive"]
    neg = [r.phrase for r in m if r.polarity == "negative"]
    assert pos == ["Clerk: sorry about the mess"]
    assert neg == ["Visitor: it broke again, last time too", "Clerk: I connect you to a colleague"]


def test_coaching_sentences(spark):
    mapped = spark.createDataFrame(
        [(0, "positive", 1, "empathy_density", "sorry about the mess"),
         (0, "negative", 1, "repeat_contact", "they called and called"),
         (0, "negative", 2, "transfer_count", "a transfer it is")],
        "call_id bigint, polarity string, rank int, feature string, phrase string")
    got = [r.sentence for r in H.coaching(mapped).orderBy("idx").collect()]
    assert got == ['Customer frustration detected: "they called and called"',
                   'Multiple transfers may have impacted experience: "a transfer it is"',
                   'Agent showed empathy: "sorry about the mess"']


def test_evidence_finders(spark, rules):
    lines = H.transcript_lines(calls_df(spark, ["a\n  last time it broke  \nI would like to forward your call\nbad end\ngood"]))
    assert H.repeat_phrase(lines).collect()[0].repeat_phrase == "last time it broke"
    assert H.transfer_phrase(lines).collect()[0].transfer_phrase == "I would like to forward your call"
    # tail starts at int(5*0.8)=4: only "good" is considered
    assert H.final_sentiment_phrase(lines, rules).collect()[0].final_sentiment_phrase == "good"
    assert H.empathy_phrase(lines).count() == 0


def test_zero_counts_as_negative_and_caps(spark):
    ev = spark.createDataFrame([(0, f, "p" + f) for f in K.EVIDENCE_FEATURES], "call_id bigint, feature string, phrase string")
    attr = spark.createDataFrame([(0, i, f, 1.0) for i, f in enumerate(K.EVIDENCE_FEATURES)] +
                                 [(1, 0, "repeat_contact", 0.0)], "call_id bigint, ord int, feature string, value double")
    ev = ev.unionByName(spark.createDataFrame([(1, "repeat_contact", "x")], "call_id bigint, feature string, phrase string"))
    m = H.map_phrases(attr, ev).collect()
    assert sum(1 for r in m if r.call_id == 0 and r.polarity == "positive") == 3
    assert [r.polarity for r in m if r.call_id == 1] == ["negative"]


def test_top_attributions(spark):
    wide = spark.createDataFrame([(0, 0.1, -0.5, 0.5, 0.0, 0.3, -0.2)], "call_id bigint, a double, b double, c double, d double, e double, f double")
    long = H.attributions_long(wide, ["a", "b", "c", "d", "e", "f"])
    top = [r.feature for r in H.top_attributions(long, 5).orderBy("rank").collect()]
    assert top == ["b", "c", "e", "f", "a"]


def test_display_names_and_random_row(spark):
    from parley.operators.filters import random_row
    df = spark.createDataFrame([("repeat_contact",), ("intent_login",)], "feature string")
    assert [r.l for r in df.select(H.display_name("feature").alias("l")).collect()] == ["Repeat Contact", "Intent Login"]
    big = spark.range(1000)
    a, b = random_row(big, 7).collect(), random_row(big, 7).collect()
    assert len(a) == 1 and a == b
