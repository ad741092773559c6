from conftest import calls_df

from parley.operators import parse as P


def turns_of(spark, text):
    rows = P.parse_transcripts(calls_df(spark, [text])).orderBy("pos").collect()
    return [(r.pos, r.turn_number, r.speaker, r.text) for r in rows]


def test_newline_and_case_and_padding(spark):
    want = [(0, 4, "AGENT", "who is there"), (1, 5, "CUSTOMER", "a neighbour")]
    assert turns_of(spark, "Turn 4: AGENT: who is there\nTurn 5: CUSTOMER: a neighbour") == want
    assert turns_of(spark, "turn 4 : Agent : who is there\nTURN 5:customer:a neighbour") == want
    assert turns_of(spark, "Turn 4: AGENT: \t who  is there \n Turn 5: CUSTOMER:\ta neighbour ") == want


def test_empty_unformatted_null(spark):
    assert turns_of(spark, "") == []
    assert turns_of(spark, "no markers in this line") == []
    assert turns_of(spark, None) == []


def test_other_speaker_delimits_and_is_dropped(spark):
    assert turns_of(spark, "Turn 1: AGENT: hi\nTurn 2: SYSTEM: x\nTurn 3: CUSTOMER: yo") == [
        (0, 1, "AGENT", "hi"), (1, 3, "CUSTOMER", "yo")]


def test_empty_body_dropped_positions_dense(spark):
    assert turns_of(spark, "Turn 1: AGENT:   \nTurn 2: CUSTOMER: hi") == [(0, 2, "CUSTOMER", "hi")]


def test_turn_marker_inside_text_splits(spark):
    assert turns_of(spark, "Turn 1: AGENT: see turn 3: CUSTOMER: ok") == [
        (0, 1, "AGENT", "see"), (1, 3, "CUSTOMER", "ok")]


def test_pipe_separator_kept_as_word(spark):
    t = turns_of(spark, "Turn 1: CUSTOMER: two eggs | Turn 2: AGENT: and toast")
    assert t[0][3] == "two eggs |"


def test_pipe_and_line_split(spark):
    df = calls_df(spark, [" a | b ||  c |"])
    assert [r.text for r in P.pipe_turns(df).orderBy("pos").collect()] == ["a", "b", "c"]
    df = calls_df(spark, ["\nx\n\ny\n"])
    assert [r.text for r in P.line_turns(df).orderBy("pos").collect()] == ["", "x", "", "y", ""]


def test_timestamps_and_roundtrip(spark):
    text = "Turn 1: AGENT: a\nTurn 2: CUSTOMER: b\nTurn 3: AGENT: c"
    turns = P.parse_transcripts(calls_df(spark, [text]))
    lab = spark.createDataFrame([(0, "short")], "call_id bigint, call_duration string")
    ts = [r.ts_offset for r in P.add_synthetic_timestamps(turns, lab).orderBy("pos").collect()]
    assert ts == [0.0, 60.0, 120.0]
    back = P.format_transcripts(turns).collect()[0].transcript_text
    assert back == text


def test_udtf_matches_operator(spark):
    from parley.functions.udtf import register_parse_udtf
    register_parse_udtf(spark)
    calls_df(spark, ["Turn 1: AGENT: see turn 3: CUSTOMER: ok"]).createOrReplaceTempView("t_udtf")
    rows = spark.sql("SELECT p.* FROM t_udtf, LATERAL parse_transcript(transcript_text) p ORDER BY pos").collect()
    assert [(r.pos, r.turn_number, r.speaker, r.text) for r in rows] == [(0, 1, "AGENT", "see"), (1, 3, "CUSTOMER", "ok")]
