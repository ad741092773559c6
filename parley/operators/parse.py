"""Transcript -> turns generators.

All parsing happens inside one row with array expressions (regex extraction,
``filter``, ``transform``) followed by ``posexplode``: no shuffle, and each
turn row carries ``n_turns`` so later "last 20%" rules need no per-call
count join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.text import collapse_ws, strip_ws

TURN_COLUMNS = ["call_id", "pos", "turn_number", "speaker", "text", "n_turns", "prev_speaker"]


def _explode_turns(df: DataFrame, key: str, arr, keep=()) -> DataFrame:
    """Explode an array of turn structs; attach the previous kept turn's speaker.

    The array is materialised as a column first (the optimizer does not
    inline an expensive producer referenced twice), then each element gets
    ``prev_speaker`` from its neighbour in the same row — no join needed.
    """
    staged = df.select(F.col(key).alias("call_id"), *keep, arr.alias("_t"))
    with_prev = F.transform(F.col("_t"), lambda x, i: x.withField(
        "prev_speaker", F.when(i > 0, F.col("_t")[i - 1]["speaker"])))
    out = staged.select("call_id", *keep, F.size("_t").alias("n_turns"),
                        F.posexplode(with_prev).alias("pos", "_turn"))
    return out.select("call_id", "pos", "_turn.turn_number", "_turn.speaker", "_turn.text", "n_turns",
                      "_turn.prev_speaker", *keep)


def parse_transcripts(calls: DataFrame, text_col: str = "transcript_text",
                      key: str = "call_id", keep=()) -> DataFrame:
    """``Turn N: AGENT|CUSTOMER: text`` segments -> one row per turn.

    Speaker upper-cased; text whitespace-collapsed and stripped; empty
    turns dropped (positions stay dense); null/unmatched input -> no rows.
    Other speakers are dropped but still end the previous turn.
    """
    t = F.col(text_col)
    pat = F.lit(K.TURN_PATTERN)
    # Each group's matches are extracted once per transcript (as columns) and
    # zipped; the per-turn lambda only touches its own element.
    staged = calls.select(F.col(key), *keep, F.regexp_extract_all(t, pat, 1).alias("_n"),
                          F.regexp_extract_all(t, pat, 2).alias("_s"),
                          F.regexp_extract_all(t, pat, 3).alias("_x"))
    zipped = F.transform(F.arrays_zip("_n", "_s", "_x"), lambda x: F.struct(
        x["_n"].try_cast("bigint").alias("turn_number"),
        F.upper(x["_s"]).alias("speaker"),
        collapse_ws(x["_x"]).alias("text")))
    kept = F.filter(zipped, lambda x: x["text"] != F.lit(""))
    return _explode_turns(staged, key, F.coalesce(kept, F.array()), keep)


def pipe_turns(calls: DataFrame, text_col: str = "transcript_text",
               key: str = "call_id") -> DataFrame:
    """``[t.strip() for t in text.split('|') if t.strip()]``.

    One ``filter`` on the split array keeps positions dense; stripping and
    numbering happen after the explode as plain (codegen) expressions.
    """
    kept = F.filter(F.split(F.col(text_col), r"\|"), lambda x: strip_ws(x) != F.lit(""))
    # Stage the array as a column: a size() next to the explode would
    # otherwise re-evaluate the whole split per exploded row.
    staged = calls.select(F.col(key).alias("call_id"), F.coalesce(kept, F.array().cast("array<string>")).alias("_a"))
    out = staged.select("call_id", F.size("_a").alias("n_turns"), F.posexplode("_a").alias("pos", "_t"))
    return out.select("call_id", "pos", (F.col("pos") + 1).cast("bigint").alias("turn_number"),
                      F.lit(None).cast("string").alias("speaker"), strip_ws("_t").alias("text"), "n_turns",
                      F.lit(None).cast("string").alias("prev_speaker"))


def line_turns(calls: DataFrame, text_col: str = "transcript_text", key: str = "call_id",
               drop_blank: bool = False, alternate_speakers: bool = False) -> DataFrame:
    """``text.split('\\n')`` lines in order (blank lines kept unless asked).

    With ``alternate_speakers`` lines alternate AGENT / CUSTOMER by kept
    position (used to derive turn tables from plain documents).  Only the
    optional blank-line ``filter`` runs on the array; the rest is computed
    after the explode.
    """
    lines = F.split(F.col(text_col), "\n")
    if drop_blank:
        lines = F.filter(lines, lambda x: F.trim(x) != F.lit(""))
    # Stage the array as a column: a size() next to the explode would
    # otherwise re-evaluate the whole split per exploded row.
    staged = calls.select(F.col(key).alias("call_id"), F.coalesce(lines, F.array().cast("array<string>")).alias("_a"))
    out = staged.select("call_id", F.size("_a").alias("n_turns"), F.posexplode("_a").alias("pos", "text"))
    pos = F.col("pos")
    if alternate_speakers:
        speaker = F.when(pos % 2 == 0, "AGENT").otherwise("CUSTOMER")
        prev = F.when(pos > 0, F.when(pos % 2 == 1, "AGENT").otherwise("CUSTOMER"))
    else:
        speaker = prev = F.lit(None).cast("string")
    return out.select("call_id", "pos", (pos + 1).cast("bigint").alias("turn_number"),
                      speaker.alias("speaker"), "text", "n_turns", prev.alias("prev_speaker"))


def add_synthetic_timestamps(turns: DataFrame, calls: DataFrame | None = None,
                             label_col: str = "call_duration") -> DataFrame:
    """Turn ``i`` of ``n`` gets ``i * (total / n)`` seconds.

    ``total`` is 180/300/480 for short/medium/long (default 300).  The label
    comes from ``calls`` (joined on ``call_id``, one row per call) or from a
    column already on ``turns``.  Unrounded; reports round.
    """
    df = turns
    if calls is not None:
        df = df.join(calls.select("call_id", label_col), "call_id", "left")
    total = F.lit(float(K.DEFAULT_TOTAL_SECONDS))
    for label, secs in K.DURATION_TOTAL_SECONDS.items():
        total = F.when(F.col(label_col) == label, float(secs)).otherwise(total)
    return df.withColumn("ts_offset", F.col("pos") * (total / F.col("n_turns")))


def format_transcripts(turns: DataFrame) -> DataFrame:
    """P5: turns -> ``Turn n: SPEAKER: text`` lines joined by newline."""
    line = F.concat(F.lit("Turn "), F.col("turn_number").cast("string"), F.lit(": "),
                    F.col("speaker"), F.lit(": "), collapse_ws("text"))
    return (turns.groupBy("call_id")
                 .agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("_l"))
                 .select("call_id",
                         F.array_join(F.transform("_l", lambda x: x["line"]), "\n")
                         .alias("transcript_text")))


def with_turn_counts(turns: DataFrame) -> DataFrame:
    """Ensure ``n_turns`` is present (per-call count joined back).

    Parsed turns already carry it.  Otherwise the count is a partial
    aggregate and the join is keyed on ``call_id``; AQE splits a hot call.
    """
    if "n_turns" in turns.columns:
        return turns
    counts = turns.groupBy("call_id").agg(F.count(F.lit(1)).cast("int").alias("n_turns"))
    return turns.join(counts, "call_id")
