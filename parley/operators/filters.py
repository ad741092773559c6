"""Filters, predicates and phrase joins."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import contains_any
from ..functions.broadcast import local_table

#: Phrases of a list that are looked for in the row, and characters of an index run.
LITERAL_PHRASES, GRAM = 64, 4
#: The rows of tables that ``phrase_table`` made.
_LISTED: "weakref.WeakKeyDictionary[DataFrame, list]" = weakref.WeakKeyDictionary()


def drop_missing(df: DataFrame, cols) -> DataFrame:
    """drop rows with a null in any of ``cols``."""
    return df.na.drop(subset=list(cols))


def split_empty_transcripts(calls: DataFrame, text_col: str = "transcript_text"):
    """``(accepted, rejected)`` by ``length(trim(text)) > 0``."""
    ok = F.coalesce(F.length(F.trim(F.col(text_col))) > 0, F.lit(False))
    return calls.where(ok), calls.where(~ok)


def required_metadata_rejects(calls: DataFrame, required) -> DataFrame:
    """rows missing a required field, routed to an error table."""
    out = None
    for c in required:
        r = calls.where(F.col(c).isNull()).select("call_id", F.lit(f"missing {c}").alias("reason"))
        out = r if out is None else out.unionByName(r)
    return out


def pick(df: DataFrame, **equals) -> DataFrame:
    """equality pick of one group / call."""
    cond = F.lit(True)
    for k, v in equals.items():
        cond = cond & (F.col(k) == v)
    return df.where(cond)


def calls_with_phrase(calls: DataFrame, turns: DataFrame, phrases, speaker: str | None = None,
                      negate: bool = False) -> DataFrame:
    """J7 semi/anti: calls with (or without) a turn containing any phrase."""
    t = turns.where(contains_any(F.lower(F.col("text")), phrases))
    if speaker is not None:
        t = t.where(F.col("speaker") == speaker)
    return calls.join(t.select("call_id"), "call_id", "left_anti" if negate else "left_semi")


def phrase_table(spark: SparkSession, phrases: dict) -> DataFrame:
    """``(kind, phrase)`` rows from a mapping kind -> list of phrases."""
    rows = list(dict.fromkeys((k, p.lower()) for k, ps in phrases.items() for p in ps))
    table = local_table(spark, rows, "kind string, phrase string")
    _LISTED[table] = rows
    return table


def phrase_hits(turns: DataFrame, table: DataFrame) -> DataFrame:
    """J7 theta join: every (turn, phrase) with ``contains(lower(text), phrase)``.

    A table that ``phrase_table`` made of ``LITERAL_PHRASES`` rows at most is looked for
    in the row.  Any other goes by an index of character runs (``indexed_phrase_hits``).
    Repeated rows of the table count once; null texts and phrases hit nothing.
    """
    t = turns.select("call_id", "pos", F.lower(F.col("text")).alias("_lt"))
    rows = _LISTED.get(table)
    if rows is None or len(rows) > LITERAL_PHRASES:
        return indexed_phrase_hits(t, table)
    found = [F.when(F.col("_lt").contains(p), F.struct(F.lit(k).alias("kind"), F.lit(p).alias("phrase"))) for k, p in rows]
    return t.select("call_id", "pos", F.explode(F.array_compact(F.array(*found))).alias("hit")).select("call_id", "pos", "hit.*")


def _runs(text, n: int):
    """The distinct runs of ``n`` characters of a text, hashed (one pass over it; ``n`` 0: the empty run)."""
    if n == 0:
        return F.array(F.xxhash64(F.lit("")))
    return F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))), lambda x: F.xxhash64(x))


def phrase_keys(runs: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(kind, phrase, run)``: each phrase's rarest run of ``GRAM`` characters in the corpus, or all of a shorter phrase.

    ``runs`` has a row for each text and distinct run.  A phrase of which a run occurs
    nowhere has no key and no hit.
    """
    size = F.length("phrase")
    own = phrases.withColumn("run", F.explode(F.when(size < GRAM, F.array(F.xxhash64("phrase"))).otherwise(_runs(F.col("phrase"), GRAM))))
    counts = runs.join(own.select("run").distinct(), "run", "left_semi").groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    rarest = own.join(counts, "run", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return (rarest.groupBy("kind", "phrase").agg(F.min(F.struct("n", "run")).alias("least"))
            .where("least.n > 0").select("kind", "phrase", "least.run"))


def indexed_phrase_hits(t: DataFrame, table: DataFrame) -> DataFrame:
    """``phrase_hits`` for a table of any size; ``t`` has ``call_id, pos, _lt``.

    Every phrase is keyed by the run of ``GRAM`` characters that fewest texts hold, so a
    head that many phrases share ("the ") is no key.  Texts meet phrases on equal runs,
    and what meets is verified in the text.  Phrases shorter than ``GRAM`` are runs of
    their own length.  Plans with one small job: the phrase lengths up to ``GRAM``.
    """
    phrases = table.where("phrase is not null").select("kind", "phrase").distinct()
    lengths = phrases.agg(F.array_sort(F.collect_set(F.least(F.length("phrase"), F.lit(GRAM))))).first()[0]
    if not lengths:
        return t.join(phrases, F.lit(False)).select("call_id", "pos", "kind", "phrase")
    t = t.where("_lt is not null")
    runs = t.select("call_id", "pos", F.explode(F.array_distinct(F.concat(*(_runs(F.col("_lt"), n) for n in lengths)))).alias("run"))
    keys = phrase_keys(runs, phrases)
    met = runs.join(keys, "run").select(F.col("call_id").alias("_c"), F.col("pos").alias("_p"), "kind", "phrase").distinct()
    same = t["call_id"].eqNullSafe(F.col("_c")) & t["pos"].eqNullSafe(F.col("_p"))
    return t.join(met, same).where(F.col("_lt").contains(F.col("phrase"))).select("call_id", "pos", "kind", "phrase")


def random_row(df: DataFrame, seed: int = 42) -> DataFrame:
    """K7: one random row (seeded); a top-1 by a random key, no full sort."""
    return df.orderBy(F.rand(seed)).limit(1)
