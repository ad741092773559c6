"""Chat formatting of preference pairs: one shared prompt and two masked completions.

Chosen and rejected conversations of a pair are compared turn by turn; the longest
common prefix of turns is rendered once as the prompt, the rest of each as its
completion.  A mask lists the stretches of a completion that are trained on: the
texts of its assistant turns with their end marks.  All of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The rendering of a turn: head with the role, text, end mark.
HEAD, END = "<|{}|>\n", "<|end|>\n"


def _turns(t: DataFrame, name: str) -> DataFrame:
    """One row for each pair: its turns in order (ties by role, then text), nulls as empty strings."""
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    said = F.transform(F.array_sort(F.collect_list(turn)), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return t.where("pair_id is not null").groupBy("pair_id").agg(said.alias(name))


def _render(turns):
    head, tail = HEAD.split("{}")
    return F.array_join(F.transform(turns, lambda x: F.concat(F.lit(head), x["role"], F.lit(tail), x["text"], F.lit(END))), "")


def _mask(turns):
    """``{start, end}`` character ranges of assistant texts and their end marks within the rendered turns."""
    fixed, end = len(HEAD.format("")), len(END)

    def step(acc, x):
        begin = acc["at"] + F.lit(fixed) + F.length(x["role"])
        stop = begin + F.length(x["text"]) + F.lit(end)
        new = F.when(x["role"] == "assistant",
                     F.array_append(acc["out"], F.struct(begin.alias("start"), stop.alias("end")))).otherwise(acc["out"])
        return F.struct(stop.alias("at"), new.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    return F.aggregate(turns, start, step, lambda acc: acc["out"])


def preference_format(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Turn tables ``pair_id, turn, role, text`` of both sides -> one formatted row for each pair in either.

    Columns: ``pair_id, n_prompt_turns, prompt, chosen, rejected`` (completions) and
    ``chosen_mask, rejected_mask`` (character ranges in each completion).  Turns are
    ordered by number, ties by role, then text; a null role or text is empty; turns
    with a null ``pair_id`` belong to no pair and are left out; a side that is missing
    has no turns; repeated turns repeat; other columns are ignored; empty tables give
    an empty result.  A pair's rows meet in one task: a pair is one output row.
    """
    both = _turns(chosen, "c").join(_turns(rejected, "r"), "pair_id", "full")
    none = F.array().cast("array<struct<role:string,text:string>>")
    both = both.select("pair_id", F.coalesce("c", none).alias("c"), F.coalesce("r", none).alias("r"))
    differs = F.filter(F.transform("c", lambda x, i: F.when(x.eqNullSafe(F.get("r", i)), F.lit(None)).otherwise(i)),
                       lambda i: i.isNotNull())
    both = both.withColumn("n", F.coalesce(F.get(differs, F.lit(0)), F.size("c")))
    rest = lambda side: F.slice(side, F.col("n") + 1, F.greatest(F.size(side) - F.col("n"), F.lit(0)))
    both = both.select("pair_id", F.col("n").cast("bigint").alias("n_prompt_turns"), F.slice("c", F.lit(1), F.col("n")).alias("p"),
                       rest("c").alias("c"), rest("r").alias("r"))
    return both.select("pair_id", "n_prompt_turns", _render("p").alias("prompt"), _render("c").alias("chosen"),
                       _render("r").alias("rejected"), _mask("c").alias("chosen_mask"), _mask("r").alias("rejected_mask"))


def reply_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs from a plain conversation table, as ``(chosen, rejected)`` turn tables.

    Chosen: a conversation up to its last assistant turn.  Rejected: the same with
    that reply's text replaced by the last reply of the conversation of the next
    number, or left out where there is none.  Conversations without an assistant turn
    give no pair.
    """
    t = conversations.select(F.col("conv_id").cast("bigint").alias("pair_id"), F.col("turn").cast("bigint").alias("turn"),
                             "role", "text").where("pair_id is not null")
    reply = (t.where("role = 'assistant'").groupBy("pair_id")
             .agg(F.max(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))).alias("x"))
             .select("pair_id", F.col("x.turn").alias("last"), F.col("x.text").alias("reply")))
    chosen = (t.join(reply.select("pair_id", "last"), "pair_id")
              .where(F.coalesce(F.col("turn") <= F.col("last"), F.col("last").isNull()))
              .select("pair_id", "turn", "role", "text"))
    donor = reply.select((F.col("pair_id") - 1).alias("pair_id"), F.col("reply").alias("other"))
    swapped = reply.join(donor, "pair_id").select("pair_id", F.col("last").alias("turn"), F.lit("assistant").alias("role"),
                                                  F.col("other").alias("text"))
    before = (t.join(reply.select("pair_id", "last"), "pair_id").where(F.col("turn") < F.col("last"))
              .select("pair_id", "turn", "role", "text"))
    return chosen, before.unionByName(swapped)


ORACLE = f"""
WITH t AS (SELECT conv_id AS pair_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
reply AS (SELECT pair_id, max(turn) AS last, max(text) FILTER (WHERE turn = m) AS reply
          FROM (SELECT *, max(turn) OVER (PARTITION BY pair_id) AS m FROM t WHERE role = 'assistant') GROUP BY pair_id),
c AS (SELECT t.pair_id, t.turn, t.role, t.text FROM t JOIN reply USING (pair_id) WHERE t.turn <= reply.last),
r AS (SELECT t.pair_id, t.turn, t.role, t.text FROM t JOIN reply USING (pair_id) WHERE t.turn < reply.last
      UNION ALL
      SELECT a.pair_id, a.last, 'assistant', b.reply FROM reply a JOIN reply b ON b.pair_id = a.pair_id + 1),
cn AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) - 1 AS pos FROM c),
rn AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn, role, text) - 1 AS pos FROM r),
n AS (SELECT cn.pair_id, coalesce(min(cn.pos) FILTER (WHERE rn.pos IS NULL OR rn.role <> cn.role OR rn.text <> cn.text), count(*)) AS n
      FROM cn LEFT JOIN rn ON rn.pair_id = cn.pair_id AND rn.pos = cn.pos GROUP BY cn.pair_id),
f AS (SELECT pair_id, pos, 'c' AS side, role, text FROM cn UNION ALL SELECT pair_id, pos, 'r', role, text FROM rn),
g AS (SELECT f.*, n.n, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS shown,
             CASE WHEN role = 'assistant' THEN length(text) + 8 ELSE 0 END AS trained
      FROM f JOIN n USING (pair_id))
SELECT pair_id AS conv_id, n AS n_prompt_turns,
       sha256(coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE side = 'c' AND pos < n), '')) AS prompt_sha256,
       sha256(coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE side = 'c' AND pos >= n), '')) AS chosen_sha256,
       sha256(coalesce(string_agg(shown, '' ORDER BY pos) FILTER (WHERE side = 'r' AND pos >= n), '')) AS rejected_sha256,
       CAST(coalesce(sum(trained) FILTER (WHERE side = 'c' AND pos >= n), 0) AS BIGINT) AS chosen_trained,
       CAST(coalesce(sum(trained) FILTER (WHERE side = 'r' AND pos >= n), 0) AS BIGINT) AS rejected_trained
FROM g GROUP BY pair_id, n
"""
