"""SQL table function ``parse_transcript(text)`` for SQL users.

A SQL function over the parser's expressions: Spark inlines it, so it runs like
the DataFrame operator ``operators.parse.parse_transcripts``, without Python.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .constants import TURN_PATTERN


def register_parse_udtf(spark: SparkSession, name: str = "parse_transcript") -> None:
    """Create the temporary function: one row ``pos, turn_number, speaker, text`` per kept turn."""
    group = lambda k: f"regexp_extract_all(txt, r'{TURN_PATTERN}', {k})"
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(txt STRING)
RETURNS TABLE (pos INT, turn_number BIGINT, speaker STRING, text STRING)
RETURN SELECT t.pos, t.turn.turn_number, t.turn.speaker, t.turn.text
FROM (SELECT posexplode(filter(transform(
        arrays_zip({group(1)}, {group(2)}, {group(3)}),
        x -> named_struct('turn_number', try_cast(x['0'] AS BIGINT), 'speaker', upper(x['1']),
                          'text', trim(regexp_replace(x['2'], r'(?U)\\s+', ' ')))),
        x -> x.text <> '')) AS (pos, turn)) t""")
