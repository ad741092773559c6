"""Reusable DuckDB fragments for the oracle side of the registered queries."""

from __future__ import annotations

from ..functions import constants as K
from ..sources.fixtures import FX_BOOSTERS, FX_CONTRAST, FX_DAMPENERS, FX_LEXICON, FX_NEGATORS

TOKEN_RE = "[\\p{L}\\p{N}'']+"


def lexicon_cte(name: str = "lex", entries=()) -> str:
    rows = [f"('{t}', CAST({v} AS DOUBLE), 1, 0, CAST(0 AS DOUBLE), 0)" for t, v in [*FX_LEXICON, *entries]]
    rows += [f"('{t}', CAST(0 AS DOUBLE), 0, 1, CAST(0 AS DOUBLE), 0)" for t in FX_NEGATORS]
    rows += [f"('{t}', CAST(0 AS DOUBLE), 0, 0, CAST(0.293 AS DOUBLE), 0)" for t in FX_BOOSTERS]
    rows += [f"('{t}', CAST(0 AS DOUBLE), 0, 0, CAST(-0.293 AS DOUBLE), 0)" for t in FX_DAMPENERS]
    rows += [f"('{t}', CAST(0 AS DOUBLE), 0, 0, CAST(0 AS DOUBLE), 1)" for t in FX_CONTRAST]
    return f"{name}(token, valence, is_lex, is_neg, boost, is_but) AS (VALUES {', '.join(rows)})"


def merged_tokens(text: str, entries) -> str:
    """Tokens of ``text`` in DuckDB, entries of several joined by a line feed (longest first; entries that don't overlap)."""
    sql = f"' ' || array_to_string(regexp_extract_all({text}, '{TOKEN_RE}'), '  ') || ' '"
    for words in sorted((e.split(" ") for e, _ in entries), key=len, reverse=True):
        find = "  ".join(f"({w})" for w in words)
        put = "' || chr(10) || '".join(f"\\{i}" for i in range(1, len(words) + 1))
        sql = f"regexp_replace({sql}, '(?i) {find} ', ' {put} ', 'g')"
    return f"list_filter(string_split(trim({sql}, ' '), '  '), lambda x: x <> '')"


def scored_cte(src: str, keys: list[str], text: str, out: str, entries=()) -> str:
    """CTEs ending in ``out(keys..., compound)`` for every row of ``src``.

    The published rules as numbers of their own, a chain of three correlated
    look-backs by position instead of windows.
    """
    k = ", ".join(keys)
    same = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)
    steps, last = "", f"{out}_v0"
    for n, fade in ((1, 1.0), (2, 0.95), (3, 0.9)):
        now = f"{out}_v{n}"
        steps += f"""
, {now} AS (SELECT {', '.join(f'p.{c}' for c in keys)}, p.tpos, p.e,
    (p.v + CASE WHEN m.is_lex = 0 AND m.boost <> 0 THEN {fade} * (
        CASE WHEN p.v < 0 THEN -m.boost ELSE m.boost END
        + CASE WHEN NOT m.loud THEN 0.0 WHEN p.v > 0 THEN 0.733 ELSE -0.733 END) ELSE 0.0 END)
    * CASE WHEN m.is_lex = 0 AND m.is_neg = 1 THEN CAST(-0.74 AS DOUBLE) ELSE 1.0 END AS v
    FROM {last} p LEFT JOIN {out}_hit m ON {same('p', 'm')} AND m.tpos = p.tpos - {n})"""
        last = now
    found = merged_tokens(text, entries) if entries else f"regexp_extract_all({text}, '{TOKEN_RE}')"
    return f""", {lexicon_cte(out + '_lex', entries)}
, {out}_raw AS (SELECT {k}, {found} AS tk,
    0.292 * least(4, length({text}) - length(replace({text}, '!', '')))
    + CASE WHEN length({text}) - length(replace({text}, '?', '')) > 3 THEN 0.96
           WHEN length({text}) - length(replace({text}, '?', '')) > 1
           THEN 0.18 * (length({text}) - length(replace({text}, '?', ''))) ELSE 0.0 END AS e FROM {src})
, {out}_mix AS (SELECT *, len(list_filter(tk, lambda x: x = upper(x) AND x <> lower(x))) BETWEEN 1 AND len(tk) - 1 AS mixed FROM {out}_raw)
, {out}_tok AS (SELECT {k}, CAST(e AS DOUBLE) AS e, mixed, unnest(tk) AS raw, unnest(generate_series(0, len(tk) - 1)) AS tpos FROM {out}_mix)
, {out}_hit AS (SELECT t.*, l.*, mixed AND raw = upper(raw) AND raw <> lower(raw) AS loud
    FROM {out}_tok t JOIN {out}_lex l ON replace(lower(t.raw), chr(10), ' ') = l.token)
, {out}_but AS (SELECT {k}, min(tpos) AS b FROM {out}_hit WHERE is_but = 1 GROUP BY {k})
, {out}_v0 AS (SELECT {k}, tpos, e, valence + CASE WHEN loud THEN sign(valence) * 0.733 ELSE 0.0 END AS v FROM {out}_hit WHERE is_lex = 1){steps}
, {out}_sum AS (SELECT {', '.join(f'p.{c}' for c in keys)}, max(p.e) AS e,
    sum(p.v * CASE WHEN p.tpos < b.b THEN 0.5 WHEN p.tpos > b.b THEN 1.5 ELSE 1.0 END) AS s0
    FROM {last} p LEFT JOIN {out}_but b ON {same('p', 'b')} GROUP BY {', '.join(f'p.{c}' for c in keys)})
, {out}_tot AS (SELECT {k}, s0 + sign(s0) * e AS s FROM {out}_sum)
, {out} AS (SELECT {', '.join(f'f.{c}' for c in keys)}, CASE WHEN s.s IS NULL THEN CAST(0 AS DOUBLE)
    ELSE greatest(CAST(-1 AS DOUBLE), least(CAST(1 AS DOUBLE), s.s / sqrt(s.s * s.s + {K.NORMALISATION_ALPHA}))) END
    AS compound FROM {src} f LEFT JOIN {out}_tot s ON {same('f', 's')})
"""


def pipe_transcripts_cte(name: str = "pipe_tx") -> str:
    return (f", {name} AS (SELECT call_id, string_agg(text, ' | ' ORDER BY pos) AS transcript_text "
            f"FROM fx_turns GROUP BY call_id)\n")


def pipe_turns_cte(src: str, name: str) -> str:
    return f""", {name}_parts AS (SELECT call_id, unnest(string_split(transcript_text, '|')) AS p,
    unnest(generate_series(1, len(string_split(transcript_text, '|')))) AS i FROM {src})
, {name} AS (SELECT call_id, CAST(row_number() OVER (PARTITION BY call_id ORDER BY i) - 1 AS BIGINT) AS pos,
    trim(p, ' ' || chr(10)) AS text FROM {name}_parts WHERE trim(p, ' ' || chr(10)) <> '')
"""


def contains_any(expr: str, phrases) -> str:
    if not phrases:
        return "FALSE"
    return "(" + " OR ".join(f"contains({expr}, '{p}')" for p in phrases) + ")"
