"""String column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware whitespace, matching Python 3 ``str`` semantics.
_WS_RUN = r"(?U)\s+"
_EDGE_WS = r"(?U)^\s+|\s+$"
_NON_WS_RUN = r"(?U)\S+"
# A token is a run of letters, digits and apostrophes.
TOKEN_PATTERN = r"[\p{L}\p{N}']+"
# What stands between the tokens of an entry of several.
ENTRY_GAP = r"[^\p{L}\p{N}']+"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's ``str.isspace`` accepts (``str.strip()`` removes these).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c) -> Column:
    """``str.strip()``: remove leading/trailing whitespace (no regex)."""
    return F.btrim(col(c), F.lit(PY_WHITESPACE))


def collapse_ws(c) -> Column:
    """Collapse whitespace runs to one space and strip the ends."""
    return F.trim(F.regexp_replace(col(c), _WS_RUN, " "))


def word_count(c) -> Column:
    """``len(text.split())`` — number of whitespace-separated words."""
    return F.coalesce(F.regexp_count(col(c), F.lit(_NON_WS_RUN)), F.lit(0)).cast("int")


def tokens(c, pattern: str | None = None) -> Column:
    """Word tokens of a text as they stand, in order; ``pattern`` of ``entry_pattern`` keeps its entries together."""
    return F.regexp_extract_all(col(c), F.lit(pattern or TOKEN_PATTERN), 0)


def normal_token(t: str) -> str:
    """An entry in lower case with one space between its tokens."""
    t = t.lower()
    return " ".join("".join(c if c.isalnum() or c == "'" else " " for c in t).split()) or t


def entry_pattern(entries) -> str:
    """A token pattern that returns the longest of ``entries`` (of several tokens each) where one starts.

    The entries are a trie of tokens, written as nested alternatives: after a token the
    longer entries are tried before an entry that ends there, and any other token last.
    A match starts where the one before ended, so it always starts at a whole token.
    """
    trie: dict = {}
    for e in entries:
        node = trie
        for t in e.lower().split(" "):
            node = node.setdefault(t, {})
        node[None] = {}

    def written(node: dict) -> str:
        longer = [re_escape(t) + "(?![\\p{L}\\p{N}'])" + written(child) for t, child in sorted((t, c) for t, c in node.items() if t is not None)]
        if not longer:
            return ""
        return f"(?:{ENTRY_GAP}(?:{'|'.join(longer)}))" + ("?" if None in node else "")

    heads = "|".join(re_escape(t) + "(?![\\p{L}\\p{N}'])" + written(child) for t, child in sorted(trie.items()))
    return f"(?iu)(?:{heads})|{TOKEN_PATTERN}"


def re_escape(t: str) -> str:
    """A token as a literal of a Java pattern (tokens are letters, digits and apostrophes)."""
    return "".join(c if c.isalnum() or c == "'" else "\\" + c for c in t)


def contains_any(c, phrases) -> Column:
    """True when ``c`` contains any of ``phrases`` (caller lower-cases)."""
    c = col(c)
    if not phrases:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [c.contains(p) for p in phrases])


def count_present(c, words) -> Column:
    """Number of distinct ``words`` that occur in ``c`` as substrings."""
    c = col(c)
    if not words:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [c.contains(w).cast("int") for w in words])


def count_substring(c, needle: str) -> Column:
    """Non-overlapping occurrences of ``needle`` (``str.count``)."""
    c = col(c)
    return ((F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) /
            F.lit(len(needle))).cast("int")


def title_label(c) -> Column:
    """``s.replace('_',' ').title()`` for snake-case category names."""
    return F.initcap(F.translate(col(c), "_", " "))
