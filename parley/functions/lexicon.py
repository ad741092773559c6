"""Lexicon sums and word counts of many texts at once (numpy over code points, inside tasks).

The texts of a batch are one array of code points, of one byte each where all are below
256.  Tokens are its runs of letters, digits and apostrophes; those that share the first
character and length of a rule are hashed, and tokens whose hash is that of a rule are
compared with it in full.  So a text costs a few passes over its code points, however
many rules there are.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

from . import constants as K
from .text import PY_WHITESPACE

#: Code points that one step holds (a longer text is a step of its own).
STEP_CHARS = 1 << 18
#: Odd factor of the token hash (modulo 2**64).
FACTOR = 0x9E3779B97F4A7C15
#: Unicode's White_Space: what separates words.
SPACES = [ord(c) for c in PY_WHITESPACE if not "\x1c" <= c <= "\x1f"]


#: Kinds of characters: parts of tokens, spaces, those with another lower case, with another upper case.
WORD, SPACE, CAPITAL, SMALL = 1, 2, 4, 8


@lru_cache(maxsize=1)
def char_tables() -> tuple[np.ndarray, np.ndarray]:
    """The kinds of each code point (bits), and its lower case."""
    n, cased = 0x110000, 0x20000  # beyond ``cased`` there are letters without case only
    chars = [chr(c) for c in range(cased)]
    lower = [x.lower() for x in chars]
    kinds, low = np.array([chr(c).isalpha() for c in range(n)]).astype(np.uint8) * WORD, np.arange(n, dtype=np.uint32)
    kinds[:cased] |= np.array([WORD * (unicodedata.category(x)[0] == "N") + CAPITAL * (x != y) + SMALL * (x != x.upper())
                               for x, y in zip(chars, lower)], np.uint8)
    kinds[ord("'")] = WORD
    kinds[SPACES] = SPACE
    low[:cased] = [ord(x) if len(x) == 1 else c for c, x in enumerate(lower)]
    return kinds, low


@lru_cache(maxsize=1)
def byte_tables() -> tuple[bytes, bytes]:
    """The same of the code points below 256, whose lower cases are below 256 too, for ``bytes.translate``."""
    kinds, low = char_tables()
    return kinds[:256].tobytes(), low[:256].astype(np.uint8).tobytes()


def _hash(word: np.ndarray) -> int:
    total = 0
    for i, c in enumerate(word.tolist()):
        total += c * pow(FACTOR, i, 1 << 64)
    return total % (1 << 64)


class Rules:
    """Rule rows ``(token, valence, is_lex, is_neg, boost, is_but)`` of single tokens, as arrays."""

    def __init__(self, rows):
        words = [np.array([ord(c) for c in r[0]], np.uint32) for r in rows]
        hashes = np.array([_hash(w) for w in words], np.uint64)
        order = np.argsort(hashes)
        if len(np.unique(hashes)) < len(rows):
            raise ValueError("two rule tokens have one hash")
        self.hash = hashes[order]
        self.size = np.array([len(words[i]) for i in order])
        self.chars = np.zeros((len(rows), int(self.size.max(initial=1))), np.uint32)
        for k, i in enumerate(order):
            self.chars[k, :len(words[i])] = words[i]
        column = lambda j, kind: np.array([rows[i][j] for i in order], kind)
        self.valence, self.lex, self.neg, self.boost, self.but = (
            column(1, float), column(2, bool), column(3, bool), column(4, float), column(5, bool))
        self.modifier = ~self.lex & (self.neg | (self.boost != 0))

    def find(self, low, starts, ends) -> np.ndarray:
        """The rule of each token, -1 for none."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.hash) or not len(starts):
            return out
        longest, codes = self.chars.shape[1], 256 if low.dtype == np.uint8 else 0x110000
        heads, head = np.unique(self.chars[:, 0], return_inverse=True)
        head_of = np.zeros(codes, np.int32)
        head_of[heads[heads < codes]] = np.flatnonzero(heads < codes) + 1
        alike = np.zeros((len(heads) + 1, longest + 2), bool)  # by first character and length
        alike[head + 1, self.size] = True
        some = np.flatnonzero(alike[head_of[low[starts]], np.minimum(ends - starts, longest + 1)])
        if not len(some):
            return out
        a, b = starts[some], ends[some]
        h, power, more = np.zeros(len(some), np.uint64), 1, np.arange(len(some))
        for j in range(longest):
            more = more[b[more] - a[more] > j]
            h[more] += low[a[more] + j] * np.uint64(power)
            power = power * FACTOR % (1 << 64)
        at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        same = (self.hash[at] == h) & (self.size[at] == b - a)
        some, at, a = some[same], at[same], a[same]
        same = np.ones(len(some), bool)
        for j in range(self.chars.shape[1]):
            more = j < self.size[at]
            same &= ~more | (low[np.where(more, a + j, a)] == self.chars[at, j])
        out[some[same]] = at[same]
        return out


def _bytes(text: str) -> bytes | None:
    """The code points, one byte each; None if one is above 255."""
    try:
        return text.encode("latin-1")
    except UnicodeEncodeError:
        return None


def _sums(texts: list[str], rules: Rules):
    """``(sum, emphasis, has a lexicon token, words)`` of each text; see ``sentiment.score_texts``."""
    n = len(texts)
    size = np.fromiter(map(len, texts), np.int64, n) + 1
    begin = np.cumsum(size) - size
    joined = "\n".join(texts) + "\n"
    narrow = _bytes(joined)
    if narrow is not None:
        kind, low = (np.frombuffer(narrow.translate(t), np.uint8) for t in byte_tables())
        cp = np.frombuffer(narrow, np.uint8)
    else:
        kinds, lower = char_tables()
        cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        kind, low = kinds.take(cp), lower.take(cp)
    gap = kind & SPACE != 0
    word = np.flatnonzero(gap[:-1] > gap[1:]) + 1
    words = np.diff(np.searchsorted(word, np.append(begin, len(cp)))) + (np.arange(n) == 0) * (not gap[0])

    inside = kind & WORD != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[::2], edge[1::2]
    sigma = np.flatnonzero(cp == 0x3A3) if narrow is None else ()  # its lower case depends on its place in the token
    for k in np.unique(np.searchsorted(starts, sigma, side="right") - 1) if len(sigma) else ():
        token = joined[starts[k]:ends[k]].lower()
        if len(token) == ends[k] - starts[k]:
            low[starts[k]:ends[k]] = [ord(c) for c in token]
    rule = rules.find(low, starts, ends)
    first = np.searchsorted(starts, np.append(begin, len(cp)))  # the first token of each text
    matched = np.flatnonzero(rule >= 0)
    hit = matched[rules.lex[rule[matched]]]
    total, has = np.zeros(n), np.zeros(n, bool)
    if not len(hit):
        return total, np.zeros(n), has, words

    text_of = np.repeat(np.arange(n), np.diff(first))
    text = text_of[hit]
    has[text] = True
    loud = np.zeros(len(starts), bool)
    some = np.flatnonzero((kind[starts] | kind[ends - 1]) & SMALL == 0)
    if len(some):
        length = ends[some] - starts[some]
        stop = np.cumsum(length)
        chars = kind[np.arange(stop[-1]) + np.repeat(starts[some] - (stop - length), length)]
        every = np.bitwise_or.reduceat(chars, stop - length)
        loud[some] = every & (CAPITAL | SMALL) == CAPITAL
        loud &= (np.bincount(text_of, loud, n) < np.diff(first))[text_of]  # in a text that isn't all capitals
    never = np.iinfo(np.int64).max
    turn = np.full(n, never)
    but = matched[rules.but[rule[matched]]]
    np.minimum.at(turn, text_of[but], but)

    v = rules.valence[rule[hit]]
    v = v + np.where(loud[hit], np.sign(v) * K.CAPITALS_INCREMENT, 0.0)
    for k, fade in enumerate(K.MODIFIER_FADE, 1):
        at = np.maximum(hit - k, 0)
        m = np.where(hit - k >= first[text], rule[at], -1)
        applies = (m >= 0) & rules.modifier[m]
        boost = rules.boost[m]
        step = np.where(v < 0, -boost, boost) + np.where(loud[at], np.where(v > 0, K.CAPITALS_INCREMENT, -K.CAPITALS_INCREMENT), 0.0)
        v = v + np.where(applies & (boost != 0), step * fade, 0.0)
        v = v * np.where(applies & rules.neg[m], K.NEGATION_SCALAR, 1.0)
    change = turn[text]
    v = v * np.where(change == never, 1.0, np.where(hit < change, K.CONTRAST_BEFORE, np.where(hit > change, K.CONTRAST_AFTER, 1.0)))
    total = np.bincount(text, v, n)
    bangs, asked = (np.bincount(np.searchsorted(begin, np.flatnonzero(cp == ord(c)), side="right") - 1, minlength=n) for c in "!?")
    emphasis = (np.minimum(bangs, K.EXCLAMATION_MAX) * K.EXCLAMATION_INCREMENT
                + np.where(asked > 3, K.QUESTION_MANY, np.where(asked > 1, asked * K.QUESTION_INCREMENT, 0.0)))
    return total, emphasis, has, words


def _step_sums(texts: list[str], rules: Rules):
    """``_sums``, texts with code points above 255 apart from the others."""
    wide = np.zeros(len(texts), bool) if _bytes("".join(texts)) is not None else np.array([_bytes(x) is None for x in texts])
    if wide.all() or not wide.any():
        return _sums(texts, rules)
    places = [np.flatnonzero(~wide), np.flatnonzero(wide)]
    order = np.argsort(np.concatenate(places))
    return tuple(np.concatenate(x)[order] for x in zip(*(_sums([texts[i] for i in at], rules) for at in places)))


def text_sums(texts, rules: Rules):
    """``_sums`` of any number of texts (null: empty), a bounded number of code points at a time."""
    texts = [x or "" for x in texts]
    end = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    parts, at = [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(end, (end[at - 1] if at else 0) + STEP_CHARS, side="right")))
        parts.append(_step_sums(texts[at:to], rules))
        at = to
    if not parts:
        return np.zeros(0), np.zeros(0), np.zeros(0, bool), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))
