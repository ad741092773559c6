"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A document is a bag of hashed terms: words, word shapes and pairs of adjacent
shapes (with a sign for a word said twice running).  A truncated SVD of labelled
documents' weighted terms gives a small latent space.  The labelled documents'
vectors (a bounded number) are broadcast; every document's cosine with all of them
is computed exactly, in blocks, and its nearest neighbours vote with their
similarity as weight.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Codes, append, labelled_sample, mix, release, steps, word_codes

U = np.uint64
#: Hashed terms: words, shapes, pairs of shapes.
WORDS, SHAPES, PAIRS = 2048, 1024, 1024
TERMS = WORDS + SHAPES + PAIRS
DIMENSIONS, NEIGHBOURS, SEED = 48, 25, 11
#: Labelled documents of each class that the space and the votes use (bounds what is broadcast).
SAMPLE = 2000
#: Documents in one dense block, and words whose terms a worker keeps.
BLOCK, KEPT_WORDS = 512, 150_000

_CLASS = bytes(ord("A") if chr(b).isupper() and b < 128 else ord("a") if b >= 128 or chr(b).isalpha()
               else ord("0") if chr(b).isdigit() else b for b in range(256))
_RUN = regex.compile(rb"(.)\1+", regex.DOTALL)


def shape(word: bytes) -> bytes:
    """Letters, digits and signs of a word with runs collapsed: ``Ab12!!`` is ``Aa0!``."""
    return _RUN.sub(rb"\1", word.translate(_CLASS))


class Terms:
    """Term numbers of words, kept while they are few enough."""

    def __init__(self):
        self.codes, self.word, self.shape = Codes(), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of(self, texts: list[bytes]):
        """``(word term, shape term, code, counts)`` of all words of the texts."""
        if len(self.codes) > KEPT_WORDS:
            self.__init__()
        known = len(self.word)
        _, ids, counts = word_codes(texts, self.codes)
        fresh = list(self.codes)[known:]
        h = xxhash.xxh32_intdigest
        self.word = np.concatenate((self.word, np.fromiter((h(w.lower()) % WORDS for w in fresh), np.int64, len(fresh))))
        self.shape = np.concatenate((self.shape, np.fromiter((h(shape(w)) % SHAPES for w in fresh), np.int64, len(fresh))))
        return self.word[ids], self.shape[ids], ids, counts


def term_shares(texts: list[bytes], terms: Terms) -> np.ndarray:
    """Square roots of each term's share in its family, a row for each text."""
    word, form, ids, counts = terms.of(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    follows = np.flatnonzero(doc[1:] == doc[:-1])
    pair = (mix((form[follows] * SHAPES + form[follows + 1]).astype(U)) % U(PAIRS - 1)).astype(np.int64)
    pair = np.where(ids[follows] == ids[follows + 1], PAIRS - 1, pair)
    n = len(texts)
    out = np.empty((n, TERMS), np.float32)
    at = 0
    for d, t, width in ((doc, word, WORDS), (doc, form, SHAPES), (doc[follows], pair, PAIRS)):
        got = np.bincount(d * width + t, minlength=n * width).reshape(n, width)
        out[:, at:at + width] = np.sqrt(got / np.maximum(got.sum(1, keepdims=True), 1))
        at += width
    return out


def _blocks(texts: list[bytes]):
    for lo, hi in steps(texts):
        for a in range(lo, hi, BLOCK):
            yield a, min(a + BLOCK, hi)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


@dataclass
class Neighbours:
    """Weighted projection to the latent space, and the labelled vectors with their labels."""
    project: np.ndarray
    vectors: np.ndarray
    label: np.ndarray
    prior: float

    def embed(self, shares: np.ndarray) -> np.ndarray:
        return _unit(shares @ self.project)

    def scores(self, texts: list[bytes], terms: Terms) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors; the prior without any."""
        out = np.full(len(texts), self.prior)
        k = min(NEIGHBOURS, len(self.label))
        for lo, hi in _blocks(texts):
            cosine = self.embed(term_shares(texts[lo:hi], terms)) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < len(self.label) else \
                np.broadcast_to(np.arange(k), (hi - lo, k))
            weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 2
            total = weight.sum(1)
            vote = (weight * self.label[near]).sum(1)
            out[lo:hi] = np.where(total > 0, vote / np.where(total > 0, total, 1), self.prior)
        return np.clip(out, 0.0, 1.0)


def fit_vectors(texts: list[bytes], label: np.ndarray, dimensions: int = DIMENSIONS) -> Neighbours:
    """Latent space of the labelled texts (see ``fit_shares``)."""
    terms = Terms()
    return fit_shares(np.concatenate([term_shares(texts[lo:hi], terms) for lo, hi in _blocks(texts)]), label, dimensions)


def fit_shares(x: np.ndarray, label: np.ndarray, dimensions: int = DIMENSIONS) -> Neighbours:
    """Latent space by randomised SVD of the labelled texts' weighted terms; ``x`` is overwritten."""
    weight = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + 1
    x *= weight
    rng = np.random.default_rng(SEED)
    q = rng.standard_normal((x.shape[1], min(dimensions + 16, *x.shape)), np.float32)
    for _ in range(6):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    basis = (q @ vt.T)[:, :dimensions]
    return Neighbours(weight[:, None] * basis, _unit(x @ basis).astype(np.float32), label.astype(np.float64), float(label.mean()))


def fit_classifier(docs: DataFrame, labels: DataFrame, train, sample: int = SAMPLE) -> Neighbours | None:
    """Neighbours from up to ``sample`` rows of each class among labels where ``train`` holds; None without any."""
    rows = labelled_sample(docs, labels, "quality", train, sample).withColumn("text_hash", F.xxhash64("text"))
    rows = append(rows, _packed_shares, "terms binary, shares binary", ["doc_id", "label", "text_hash"], _forget)
    got = rows.orderBy("label", F.xxhash64("doc_id"), "doc_id", "text_hash").limit(2 * sample).select("label", "terms", "shares").toPandas()
    if not len(got):
        return None
    x = np.zeros((len(got), TERMS), np.float32)
    for row, terms, shares in zip(x, got["terms"], got["shares"]):
        row[np.frombuffer(terms, np.uint16)] = np.frombuffer(shares, np.float32)
    return fit_shares(x, got["label"].to_numpy())


def _packed_shares(texts: list[bytes]) -> list[list[bytes]]:
    """Numbers and shares of each text's terms (at most TERMS of 6 bytes): what the driver gets instead of texts."""
    numbers, shares = [], []
    for lo, hi in _blocks(texts):
        for row in term_shares(texts[lo:hi], _terms()):
            at = np.flatnonzero(row).astype(np.uint16)
            numbers.append(at.tobytes())
            shares.append(row[at].tobytes())
    return [pa.array(numbers, pa.binary()), pa.array(shares, pa.binary())]


def quality_scores(docs: DataFrame, model: Neighbours | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from 0.5 on).

    Null and empty texts have no vector and get the labelled rows' mean label; with no
    labelled rows (``model`` None) every score is 0.5.  Repeated rows repeat; other
    columns are ignored; an empty table gives an empty result.
    """
    if model is not None:
        model = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE and TERMS

    def make(texts):
        score = np.full(len(texts), 0.5) if model is None else model.value.scores(texts, _terms())
        return [score, (score >= 0.5).astype(np.int32)]

    return append(docs, make, "score double, predicted int", list(keep), _forget)


_TERMS: list[Terms] = []


def _terms() -> Terms:
    """The running task's kept terms."""
    if not _TERMS:
        _TERMS.append(Terms())
    return _TERMS[0]


def _forget() -> None:
    _TERMS.clear()
    release()


def held_out(doc_id):
    """Rows kept from fitting: crc32 of doc_id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
