"""Document fingerprints by improbable features.

Every byte window has an entropy; how often a window's entropy occurs over all
windows of the corpus is its rarity rank.  Among each run of neighbouring windows
the rarest (first of equals) gets a vote, and windows with enough votes are the
document's features.  Their hashes go into chained Bloom filters of fixed size.
Two fingerprints are compared filter by filter: bits in common beyond what chance
gives, over the most there can be.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from hashlib import sha256
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, steps, text_bytes

U = np.uint64
#: Bytes of a window, windows that vote together, votes that make a feature.
WINDOW, NEIGHBOURS, VOTES = 32, 64, 16
#: Bits of a filter, features that fill one, bits that a feature sets.
FILTER_BITS, FILTER_FEATURES, HASHES = 2048, 160, 5
BINS = 1000
LAST = np.iinfo(np.int64).max
CHUNK_BYTES, STEP = 16 << 20, 1 << 20

#: c * log2(c) in fixed point for every count in a window, so that sums are exact.
_TERM = np.array([0] + [round(c * np.log2(c) * (1 << 20)) for c in range(1, WINDOW + 1)], np.int64)
_GAIN = np.diff(_TERM, prepend=0)


def entropy_bins(x: np.ndarray) -> np.ndarray:
    """Entropy in thousandths of its maximum for the window that starts at each byte but the last few."""
    n = len(x)
    if n < WINDOW:
        return np.zeros(0, np.int16)
    order = np.argsort(x, kind="stable")
    key = x[order].astype(np.int64) * (n + WINDOW) + order
    first = np.searchsorted(key, key - WINDOW + 1)  # of the same byte value within the window that ends here
    back, ahead = np.empty(n, np.int64), np.empty(n, np.int64)
    back[order] = np.arange(n) - first + 1
    ahead[order] = np.cumsum(np.bincount(first, minlength=n))[:n] - np.arange(n)
    # Sliding sum of c log c: take the first byte out of the window, then put the next one in.
    total = np.cumsum(_GAIN[back])
    total[WINDOW:] -= np.cumsum(_GAIN[ahead[:-WINDOW]])
    return (BINS - total[WINDOW - 1:] * BINS // _TERM[WINDOW]).astype(np.int16)


def _text_bins(texts: list[bytes]) -> list[np.ndarray]:
    """Entropy bins of the windows within each text."""
    out = []
    for lo, hi in steps(texts, STEP):
        got = entropy_bins(np.frombuffer(b"".join(texts[lo:hi]), np.uint8))
        at = 0
        for t in texts[lo:hi]:
            out.append(got[at:at + max(0, len(t) - WINDOW + 1)])
            at += len(t)
    return out


def _ids(column) -> np.ndarray:
    return np.array([LAST if x is None else x for x in column.to_pylist()], np.int64)


def rarity_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of every entropy bin by how many windows of all documents have it: 0 is the rarest."""
    def run(batches):
        for batch in batches:
            total = np.zeros(BINS + 1, np.int64)
            for b in _text_bins(text_bytes(batch.column(0))):
                total += np.bincount(b, minlength=BINS + 1)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bin", "n"])

    got = docs.select(F.col("text").cast("string")).mapInArrow(run, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n").alias("n"))
    counts = np.zeros(BINS + 1, np.int64)
    for r in got.collect():  # BINS + 1 rows at most
        counts[r["bin"]] = r["n"]
    ranks = np.empty(BINS + 1, np.int64)
    ranks[np.lexsort((np.arange(BINS + 1), counts))] = np.arange(BINS + 1)
    return ranks


def select_features(bins: list[np.ndarray], ranks: np.ndarray) -> list[np.ndarray]:
    """Starts of the feature windows of each text, ascending; at least one where there is a window."""
    sizes = np.fromiter(map(len, bins), np.int64, len(bins))
    end = np.cumsum(sizes)
    total = int(end[-1]) if len(end) else 0
    if not total:
        return [np.zeros(0, np.int64) for _ in bins]
    key = (ranks[np.concatenate(bins)] << 40) | np.arange(total)
    low, width = key, 1
    while width < NEIGHBOURS:  # the least of a run of windows, by doubling
        step = min(width, NEIGHBOURS - width)
        low = np.minimum(low[:len(low) - step], low[step:]) if len(low) > step else low[:0]
        width += step
    votes = np.zeros(total, np.int64)
    if len(low):
        starts = np.arange(len(low))
        whole = starts + NEIGHBOURS <= np.repeat(end, sizes)[:len(low)]
        votes += np.bincount(low[whole] & ((1 << 40) - 1), minlength=total)
    rows = np.flatnonzero(sizes)
    best = np.minimum.reduceat(key, (end - sizes)[rows]) & ((1 << 40) - 1)
    votes[best] += NEIGHBOURS  # the rarest window of a text always counts
    at = np.flatnonzero(votes >= VOTES)
    cut = np.searchsorted(at, end)
    return [at[a:b] - (e - s) for a, b, e, s in zip(np.concatenate(([0], cut[:-1])), cut, end, sizes)]


def _feature_bits(text: bytes, at: np.ndarray) -> np.ndarray:
    """The bits that each feature sets (a row each), features once each in order of first place."""
    if not len(at):  # shorter than a window: the text itself is the feature
        if not text:
            return np.zeros((0, HASHES), np.int64)
        h = np.frombuffer(sha256(text).digest()[:8], U)
    else:
        raw = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), WINDOW)[at]
        words = np.ascontiguousarray(raw).view("<u8").astype(U)
        h = np.zeros(len(at), U)
        for k in range(words.shape[1]):
            h = mix(h ^ words[:, k])
        h = h[np.sort(np.unique(h, return_index=True)[1])]
    return np.stack([(h >> U(11 * k)) & U(FILTER_BITS - 1) for k in range(HASHES)], 1).astype(np.int64)


def bloom_chain(text: bytes, at: np.ndarray) -> np.ndarray:
    """Chained filters, a row of ``FILTER_BITS // 8`` bytes each."""
    bits = _feature_bits(text, at)
    n = -(-len(bits) // FILTER_FEATURES)
    flat = np.zeros((n, FILTER_BITS), np.uint8)
    flat[np.repeat(np.arange(len(bits)) // FILTER_FEATURES, HASHES), bits.ravel()] = 1
    return np.packbits(flat, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: the mean over the shorter chain's filters of the best normalised bit overlap; 1 for equal chains."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    na, nb = np.bitwise_count(a).sum(1, dtype=np.int64), np.bitwise_count(b).sum(1, dtype=np.int64)
    total = 0.0
    for x, n in zip(a, na):
        common = np.bitwise_count(x & b).sum(1, dtype=np.int64)
        chance, most = n * nb / FILTER_BITS, np.minimum(n, nb)
        total += float(np.max(np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1)))
    return min(total / len(a), 1.0)


def fingerprint(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Filter chains of whole texts."""
    return [bloom_chain(t, at) for t, at in zip(texts, select_features(_text_bins(texts), ranks))]


def edited(text: str, other: str) -> tuple[bytes, bytes]:
    """The two parts of an edited text: all but the last half of ``text``, and as much of the start of ``other``."""
    half = len(text) // 2
    return text[:len(text) - half].encode(), other[:half].encode()


def _edited_bins(parts, bins, next_bins) -> list[np.ndarray]:
    """Bins of joined parts: those of windows inside a part are known, those across the seam are computed."""
    seams = [a[max(0, len(a) - WINDOW + 1):] + b[:WINDOW - 1] for a, b in parts]
    out = []
    for (a, b), own, other, seam in zip(parts, bins, next_bins, _text_bins(seams)):
        out.append(np.concatenate((own[:max(0, len(a) - WINDOW + 1)], seam, other[:max(0, len(b) - WINDOW + 1)])))
    return out


def _deal(bounds):
    """Documents -> rows ``chunk, head, rows, data``; a batch's first document of a chunk goes to the chunk before too."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, texts = _ids(batch.column(0)), text_bytes(batch.column(1))
            chunks = np.searchsorted(bounds, ids, side="right")
            out = []
            for c in np.unique(chunks):
                rows = np.flatnonzero(chunks == c)
                out.append((int(c), False, ids[rows], [texts[i] for i in rows]))
                least = min(rows, key=lambda i: (ids[i], texts[i]))
                # Chunk 0 may be empty, so its and chunk 1's first documents both go round to the end.
                before = ([c - 1] if c else []) + ([len(bounds)] if c <= 1 else [])
                out += [(int(to), True, ids[[least]], [texts[least]]) for to in before]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.bool_()),
                 pa.array([np.stack((o[2], np.array(list(map(len, o[3])), np.int64))).tobytes() for o in out], pa.binary()),
                 pa.array([pack.compress(b"".join(o[3])) for o in out], pa.binary())], names=["chunk", "head", "rows", "data"])
    return run


def _unpacked(t: pa.Table, head: bool) -> list[tuple[int, bytes]]:
    """``(doc_id, text)`` of the packed rows, in order."""
    out = []
    for is_head, rows, data in zip(*(t.column(c).to_pylist() for c in ("head", "rows", "data"))):
        if is_head == head:
            ids, sizes = np.frombuffer(rows, np.int64).reshape(2, -1)
            raw, at = zstandard.ZstdDecompressor().decompress(data), 0
            for i, n in zip(ids.tolist(), sizes.tolist()):
                out.append((i, raw[at:at + n]))
                at += n
    out.sort()
    return out


RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _compare(last_chunk: int, ranks: np.ndarray):
    """One chunk's documents, each with the next: fingerprints and likenesses."""
    def run(t: pa.Table) -> pa.Table:
        docs, heads = _unpacked(t, False), _unpacked(t, True)
        out: list[tuple] = []
        if docs:
            # After the end comes the next chunk's first document; the last chunk gets the very first one.
            docs.append(heads[0])
            sizes = [len(x) for _, x in docs]
            at = 0
            while at < len(docs) - 1:
                to, size = at, 0
                while to < len(docs) - 1 and (to == at or size + sizes[to] <= STEP):
                    size += sizes[to]
                    to += 1
                texts = [x for _, x in docs[at:to + 1]]
                bins = _text_bins(texts)
                chains = [bloom_chain(x, f) for x, f in zip(texts, select_features(bins, ranks))]
                whole = [x.decode() for x in texts]
                parts = [edited(a, b) for a, b in zip(whole, whole[1:])]
                picked = select_features(_edited_bins(parts, bins, bins[1:]), ranks)
                for k, (a, b) in enumerate(parts):
                    new = bloom_chain(a + b, picked[k])
                    i = docs[at + k][0]
                    out.append((None if i == LAST else i, len(whole[k]), sha256(a + b).hexdigest(), chains[k].tobytes().hex(),
                                new.tobytes().hex(), likeness(chains[k], new), likeness(chains[k], chains[k + 1])))
                at = to
        names = [x.split()[0] for x in RESULT.split(", ")]
        return pa.table({n: pa.array([r[k] for r in out], kind) for k, (n, kind) in enumerate(zip(names, _KINDS))})
    return run


def document_fingerprints(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and likenesses to that and to the next document.

    The edited text is the text with its last ``floor(n_chars / 2)`` code points
    replaced by the first as many (or all) of the next document by ascending
    ``doc_id`` (ties by text; null ids last; after the last comes the first; a lone
    document is its own next).  A null text is empty; an empty text has the empty
    fingerprint, which is like another empty one (1) and nothing else (0); a text
    shorter than a window is one feature.  Repeated rows repeat; other columns are
    ignored; an empty table gives an empty result.
    """
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = 1 + size // chunk_bytes
    # Quantiles as the ids' own type: a double would round large ids to bounds that no document has.
    part = F.percentile_approx("doc_id", [i / chunks for i in range(1, chunks)] or [0.5], min(10_000_000, max(10_000, 5 * chunks)))
    cuts = (src.agg(part.alias("q")).first()["q"] or []) if chunks > 1 else []
    bounds = np.unique(np.array(cuts, np.int64))
    ranks = rarity_ranks(src.select("text"))
    return (src.mapInArrow(_deal(bounds), "chunk bigint, head boolean, rows binary, data binary")
            .groupBy("chunk").applyInArrow(_compare(len(bounds), ranks), RESULT))
