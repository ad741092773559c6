"""Substring dedup by recompression.

Every word is a symbol.  A *round* names runs of one symbol and then pairs of
adjacent symbols (left half of the alphabet followed by right half, the halves
drawn anew each round from the symbol's name).  A name is a hash of what it
stands for, so it is the same in every document and on every executor.  Whether
a symbol forms depends on a few neighbours only, and each symbol carries that
*determining context* ``[lo, hi]`` in words: wherever the same context occurs,
the same symbol forms.  Equal passages therefore agree on all interior symbols.

Spark round 1 gathers the high-level symbols (with their contexts) of all
documents and tells each chunk of documents which of its symbols other chunks
hold too.  A window that contains a symbol nobody shares can't be repeated; the
windows left are the candidates.  Spark round 2 verifies candidates by the
128-bit name of the whole window: a chunk sends each candidate once, with the
smallest ``doc_id`` it starts in there, and is told which of its windows start in a
smaller ``doc_id`` elsewhere.  Repeats inside one chunk are settled there.

A chunk is a run of rows as they are read, of bounded bytes (a longer text is a
chunk of its own), so neither long texts, nor equal or null ids gather in one
task.  Chunks are written once to the shared folder.  Shuffled data are packed
arrays (sorted, as steps, in planes of bytes): 6 bytes for each symbol, 24 for each
candidate window (one per chunk, however often it occurs there) before compression,
and the compressed text of each chunk.  A passage
that a third of the corpus shares costs one entry per chunk, never a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, release, steps, text_bytes, window_starts, written

U = np.uint64
LAST = np.iinfo(np.int64).max
FAR = np.int64(1) << 40
ODD = (U(0x9E3779B97F4A7C13), U(0xD1342543DE82EF95))
SALT = mix(np.arange(1, 33, dtype=U) * ODD[1])  # of the rounds' halves of the alphabet

#: Text bytes of a chunk (what one task holds at once) and of the symbols of one bucket.
CHUNK_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20
ROUNDS = 3

#: White space, as ``bytes.split`` has it; words longer than this many bytes are named by XXH3.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
LONG_WORD, PLACES = 4096, 64
#: Random numbers for every place in a word and byte there, for both halves of a name; bytes named at once.
PLACE_NAMES = [mix(np.arange(k << 32, (k << 32) + PLACES * 256, dtype=U) * ODD[0]) for k in (1, 2)]
NAMED_BYTES = 1 << 18


def _names(texts: list[bytes]):
    """128-bit names of all words (two arrays) and the words in each text.

    A name adds up the random numbers of the word's bytes at their places.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([1], SPACE[data].view(np.int8)))))  # starts and ends of words in turn
    start, size = edge[::2], edge[1::2] - edge[::2]
    counts = np.diff(np.searchsorted(start, np.cumsum([0] + [len(t) + 1 for t in texts])))
    long = size > LONG_WORD
    part = np.where(long, 1, size)
    total = np.concatenate(([0], np.cumsum(part)))
    out, lo = [np.empty(len(start), U) for _ in PLACE_NAMES], 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + NAMED_BYTES, side="right")) - 1)
        n, begin = part[lo:hi], total[lo:hi] - total[lo]
        place = np.arange(total[hi] - total[lo], dtype=np.int32) - np.repeat(begin.astype(np.int32), n)
        entry = ((place & (PLACES - 1)) << 8) + data[np.repeat(start[lo:hi], n) + place]
        far = np.flatnonzero(place >= PLACES)
        for half, random in zip(out, PLACE_NAMES):
            value = random[entry]
            value[far] = mix(value[far] + (place[far] >> 6).astype(U) * ODD[1])
            half[lo:hi] = np.add.reduceat(value, begin)
        lo = hi
    for i in np.flatnonzero(long):
        name = xxhash.xxh3_128_intdigest(data[start[i]:start[i] + size[i]].tobytes())
        out[0][i], out[1][i] = name >> 64, name & (1 << 64) - 1
    return mix(out[0]), mix(out[1]), counts


def _window_names(a: np.ndarray, b: np.ndarray, window: int):
    """128-bit names of the windows that start at each word (the last ``window - 1`` are meaningless)."""
    out = []
    for h, odd in ((a, ODD[0]), (b, ODD[1])):
        s = np.zeros(len(h), U)
        weights = np.multiply.accumulate(np.full(window, odd, U))
        for j in range(min(window, len(h))):
            s[:len(h) - j] += h[j:] * weights[j]
        out.append(mix(s))
    return out


def _name_runs(sym, lo, hi, doc):
    """Runs of equal neighbours become one symbol named by symbol and length."""
    start = np.flatnonzero(np.concatenate(([True], (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1]))))
    size = np.diff(np.append(start, len(sym)))
    end = start + size - 1
    after = np.minimum(end + 1, len(sym) - 1)
    left = np.where((start > 0) & (doc[start] == doc[start - 1]), lo[start - 1], -FAR)
    right = np.where((end < after) & (doc[end] == doc[after]), hi[after], FAR)
    named = np.where(size > 1, mix(sym[start] + size.astype(U) * ODD[0]), sym[start])
    return named, np.minimum(lo[start], left), np.maximum(hi[end], right), doc[start]


def _symbols(h: np.ndarray, doc: np.ndarray, rounds: int):
    """Contexts ``lo, hi`` (word numbers; outside the text where its border decides) after ``rounds`` rounds."""
    sym, lo, hi = h, np.arange(len(h)), np.arange(len(h))
    for k in range(rounds):
        if k == 0:
            sym, lo, hi, doc = _name_runs(sym, lo, hi, doc)
        # Pairs: a left symbol and the right symbol after it become one.
        is_left = (mix(sym + SALT[k]) >> U(63)) == 0
        same = doc[1:] == doc[:-1]
        pair = np.append(is_left[:-1] & ~is_left[1:] & same, False)[:len(sym)]
        second = np.concatenate(([False], pair[:-1]))[:len(sym)]
        has_next, has_prev = np.append(same, False)[:len(sym)], np.concatenate(([False], same))[:len(sym)]
        nlo, nhi = np.append(lo[1:], FAR)[:len(sym)], np.append(hi[1:], FAR)[:len(sym)]
        plo, phi = np.concatenate(([-FAR], lo[:-1]))[:len(sym)], np.concatenate(([-FAR], hi[:-1]))[:len(sym)]
        nhi, nlo = np.where(has_next, nhi, FAR), np.where(has_next, nlo, FAR)
        plo, phi = np.where(has_prev, plo, -FAR), np.where(has_prev, phi, -FAR)
        lo2 = np.where(is_left, np.minimum(lo, nlo), np.minimum(lo, plo))
        hi2 = np.where(is_left, np.maximum(hi, nhi), np.maximum(hi, phi))
        nsym = np.append(sym[1:], U(0))[:len(sym)]
        sym2 = np.where(pair, mix(sym * ODD[0] + mix(nsym)), sym)
        keep = ~second
        sym, lo, hi, doc = sym2[keep], lo2[keep], hi2[keep], doc[keep]
    return lo, hi


def _keys(a: np.ndarray, counts: np.ndarray, window: int, rounds: int):
    """Symbols whose context fits a window: 48-bit name of the context, first and last word."""
    doc = np.repeat(np.arange(len(counts)), counts)
    if not len(a):
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo, hi = _symbols(a, doc, rounds)
    fits = (lo >= 0) & (hi < FAR) & (hi - lo < window)
    lo, hi = lo[fits], hi[fits]
    power = np.multiply.accumulate(np.concatenate((np.ones(1, U), np.full(len(a), ODD[0], U))))
    total = np.concatenate((np.zeros(1, U), np.cumsum(a * power[1:], dtype=U)))
    inverse = U(pow(int(ODD[0]), -1, 1 << 64))
    back = np.multiply.accumulate(np.concatenate((np.ones(1, U), np.full(len(a), inverse, U))))
    name = mix((total[hi + 1] - total[lo]) * back[lo] + (hi - lo).astype(U))
    return name >> U(16), lo, hi


def _planes(x: np.ndarray, width: int = 8) -> bytes:
    """The lowest ``width`` bytes of numbers, all first bytes, then all second bytes: the shuffle's compression drops planes of zeros."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(b: bytes, width: int = 8) -> np.ndarray:
    out = np.zeros((len(b) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(b, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def _pack48(x: np.ndarray) -> bytes:
    """Sorted 48-bit numbers as the steps between them."""
    return _planes(np.diff(x, prepend=U(0)), 6)


def _unpack48(b: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(b, 6), dtype=U)


def _pack_names(x: np.ndarray, y: np.ndarray, least: np.ndarray | None = None) -> bytes:
    """Window names sorted by their first half (whole, with the smallest doc_id; or 96 bits of each without one)."""
    steps_ = _planes(np.diff(x, prepend=U(0)))
    return steps_ + _planes(y) + _planes(least.view(U)) if least is not None else steps_ + _planes(y, 4)


def _unpack_names(b: bytes, ids: bool):
    n = len(b) // (24 if ids else 12)
    x = np.cumsum(_from_planes(b[:8 * n]), dtype=U)
    if not ids:
        return x, _from_planes(b[8 * n:], 4)
    return x, _from_planes(b[8 * n:16 * n]), _from_planes(b[16 * n:]).view(np.int64)


def _bucket_cuts(sorted_names: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Where each bucket starts: buckets are ranges of the names' highest 32 of ``bits`` bits."""
    bucket = ((sorted_names >> U(bits - 32)) * U(buckets)) >> U(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=U))


def _held(sorted_keys: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which ``x`` are among ``sorted_keys``."""
    if not len(sorted_keys):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_keys, x), len(sorted_keys) - 1)
    return sorted_keys[at] == x


def _ids(column) -> np.ndarray:
    """doc_id as int64; null sorts after every id."""
    return column.fill_null(LAST).to_numpy(zero_copy_only=False)


def _pack_text(chunk_bytes: int):
    """``(doc_id, text, kept columns)`` -> (chunk, ids, compressed texts, kept columns), one row a chunk."""
    def pack(chunk, batches, held):
        z, sink = zstandard.ZstdCompressor(level=3), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batches[0].schema) as stream:
            for b in batches:
                stream.write_batch(b)
        ids = np.concatenate([i for i, _ in held])
        texts = [t for _, ts in held for t in ts]
        rows = np.stack((ids, np.array([len(t) for t in texts], np.int64))).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), *(pa.array([x], pa.binary()) for x in (rows, z.compress(b"".join(texts)),
                                                                                 z.compress(sink.getvalue().to_pybytes())))],
            names=["chunk", "rows", "data", "kept"])

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        kept, held, size = [], [], 0
        for batch in batches:
            ids, texts = _ids(batch.column(0)), text_bytes(batch.column(1))
            rest = batch.select(batch.schema.names[2:])
            for lo, hi in steps(texts, chunk_bytes):
                more = sum(map(len, texts[lo:hi]))
                if held and size + more > chunk_bytes:
                    yield pack((part << 32) + number, kept, held)
                    kept, held, size, number = [], [], 0, number + 1
                kept.append(rest.slice(lo, hi - lo))
                held.append((ids[lo:hi], texts[lo:hi]))
                size += more
        if held:
            yield pack((part << 32) + number, kept, held)
        release()
    return run


def _emit_symbols(buckets, window, rounds):
    """Chunks -> (bucket, chunk, packed symbols), each symbol once for each chunk."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                _, texts = _unpack_text(row)
                parts = [np.zeros(0, U)]
                for lo, hi in steps(texts):
                    a, _, counts = _names(texts[lo:hi])
                    parts.append(np.unique(_keys(a, counts, window, rounds)[0]))
                keys = np.unique(np.concatenate(parts))
                cut = _bucket_cuts(keys, 48, buckets)
                full = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int64()), pa.array(np.full(len(full), row.column(0)[0].as_py()), pa.int64()),
                     pa.array([_pack48(keys[cut[j]:cut[j + 1]]) for j in full], pa.binary())],
                    names=["bucket", "chunk", "data"])
        release()
    return run


def _shared_symbols(t: pa.Table) -> pa.Table:
    """All entries of a bucket -> for each chunk its symbols that another chunk holds too."""
    parts = [_unpack48(b) for b in t.column("data").to_pylist()]
    keys = np.concatenate(parts)
    chunk = np.repeat(np.array(t.column("chunk").to_pylist(), np.int64), [len(p) for p in parts])
    order = np.lexsort((chunk, keys))
    keys, chunk = keys[order], chunk[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    first = chunk[np.flatnonzero(new)]
    group = np.cumsum(new) - 1
    many = np.bincount(group, weights=chunk != first[group]) > 0
    out_c, out_d = [], []
    fresh = np.concatenate(([True], (keys[1:] != keys[:-1]) | (chunk[1:] != chunk[:-1])))
    keys, chunk = keys[many[group] & fresh], chunk[many[group] & fresh]
    order = np.argsort(chunk, kind="stable")
    keys, chunk = keys[order], chunk[order]
    for c in np.unique(chunk):
        lo, hi = np.searchsorted(chunk, [c, c + 1])
        out_c.append(c)
        out_d.append(_pack48(keys[lo:hi]))
    return pa.table({"chunk": pa.array(out_c, pa.int64()), "data": pa.array(out_d, pa.binary())})


def _unpack_text(t):
    """The documents of a chunk: ids and texts."""
    ids, texts = [], []
    for head, blob in zip(t.column("rows").to_pylist(), t.column("data").to_pylist()):
        i, sizes = np.frombuffer(head, np.int64).reshape(2, -1)
        data = memoryview(zstandard.ZstdDecompressor().decompress(blob))
        cut = np.concatenate(([0], np.cumsum(sizes)))
        texts += [bytes(data[cut[k]:cut[k + 1]]) for k in range(len(sizes))]
        ids.append(i)
    return np.concatenate(ids), texts


def _unpack_kept(t: pa.Table) -> pa.Table:
    unpack = zstandard.ZstdDecompressor()
    return pa.concat_tables(pa.ipc.open_stream(unpack.decompress(b)).read_all() for b in t.column("kept").to_pylist())


def _first_of(order: np.ndarray, *names: np.ndarray) -> np.ndarray:
    """Which sorted entries differ from the one before."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for n in names:
        new[1:] |= n[order[1:]] != n[order[:-1]]
    return new


def _candidates(buckets, window, rounds):
    """A chunk's texts and shared symbols -> (bucket, chunk, windows that another chunk may hold, their smallest doc_id)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()),
                          "data": pa.array([], pa.binary())})
        if not left.num_rows:
            return empty
        chunk = left.column("chunk")[0].as_py()
        shared = np.sort(np.concatenate([np.zeros(0, U), *map(_unpack48, right.column("data").to_pylist())]))
        ids, texts = _unpack_text(left)
        found = [(np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64))]
        for lo, hi in steps(texts):
            a, b, counts = _names(texts[lo:hi])
            if len(a) < window:
                continue
            key, first, last = _keys(a, counts, window, rounds)
            alone = ~_held(shared, key)
            change = np.zeros(len(a) + 1, np.int32)
            np.add.at(change, np.maximum(last[alone] - window + 1, 0), 1)
            np.add.at(change, first[alone] + 1, -1)
            start = window_starts(counts, window)
            start = start[np.cumsum(change)[start] == 0]
            x, y = _window_names(a, b, window)
            found.append((x[start], y[start], np.repeat(ids[lo:hi], counts)[start]))
        x, y, least = (np.concatenate(v) for v in zip(*found))
        order = np.lexsort((least, y, x))
        order = order[_first_of(order, x, y)]
        x, y, least = x[order], y[order], least[order]
        release()
        cut = _bucket_cuts(x, 64, buckets)
        full = np.flatnonzero(np.diff(cut))
        return pa.table({"bucket": pa.array(full, pa.int64()),
                         "chunk": pa.array(np.full(len(full), chunk), pa.int64()),
                         "data": pa.array([_pack_names(*(v[cut[j]:cut[j + 1]] for v in (x, y, least))) for j in full], pa.binary())})
    return run


def _earlier_windows(t: pa.Table) -> pa.Table:
    """All candidates of a bucket -> for each chunk its windows that start in a smaller doc_id of another chunk."""
    parts = [_unpack_names(b, True) for b in t.column("data").to_pylist()]
    x, y, least = (np.concatenate(v) for v in zip(*parts))
    chunk = np.repeat(np.array(t.column("chunk").to_pylist(), np.int64), [len(p[0]) for p in parts])
    order = np.lexsort((least, y, x))
    new = _first_of(order, x, y)
    smallest = least[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
    order = order[smallest < least[order]]
    order = order[np.argsort(chunk[order], kind="stable")]
    x, y, chunk = x[order], y[order], chunk[order]
    out_c, out_d = [], []
    for c in np.unique(chunk):
        lo, hi = np.searchsorted(chunk, [c, c + 1])
        out_c.append(c)
        out_d.append(_pack_names(x[lo:hi], y[lo:hi]))
    return pa.table({"chunk": pa.array(out_c, pa.int64()), "data": pa.array(out_d, pa.binary())})


RESULT = "n_words bigint, n_removed bigint, kept string, removed array<struct<first:bigint,words:bigint>>"
_RUNS = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))


def _runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return [{"first": int(f), "words": int(e - f)} for f, e in zip(edge[::2], edge[1::2])]


def _finish(window, tidy):
    """A chunk's texts and the windows that start in earlier chunks -> the kept text of each document."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        told = [(np.zeros(0, U),) * 2, *(_unpack_names(b, False) for b in right.column("data").to_pylist())]
        told_x, told_y = (np.concatenate(v) for v in zip(*told))
        order = np.argsort(told_x, kind="stable")
        told_x, told_y = told_x[order], told_y[order]
        ids, texts = _unpack_text(left)
        xs, ys, counts, outside = [], [], [], []
        for lo, hi in steps(texts):
            a, b, n = _names(texts[lo:hi])
            start = window_starts(n, window)
            x, y = (v[start] for v in _window_names(a, b, window))
            hit = _held(told_x, x)
            if hit.any():  # of the second half too
                hit[hit] = told_y[np.searchsorted(told_x, x[hit])] == y[hit] & U(0xFFFFFFFF)
            xs.append(x)
            ys.append(y)
            outside.append(hit)
            counts.append(n)
        x, y, hit, counts = (np.concatenate(v) for v in (xs, ys, outside, counts))
        start = window_starts(counts, window)
        if len(x):  # windows that occur again in the chunk
            values = np.sort(x)
            again = np.flatnonzero(_held(np.unique(values[1:][values[1:] == values[:-1]]), x))
            sid = ids[np.repeat(np.arange(len(counts)), counts)[start[again]]]
            order = np.lexsort((sid, y[again], x[again]))
            new = _first_of(order, x[again], y[again])
            smallest = sid[order[np.flatnonzero(new)]][np.cumsum(new) - 1]
            hit[again[order]] |= sid[order] > smallest
        change = np.zeros(int(counts.sum()) + 1, np.int32)
        change[start[hit]] += 1
        np.add.at(change, start[hit] + window, -1)
        gone = np.cumsum(change)[:-1] > 0
        cut = np.concatenate(([0], np.cumsum(counts)))
        kept, removed, n_removed = [], [], []
        for k, t in enumerate(texts):
            mask, words = gone[cut[k]:cut[k + 1]], t.split()
            n = int(mask.sum())
            if n:
                words = [w for w, g in zip(words, mask.tolist()) if not g]
            kept.append(b" ".join(words) if n or tidy else t)
            removed.append(_runs(mask) if n else [])
            n_removed.append(n)
        out = _unpack_kept(left)
        for name, column in (("n_words", pa.array(counts, pa.int64())), ("n_removed", pa.array(n_removed, pa.int64())),
                             ("kept", pa.array(kept, pa.binary()).cast(pa.string())), ("removed", pa.array(removed, _RUNS))):
            out = out.append_column(name, column)
        release()
        return out
    return run


def substring_dedup(docs: DataFrame, window: int = 13, rounds: int = ROUNDS, keep: tuple[str, ...] = ("doc_id",), tidy: bool = True,
                    chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Remove every word covered by a ``window``-word passage that also starts in a smaller ``doc_id``.

    Returns one row for each input row: ``keep`` columns, ``n_words, n_removed, kept``
    (kept words joined by one space; without ``tidy`` a text that loses nothing stays
    as it is) and ``removed`` (runs of removed words).  Windows are judged on the
    input.  Rows that share a ``doc_id`` don't remove each other's words; a null
    ``doc_id`` counts as larger than every id; a null or empty text has no words; texts
    of fewer than ``window`` words lose none; other columns are ignored.  An empty table
    gives an empty result.
    """
    keep = tuple(dict.fromkeys(keep))
    clash = {"n_words", "n_removed", "kept", "removed"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} to be kept have names of the result")
    src = docs.select(F.col("doc_id").cast("bigint").alias("__id"), F.col("text").cast("string").alias("__text"),
                      *(F.col(f"`{c}`") for c in keep))
    texts = written(src.mapInArrow(_pack_text(chunk_bytes), "chunk bigint, rows binary, data binary, kept binary"), "chunks")
    size = texts.agg(F.count(F.lit(1))).first()[0] * chunk_bytes
    buckets = 1 + size // bucket_bytes
    shared = (texts.select("chunk", "rows", "data").mapInArrow(_emit_symbols(buckets, window, rounds), "bucket bigint, chunk bigint, data binary")
              .groupBy("bucket").applyInArrow(_shared_symbols, "chunk bigint, data binary"))
    chunks = texts.groupBy("chunk")  # both cogroups read one exchange
    earlier = (chunks.cogroup(shared.groupBy("chunk"))
               .applyInArrow(_candidates(buckets, window, rounds), "bucket bigint, chunk bigint, data binary")
               .groupBy("bucket").applyInArrow(_earlier_windows, "chunk bigint, data binary"))
    kinds = dict(docs.dtypes)
    return chunks.cogroup(earlier.groupBy("chunk")).applyInArrow(
        _finish(window, tidy), ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), RESULT]))
