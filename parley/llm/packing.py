"""Packing by minimum bin slack.

Documents become token ids and one end id.  Whole windows are cut off first; what
remains of each document is shorter than a window.  Only the number of remainders
of each length matters for packing, and that histogram has fewer entries than a
window has tokens, however many documents there are.  The driver fills windows from
it: the longest length left, then the multiset of other lengths that comes closest
to the capacity, found by a subset-sum over a bitset and traced back to counts.
Each such pattern is used as often as the counts allow, so there are few patterns.
Pieces are counted as they are written, by task and length; a piece's rank among
those of its length is what earlier tasks have of it and its number in its own task,
so no rows are sorted or gathered to rank them, and each remainder finds its window
in the patterns' table by length and rank.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .bpe import PATTERN, Automaton, Kept, _parts, _source, load_spec
from .common import written

WINDOW, END_ID = 2048, 1
#: Texts between two spaces that a worker keeps encoded in each of two generations.
KEPT_CHUNKS = 200_000


class FastEncoder(Automaton):
    """The same ids by the tiktoken library, where the vocabulary's ids follow its merges; else by the automaton."""

    def __init__(self, spec: bytes):
        super().__init__(spec)
        steps = [(k, i) for i, k in enumerate(self.step) if k >= 0]
        self.ordered = [i for _, i in sorted(steps)] == sorted(i for _, i in steps)
        if self.ordered:
            ranks = {x: i for i, x in enumerate(self.labels) if x is not None and i not in self.special.values()}
            plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.chunk = lambda c: np.array(plain.encode_ordinary(c), "<u4").tobytes()
            self.chunks = Kept(lambda c: self.chunk(" " + c), KEPT_CHUNKS)


_ENCODER: dict[int, FastEncoder] = {}


def _encoder(spec) -> FastEncoder:
    """This worker's encoder of a broadcast tokenizer file."""
    key = zlib.crc32(spec.value)
    if key not in _ENCODER:
        _ENCODER[key] = FastEncoder(spec.value)
    return _ENCODER[key]


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
PIECE_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def pieces(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Whole windows and the remainder of each document's ids with the end id; ``ids`` too if asked for.

    ``task`` and ``nth`` number the pieces of one length in each task from 0.
    """
    spec = load_spec(docs.sparkSession, path)

    def run(batches):
        encoder, end = _encoder(spec), np.array([END_ID], "<u4")
        task, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in _parts(batches):
            rows, ids = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                all_ids = np.concatenate((encoder.encode(text or ""), end))
                for at in range(0, len(all_ids), window):
                    piece = all_ids[at:at + window]
                    rows.append((i, at, len(piece), zlib.crc32(piece.tobytes()), len(all_ids), task, int(seen[len(piece)])))
                    seen[len(piece)] += 1
                    if with_ids:
                        ids.append(piece.astype(np.int32))
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(7)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=names + ["ids"] * with_ids)

    return _source(docs).mapInArrow(run, PIECES + ", task bigint, nth bigint" + ", ids array<int>" * with_ids)


def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (within their counts) whose sum comes closest to ``capacity`` from below.

    ``reach`` has bit ``s`` set if some multiset sums to ``s``.  Lengths are added in
    chunks of 1, 2, 4, ... copies, longest length first, until the capacity itself is
    reached; the chunks are then traced back from the highest bit.
    """
    reach, mask, taken = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted((x for x in counts if x <= capacity and counts[x]), reverse=True):
        left, copies = min(counts[length], capacity // length), 1
        while left and not reach >> capacity & 1:
            n = min(copies, left)
            taken.append((length, n, reach))
            reach |= reach << (n * length) & mask
            left, copies = left - n, copies * 2
        if reach >> capacity & 1:
            break
    at, out = reach.bit_length() - 1, {}
    for length, n, before in reversed(taken):
        if not before >> at & 1:
            at -= n * length
            out[length] = out.get(length, 0) + n
    return out


@dataclass
class Slots:
    """Where the remainders of each length go, by rank: rows sorted by length and first rank."""
    length: np.ndarray
    first: np.ndarray   # rank of the first remainder that this row places
    window: np.ndarray  # its window; the next ranks go to the next windows
    offset: np.ndarray
    windows: int        # all windows of the patterns


def plan(histogram: dict[int, int], window: int = WINDOW) -> Slots:
    """Minimum-bin-slack patterns for remainders of the given lengths.

    A pattern is repeated until the counts of one of its lengths run out, so there are
    about twice as many patterns as lengths at most, for any number of documents.
    """
    counts = {x: n for x, n in histogram.items() if n}
    used = dict.fromkeys(counts, 0)
    rows: list[tuple[int, int, int, int]] = []
    windows = 0
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        fill = closest_fill(counts, window - longest)
        counts[longest] += 1
        fill[longest] = fill.get(longest, 0) + 1
        repeat, at = min(counts[x] // n for x, n in fill.items()), 0
        for x in sorted(fill, reverse=True):
            for _ in range(fill[x]):
                rows.append((x, used[x], windows, at))
                used[x] += repeat
                at += x
            counts[x] -= fill[x] * repeat
        counts = {x: n for x, n in counts.items() if n}
        windows += repeat
    return Slots(*np.array(sorted(rows), np.int64).reshape(-1, 4).T, windows=windows)


def _ranked(cut: DataFrame, counts: DataFrame) -> DataFrame:
    """Rank (from 0) among the pieces of the same length: by task, then by number in the task.

    ``counts`` has a row for each task and length; a task's pieces of one length are what
    it cut from its own input.
    """
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    earlier = counts.select("task", "length", before.alias("before"))
    return (cut.join(earlier, ["task", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
            .drop("task", "nth", "before"))


def _place(slots: Slots, window: int):
    """Ranked pieces -> the same with their sequence and offset; a whole window is a sequence of its own."""
    key = slots.length * (1 << 48) + slots.first

    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = slots.windows + rank, np.zeros(len(rank), np.int64)
            short = np.flatnonzero(length < window)
            at = np.searchsorted(key, length[short] * (1 << 48) + rank[short], side="right") - 1
            sequence[short] = slots.window[at] + rank[short] - slots.first[at]
            offset[short] = slots.offset[at]
            keep = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)],
                                             names=keep + ["sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """Every document's ids and end id in sequences of at most ``window`` tokens, a row for each piece.

    Columns: ``doc_id, start, length, ids_crc32, doc_tokens``, ``ids`` if asked for, and
    ``sequence_id, offset``.  Pieces of a sequence follow each other from offset 0
    without gaps; what is missing up to ``window`` is padding.  A null or empty text is
    its end id alone; a null ``doc_id`` stays null; repeated rows are packed each; other
    columns are ignored; an empty table gives an empty result.
    """
    cut = written(pieces(docs, path, window, with_ids), "pieces")
    counts = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    histogram.pop(window, None)  # fewer entries than a window has tokens
    ranked = _ranked(cut, counts).select(*PIECE_NAMES, *["ids"] * with_ids, "rank")
    kinds = ", ".join(f"{c} {k}" for c, k in ranked.dtypes if c != "rank")
    return ranked.mapInArrow(_place(plan(histogram, window), window), kinds + ", sequence_id bigint, offset bigint")
