"""Helpers shared by the operators of this sub-package."""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text that one vectorised step holds at once (a longer text is a step of its own).
STEP_BYTES = 2 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/parley-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, on replicated storage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null becomes the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def steps(texts: list[bytes], limit: int = STEP_BYTES):
    """Ranges ``(lo, hi)`` of consecutive texts of about ``limit`` bytes together."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def release() -> None:
    """Give memory that is free back to the machine; Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


class Codes(dict):
    """Numbers words in order of first use: ``codes[word]``."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def word_codes(texts: list[bytes], codes: Codes | None = None) -> tuple[Codes, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts (``bytes.split`` splits at just these six bytes).

    Returns the code book, the code of every word and the number of words of each text.
    """
    codes = Codes() if codes is None else codes
    lists = [t.split() for t in texts]
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    get = codes.__getitem__
    out = np.empty(int(counts.sum()), np.int32)
    at = 0
    for words in lists:
        out[at:at + len(words)] = [get(w) for w in words]
        at += len(words)
    return codes, out, counts


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def window_starts(counts: np.ndarray, window: int) -> np.ndarray:
    """Word numbers at which a whole window of one text starts."""
    end = np.repeat(np.cumsum(counts), counts)
    return np.flatnonzero(np.arange(len(end)) + window <= end)


def per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one for each word) over each text."""
    total = np.concatenate(([0], np.cumsum(values)))
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


def append(docs: DataFrame, make, added: str, keep: list[str], done=release) -> DataFrame:
    """``keep`` columns of ``docs`` and the columns that ``make(texts)`` gives for its ``text`` column.

    ``added`` is the schema of the new columns; ``make`` returns one array for each;
    ``done`` runs when a task ends.
    """
    names = [x.split()[0] for x in added.split(", ")]

    def run(batches):
        for batch in batches:
            new = make(text_bytes(batch.column(0)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *(pa.array(x) for x in new)], names=keep + names)
        done()

    kinds = dict(docs.dtypes)
    src = docs.select(F.col("text").cast("string").alias("__text"), *(F.col(f"`{c}`") for c in keep))
    return src.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [added]))


def marked_rows(labels: DataFrame, label: str, where) -> DataFrame:
    """``doc_id, label`` of every id labelled 0 or 1; of conflicting labels of one doc_id the larger counts."""
    return (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).where(where)
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, where, per_class: int) -> DataFrame:
    """Up to ``per_class`` rows of each class, ``doc_id, label, text``: those with the smallest hashes of doc_id.

    Of conflicting labels of one doc_id the larger counts.  At most ``2 * per_class`` ids
    are broadcast to find the texts.
    """
    marked = marked_rows(labels, label, where)
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = [marked.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("doc_id", "label", "text")
