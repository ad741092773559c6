"""SimHash near-dedup with pivot distance tables.

A fingerprint is the bitwise majority of the XXH64 hashes of a text's word
shingles.  Equal fingerprints are merged first, so copies never meet as pairs.
Two fingerprints at ``max_bits`` differing bits or fewer agree on at least two of
``max_bits + 2`` blocks of bits; each fingerprint is dealt once to every pair of
blocks.  Within a block pair, a table of Hamming distances to fixed reference
fingerprints (pivots) discards pairs: a distance to a pivot differs by no more
than the distance between the two, so a pair whose largest coordinate difference
is above ``max_bits`` can't link.  Survivors are verified bit by bit.

The pivots alone can't bring pairs together at this threshold: distances of
64-bit fingerprints to a pivot have a standard deviation of 4, so one coordinate
keeps about half of all pairs.  Hence the blocks before the table.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import mix, release, steps, text_bytes, written
from .components import components

U = np.uint64
SHINGLE, MAX_BITS, SEED = 3, 3, 42
#: Reference fingerprints: fixed pseudo-random words.
PIVOTS = mix(np.arange(1, 17, dtype=U) * U(0x9E3779B97F4A7C13))
#: Fingerprints of one block pair that one task compares; a larger group is split into blocks of rows.
GROUP = 8192


def _hashes(text: bytes, shingle: int) -> list[int]:
    words = text.lower().split()
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    start = list(itertools.accumulate([len(w) + 1 for w in words], initial=0))
    h = xxhash.xxh64_intdigest
    return [h(joined[a:b - 1], SEED) for a, b in zip(start, start[shingle:])]


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """The SimHash of every text: a bit is 1 if set in over half of the shingles' hashes."""
    out = np.zeros(len(texts), U)
    for lo, hi in steps(texts):
        for i in range(lo, hi):
            hashes = _hashes(texts[i], shingle)
            if hashes:
                ones = np.zeros(64, np.int64)
                for k in range(0, len(hashes), 1 << 16):
                    part = np.array(hashes[k:k + (1 << 16)], ">u8").view(np.uint8).reshape(-1, 8)
                    ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
                out[i] = np.packbits(2 * ones > len(hashes)).view(">u8")[0]
    return out


def simhash(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, text_hash, fp)``: the fingerprint of each row's whole text as a signed 64-bit number.

    Lower case for A-Z only; words ``[^\\x20\\x09-\\x0D]+``; a text of fewer words than a
    shingle is one shingle; an empty or null text has fingerprint zero.
    """
    def run(batches):
        for batch in batches:
            fp = fingerprints(text_bytes(batch.column(2)), shingle)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(fp.view(np.int64))], names=["doc_id", "text_hash", "fp"])
        release()

    text = F.col("text").cast("string")
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash(text).alias("text_hash"), text.alias("text"))
    return src.mapInArrow(run, "doc_id bigint, text_hash bigint, fp bigint")


def text_hash(text):
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _widths(blocks: int) -> list[tuple[int, int]]:
    """``(shift, bits)`` of each block of the 64 bits."""
    cut = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def _block_keys(fp, max_bits: int):
    """An array of one key for each pair of blocks: pair number and the two blocks' bits."""
    parts = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << n) - 1)) for a, n in _widths(max_bits + 2)]
    keys = []
    for k, (i, j) in enumerate(itertools.combinations(range(max_bits + 2), 2)):
        keys.append(F.xxhash64(F.lit(k), parts[i], parts[j]))
    return F.array(*keys)


def _root(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        parent[x] = parent[up]
        x = parent[x]


def _link(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of all pairs ``a[i], b[i]``; the smaller number is the root."""
    while len(a):
        ra, rb = _root(parent, a), _root(parent, b)
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def group_links(key: np.ndarray, fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of equal ``key``: each fingerprint with its group component's root.

    Rows are ordered by key and distance to the first pivot, so candidates of a row
    are the next few rows; those already joined to it are skipped.
    """
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    order = np.lexsort((fp, table[:, 0], key))
    key, fp, table = key[order], fp[order], table[order]
    parent, at, s = np.arange(len(key)), np.arange(len(key)), 1
    while len(at):
        at = at[at + s < len(key)]
        at = at[(key[at] == key[at + s]) & (table[at + s, 0] - table[at, 0] <= max_bits)]
        a, b = at, at + s
        fresh = _root(parent, a.copy()) != _root(parent, b.copy())
        a, b = a[fresh], b[fresh]
        near = np.abs(table[a] - table[b]).max(axis=1, initial=0) <= max_bits
        a, b = a[near], b[near]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        _link(parent, a[near], b[near])
        s += 1
    root = _root(parent, np.arange(len(key)))
    own = root != np.arange(len(key))
    return fp[own], fp[root[own]]


def _links(max_bits: int):
    """Rows sorted by group -> links; a group that goes on in the next batch is carried over."""
    def run(batches):
        held_k, held_f = np.zeros(0, np.int64), np.zeros(0, U)

        def out(k, f):
            u, v = group_links(k, f, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            k = np.concatenate((held_k, batch.column(0).to_numpy()))
            f = np.concatenate((held_f, batch.column(1).to_numpy().view(U)))
            if not len(k):
                continue
            cut = np.searchsorted(k, k[-1])
            held_k, held_f = k[cut:], f[cut:]
            if cut:
                yield out(k[:cut], f[:cut])
        if len(held_k):
            yield out(held_k, held_f)
    return run


def links(distinct_fps: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP) -> DataFrame:
    """``(u, v)`` links that connect all fingerprints within ``max_bits`` of each other, one row a member at most.

    A block pair that more than ``group`` fingerprints share is cut into blocks of
    about ``group`` rows, and each pair of blocks is a group of its own.
    """
    keyed = distinct_fps.select(F.explode(_block_keys(F.col("fp"), max_bits)).alias("key"), "fp")
    parts = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("key", F.ceil(F.col("n") / F.lit(group)).cast("int").alias("parts")))
    mine = F.pmod(F.xxhash64("fp", "key"), F.col("parts")).cast("int")
    pairs = F.when(F.col("parts") == 1, F.array(F.col("key"))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.xxhash64("key", F.least(F.col("mine"), j), F.greatest(F.col("mine"), j))))
    dealt = (keyed.join(parts, "key").withColumn("mine", mine).select(F.explode(pairs).alias("key"), "fp"))
    n = int(distinct_fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "key").sortWithinPartitions("key")
            .mapInArrow(_links(max_bits), "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for each row: fingerprints link at ``max_bits`` differing bits or fewer.

    ``component_id`` is the smallest ``doc_id`` reachable over links, the row's own
    included; ``root`` names the component.  Empty and null texts share fingerprint
    zero and link like any other.  A null ``doc_id`` is kept, and never is a
    component's id unless all its rows have none.  Repeated rows give repeated rows;
    other columns are ignored; an empty table gives an empty result.
    """
    fps = written(simhash(docs, shingle), "simhash")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprints")
    stars = components(links(distinct, max_bits))
    rooted = (distinct.join(stars.withColumnRenamed("u", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    named = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return (fps.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp")
            .select("doc_id", "text_hash", "fp", "root", "component_id"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the smallest ``doc_id`` (null last), ties by text hash.

    Of rows equal in both one stays.  All columns are kept as they are.
    """
    members = near_duplicates(docs, shingle, max_bits)
    first = members.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_hash")).alias("x"))
    first = first.select(F.col("x.doc_id").alias("__first"), F.col("x.text_hash").alias("__first_hash")).distinct()
    # The row travels as one column, so none of its names can meet those used here.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("bigint").alias("id"),
                       text_hash(F.col("text").cast("string")).alias("hash"))
    same = F.col("id").eqNullSafe(F.col("__first")) & (F.col("hash") == F.col("__first_hash"))
    once = F.row_number().over(Window.partitionBy(F.coalesce("id", F.lit(0)), F.isnull("id"), "hash").orderBy(F.lit(0)))
    return rows.join(first, same, "left_semi").withColumn("n", once).where("n = 1").select("row.*")
