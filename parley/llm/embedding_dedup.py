"""Near-duplicate vectors by random-hyperplane signs, exact cosines and connected components.

Equal vectors of a label are merged first, so copies never meet as pairs.  Each of
``tables`` tables cuts space by ``bits`` random hyperplanes; vectors on the same side of
all of them share a bucket.  At cosine 0.93 one sign agrees with probability
0.880, so 12 signs agree with 0.216 and one of 28 tables finds a pair with 0.9989; pairs
above it are found more surely (0.9999999 at 0.98).

In a bucket cosines are exact, in double precision; within rounding of the threshold
the dot product is summed exactly.  A pair counts only in the first table in which the
two share a bucket (each row carries its signs), so links can be added up without
emitting pairs: a task returns one row for each vector and bucket, the vectors linked
and one link towards the bucket's component.  A bucket above ``GROUP`` vectors is cut
into blocks, and each pair of blocks is a group of its own.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written
from .components import components
from .simhash import _link, _root
from .vectors import matrices, packed, vector_column

THRESHOLD, TABLES, BITS, SEED = 0.93, 28, 12, 20_250
#: Vectors of a bucket that one task compares with each other; of components, planes that are drawn at once.
GROUP, DRAWN = 1024, 4096
#: Groups up to this size are compared by offset, all groups of a batch at once; larger ones by matrix products.
SMALL = 24
#: Cosines nearer to the threshold than this are worked out again exactly.
CLOSE = 1e-11


@lru_cache(maxsize=64)
def _planes(first: int, count: int, planes: int) -> np.ndarray:
    """Components ``first`` to ``first + count`` of the fixed random hyperplanes."""
    return np.random.default_rng([SEED, first, planes]).standard_normal((count, planes))


def signatures(x: np.ndarray, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    """The ``bits`` signs of every row in every table, as 16-bit numbers."""
    side = np.zeros((len(x), tables * bits))
    for c in range(0, x.shape[1], DRAWN):
        part = x[:, c:c + DRAWN]
        side += part @ _planes(c, DRAWN, tables * bits)[:part.shape[1]]
    return ((side > 0).reshape(len(x), tables, bits) @ (1 << np.arange(bits))).astype(np.uint16)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine from exactly rounded sums."""
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


def _linked(x: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: np.ndarray, threshold: float) -> np.ndarray:
    on = cosine >= threshold
    for i in np.flatnonzero(np.abs(cosine - threshold) < CLOSE):
        on[i] = exact_cosine(x[a[i]], x[b[i]]) >= threshold
    return on


def group_links(group: np.ndarray, side: np.ndarray, table: np.ndarray, sig: np.ndarray, x: np.ndarray, weight: np.ndarray,
                threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by ``group``: vectors newly linked to each row, and the row that names its component.

    Rows of a group with ``side`` -1 are compared with each other; a group of sides 0
    and 1 is compared across.  Only pairs that share no earlier table's bucket count.
    """
    n = len(group)
    unit = unit_rows(x) if n else x
    found, parent = np.zeros(n, np.int64), np.arange(n)

    def add(a, b, cosine):
        fits = _linked(x, a, b, cosine, threshold)
        a, b = a[fits], b[fits]
        for i in range(0, len(a), 1 << 16):
            p, q = a[i:i + (1 << 16)], b[i:i + (1 << 16)]
            first = (sig[p] == sig[q]).argmax(axis=1) == table[p]
            p, q = p[first], q[first]
            np.add.at(found, p, weight[q])
            np.add.at(found, q, weight[p])
            _link(parent, p, q)

    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))[:n]
    size = np.diff(np.append(start, n))
    small = np.repeat(size <= SMALL, size)
    at, s = np.flatnonzero(small), 1
    while len(at):
        at = at[at + s < n]
        at = at[group[at] == group[at + s]]
        a, b = at, at + s
        meet = (side[a] < 0) | (side[a] != side[b])
        a, b = a[meet], b[meet]
        for i in range(0, len(a), 1 << 15):
            p, q = a[i:i + (1 << 15)], b[i:i + (1 << 15)]
            add(p, q, np.einsum("ij,ij->i", unit[p], unit[q]))
        s += 1
    for lo, m in zip(start[size > SMALL], size[size > SMALL]):
        for i in range(lo, lo + m, 256):
            rows = slice(i, min(i + 256, lo + m))
            cosine = unit[rows] @ unit[i:lo + m].T
            a, b = np.nonzero(cosine >= threshold - CLOSE)
            ahead = a < b
            a, b = a[ahead], b[ahead]
            value = cosine[a, b]
            a, b = a + i, b + i
            meet = (side[a] < 0) | (side[a] != side[b])
            add(a[meet], b[meet], value[meet])
    return found, _root(parent, np.arange(n))


def _links(threshold: float, kind: str):
    """Rows sorted by group -> ``node, n, root`` of every row that has links; an unfinished group is carried over."""
    names = ["node", "n", "root"]

    def out(t: pa.Table):
        key, label = t.column("key").to_numpy(), t.column("label").to_numpy()
        dims = np.array([len(b) for b in t.column("vec").to_pylist()])
        for d in np.unique(dims):  # one length at a time; a group holds one but for a collision of keys
            at = np.flatnonzero(dims == d)
            at = at[np.lexsort((label[at], key[at]))]
            part = t.take(pa.array(at))
            k, l = key[at], label[at]  # noqa: E741
            group = np.cumsum(np.concatenate(([0], (k[1:] != k[:-1]) | (l[1:] != l[:-1]))))
            unpack = lambda c, kind: np.frombuffer(b"".join(part.column(c).to_pylist()), kind).reshape(len(at), -1)  # noqa: B023, E731
            found, root = group_links(group, part.column("side").to_numpy(), part.column("tab").to_numpy(), unpack("sig", "<u2"),
                                      unpack("vec", kind).astype(float), part.column("w").to_numpy(), threshold)
            rows = np.flatnonzero(found)
            node = part.column("node")
            yield pa.RecordBatch.from_arrays([node.take(pa.array(rows)).combine_chunks(), pa.array(found[rows]),
                                              node.take(pa.array(root[rows])).combine_chunks()], names=names)

    def run(batches):
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            key = t.column("key").to_numpy()
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))
            held = t.slice(cut)
            if cut:
                yield from out(t.slice(0, cut))
        if held is not None and held.num_rows:
            yield from out(held)
        release()
    return run


def _vectors(df: DataFrame, id_col: str, label_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """``vec_id, label, vec``: packed vectors, null where the row links with nothing; and how they are packed."""
    column = vector_column(df, vector_col)
    kind = "<f4" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"

    def run(batches):
        for batch in batches:
            vec = np.full(batch.num_rows, None, object)
            for rows, x in matrices(batch.column(2)):
                for i, v in zip(rows[(x != 0).any(axis=1)], packed(x[(x != 0).any(axis=1)], kind).to_pylist()):
                    vec[i] = v
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(vec, pa.binary())], names=["vec_id", "label", "vec"])
        release()

    src = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"), column.alias("vec"))
    return src.mapInArrow(run, "vec_id bigint, label string, vec binary"), kind


def _signed(classes: DataFrame, tables: int, bits: int, kind: str) -> DataFrame:
    """The classes with their signs in all tables."""
    def run(batches):
        for batch in batches:
            vecs = batch.column(batch.schema.get_field_index("vec")).to_pylist()
            size = np.array([len(v) for v in vecs])
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                x = np.frombuffer(b"".join(vecs[i] for i in rows), kind).reshape(len(rows), -1).astype(float)
                sig = signatures(unit_rows(x), tables, bits)
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(rows)).columns, packed(sig, "<u2")], names=[*batch.schema.names, "sig"])
        release()
    return classes.mapInArrow(run, "node string, label bigint, vec binary, w bigint, sig binary")


def bucket_links(classes: DataFrame, tables: int, threshold: float, kind: str, group: int = GROUP) -> DataFrame:
    """``(node, n, root)``: for each class and bucket the vectors newly linked, and a link towards their component."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(tables - 1)), lambda t: F.struct(
        t.cast("int").alias("tab"), F.xxhash64(t, F.col("label"), F.octet_length("vec"), F.substring("sig", 2 * t + 1, F.lit(2))).alias("key")))
    keyed = classes.select("node", F.explode(keys).alias("k")).select("node", "k.tab", "k.key")
    large = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
             .select("key", F.ceil(F.col("n") / F.lit(group)).cast("int").alias("parts")))
    cuts = (keyed.join(large, "key").groupBy("node")  # at most one entry a table
            .agg(F.map_from_entries(F.collect_list(F.struct("tab", "parts"))).alias("cuts")))
    rows = (classes.join(cuts, "node", "left").select("node", "label", "vec", "w", "sig", "cuts", F.explode(keys).alias("k"))
            .select("node", "label", "vec", "w", "sig", "k.tab", "k.key", F.coalesce(F.col("cuts")[F.col("k.tab")], F.lit(1)).alias("parts")))
    mine = F.pmod(F.xxhash64("node", "tab"), "parts").cast("int")
    pairs = F.when(F.col("parts") == 1, F.array(F.struct("key", F.lit(-1).alias("side")))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.struct(F.xxhash64("key", F.least("mine", j), F.greatest("mine", j)).alias("key"),
                           F.when(j == F.col("mine"), -1).when(j > F.col("mine"), 0).otherwise(1).alias("side"))))
    dealt = rows.withColumn("mine", mine).withColumn("p", F.explode(pairs)).select("p.key", "p.side", "label", "tab", "node", "w", "sig", "vec")
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_links(threshold, kind), "node string, n bigint, root string")


#: Flips the sign bit, so that hexadecimal digits sort as signed numbers do.
_SIGN = -(1 << 63)


def _name(rep: str, key: str):
    """A class's name: 16 digits that sort as its smallest id (none last), then its key.  A component's smallest name so tells its smallest id."""
    digits = F.lpad(F.hex(F.col(rep).bitwiseXOR(F.lit(_SIGN))), 16, "0")
    return F.concat(F.coalesce(digits, F.lit("~" * 16)), F.col(key))


def _named(name):
    """The id that a name starts with (null for none)."""
    return F.conv(F.when(~name.startswith("~"), F.substring(name, 1, 16)), 16, -10).cast("bigint").bitwiseXOR(F.lit(_SIGN))


def near_duplicate_vectors(df: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, bits: int = BITS,
                           id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row: vectors of one label link at cosine ``threshold`` or more.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    ``vec_id`` reachable over links, the row's own included; ``kept`` marks rows with that
    id.  A null label, a null, empty or zero vector, or one with a null or non-finite
    component links with nothing: its component is its own id.  Vectors of different
    lengths never link.  Repeated rows each count and link with each other.  A null id is
    no component's id unless all its rows have none (such a row alone is kept).  Other
    columns are ignored; an empty table gives an empty result.  Pairs are found with the
    probability that ``tables`` and ``bits`` give (module docstring); none links below ``threshold``.
    """
    vectors, kind = _vectors(df, id_col, label_col, vector_col)
    members = vectors.withColumn("node", F.when(F.col("label").isNotNull(), F.md5(F.concat(F.col("label").cast("binary"), F.lit(b"\0"), F.col("vec")))))
    merged = (members.where("node is not null").groupBy("node").agg(
        F.first(F.xxhash64(F.lit(1), "label")).alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("rep"))
        .select(_name("rep", "node").alias("node"), "label", "vec", "w"))
    classes = written(_signed(merged, tables, bits, kind), "vectors")
    links = written(bucket_links(classes, tables, threshold, kind), "vector-links")
    stars = components(links.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    found = (classes.select("node", "w").join(counts, "node", "left").join(stars.withColumnRenamed("u", "node"), "node", "left")
             .select(F.substring("node", 17, 32).alias("node"), (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                     _named(F.coalesce("root", "node")).alias("smallest")))
    return (members.select("vec_id", "node").join(found, "node", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
                    F.coalesce("smallest", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


ORACLE = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
good AS (
  SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM e
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) / (a.norm * b.norm) >= 0.93),
reach AS (SELECT u AS s, v AS t FROM pairs UNION SELECT r.s, p.v FROM reach r JOIN pairs p ON p.u = r.t),
least_of AS (SELECT s, min(t) AS t FROM reach GROUP BY s), degree AS (SELECT u, count(*) AS n FROM pairs GROUP BY u)
SELECT e.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(l.t, e.vec_id)) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(l.t, e.vec_id)) AS kept
FROM e LEFT JOIN least_of l ON l.s = e.vec_id LEFT JOIN degree d ON d.u = e.vec_id
"""
