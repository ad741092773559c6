"""Hard negatives of anchors by angular triangle filtering.

Every vector is scaled to integers once and stored with its norm and its angles to
a few reference directions.  For an anchor ``a``, a row ``x`` and a reference ``r``
the angle between ``a`` and ``x`` lies between ``|angle(a,r) - angle(x,r)|`` and the
smaller of ``angle(a,r) + angle(x,r)`` and what that sum lacks of a full turn.  Over
all references this gives an interval of the cosine, and times the norms an interval
of the score, widened by more than floating point can be off.  Rows of a task are
sorted by their nearest reference and cut into windows, whose ranges of angles and
norms give one interval an anchor; an anchor scores (in integers) only the windows
whose interval overlaps the scores it wants: above its fifth best so far for
positives, between 80 and 100 % of a positive's score for negatives.

Anchors are dealt to blocks and rows to parts, both of bounded bytes; a task holds
one block and one part and returns at most ``k`` rows for each of its anchors
(and positives).  Those are ranked over all parts by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, written
from .vectors import matrices, packed, unpacked, vector_column

#: Bytes of vectors of one task's part of the rows and block of the anchors, and rows of the smallest part.
PART_BYTES, BLOCK_BYTES, PART_ROWS = 32 << 20, 8 << 20, 512
#: Rows that share one interval, reference vectors of a length, and the lengths that get references.
WINDOW, REFERENCES, LENGTHS = 128, 16, 8
#: Squared norms below this have scores of which a hundredfold fits a long.
NORM_LIMIT = 1 << 56
#: More than angles can be off: single precision storage, and arccos near 1.
ANGLE_SLACK = 4e-6

STORED = "vec_id bigint, label string, anchor boolean, slot bigint, dim int, q binary, norm double"


def scaled_rows(df: DataFrame, label: str, anchor, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``STORED`` rows that take part: integer components ``floor(scale * x)``, packed, and their norm."""
    def run(batches):
        slot = 0
        for batch in batches:
            for rows, x in matrices(batch.column(3)):
                with np.errstate(over="ignore", invalid="ignore"):
                    q = np.floor(scale * x)
                    squared = (q * q).sum(axis=1)
                fits = squared < NORM_LIMIT
                at, q = pa.array(rows[fits]), q[fits]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in range(3)), pa.array(np.arange(slot, slot + len(q))),
                     pa.array(np.full(len(q), x.shape[1], np.int32)), packed(q, "<i4"), pa.array(np.sqrt(squared[fits]))],
                    names=["vec_id", "label", "anchor", "slot", "dim", "q", "norm"])
                slot += len(q)
        release()

    src = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"),
                    F.coalesce(anchor, F.lit(False)).alias("anchor"), vector_column(df, vector_col).alias("x"))
    return src.where("vec_id is not null and label is not null").mapInArrow(run, STORED)


def reference_directions(rows: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors of up to 16 rows (smallest hash of the id) of each of the 8 commonest lengths up to 16,384.

    At most 8 x 16 vectors reach the driver.  A length without references has the
    interval from -1 to 1 and is scored whole, so nothing is lost.
    """
    common = rows.where("dim between 1 and 16384").groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(LENGTHS)
    first = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id", "q"))
    got = (rows.where("norm > 0").join(F.broadcast(common), "dim").select("dim", "q", first.alias("r"))
           .where(F.col("r") <= REFERENCES).select("dim", "q").collect())
    out: dict[int, list] = {}
    for r in sorted((r["dim"], r["q"]) for r in got):
        out.setdefault(r[0], []).append(np.frombuffer(r[1], "<i4").astype(float))
    return {d: np.array([v / np.linalg.norm(v) for v in vs]) for d, vs in out.items()}


def with_angles(rows: DataFrame, references: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` and ``angles``: packed single-precision angles to the references of the row's length."""
    def run(batches):
        for batch in batches:
            dims = batch.column(4).to_numpy()
            for d in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == d)))
                directions = references.get(int(d))
                if directions is None:
                    angles = np.zeros((part.num_rows, 0))
                else:
                    q = unpacked(part.column(5), "<i4", part.num_rows).astype(float)
                    norm = part.column(6).to_numpy()[:, None]
                    with np.errstate(invalid="ignore", divide="ignore"):
                        cosine = np.where(norm > 0, q @ directions.T / norm, 0.0)
                    angles = np.arccos(np.clip(cosine, -1.0, 1.0))
                yield pa.RecordBatch.from_arrays([*part.columns, packed(angles, "<f4")], names=[*part.schema.names, "angles"])
        release()
    return rows.mapInArrow(run, STORED + ", angles binary")


def score_bounds(angles, norm, low, high, least, most) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the integer scores of anchors (``angles``, ``norm``) with any row of a window.

    ``low, high`` are the window's smallest and largest angle to each reference,
    ``least, most`` its smallest and largest norm.
    """
    if angles.shape[1]:
        near = np.maximum(angles - high, low - angles).max(axis=1)
        far = np.minimum(angles + high, 2 * np.pi - angles - low).min(axis=1)
    else:
        near, far = np.zeros(len(angles)), np.full(len(angles), np.pi)
    up = np.cos(np.clip(near - ANGLE_SLACK, 0.0, np.pi))
    down = np.cos(np.clip(far + ANGLE_SLACK, 0.0, np.pi))
    up = norm * np.where(up >= 0, up * most, up * least)
    down = norm * np.where(down >= 0, down * least, down * most)
    return down - 1 - 1e-9 * np.abs(down), up + 1 + 1e-9 * np.abs(up)


def _scores(a: np.ndarray, x: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer inner products; in doubles where no partial sum can reach 2^53."""
    if bound < 2.0 ** 52:
        return (a.astype(float) @ x.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


class _Best:
    """The ``k`` best ``(score, id)`` of each target: higher scores first, ties by smaller id."""

    def __init__(self, targets: int, k: int):
        self.k, self.floor = k, np.full(targets, np.iinfo(np.int64).min)
        self.target, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, target, score, ids):
        target, score, ids = (np.concatenate(v) for v in ((self.target, target), (self.score, score), (self.ids, ids)))
        order = np.lexsort((ids, -score, target))
        target, score, ids = target[order], score[order], ids[order]
        new = np.concatenate(([True], target[1:] != target[:-1]))[:len(target)]
        rank = np.arange(len(target)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(target) else order
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[target[last]] = score[last]
        self.target, self.score, self.ids = target[keep], score[keep], ids[keep]


def _windows(rows: pa.Table):
    """The task's rows by nearest reference and angle to it, cut into windows with their ranges."""
    n = rows.num_rows
    q, angles = unpacked(rows.column("q"), "<i4", n), unpacked(rows.column("angles"), "<f4", n).astype(float)
    ids, norm = rows.column("vec_id").to_numpy(), rows.column("norm").to_numpy()
    label = np.array(rows.column("label").to_pylist(), object)
    nearest = angles.argmin(axis=1) if angles.shape[1] else np.zeros(n, np.int64)
    order = np.lexsort((norm, angles.min(axis=1, initial=np.pi), nearest))
    for i in range(0, n, WINDOW):
        at = order[i:i + WINDOW]
        yield (ids[at], label[at], q[at], angles[at].min(axis=0), angles[at].max(axis=0), norm[at].min(), norm[at].max())


def _anchors(block: pa.Table):
    n = block.num_rows
    return (unpacked(block.column("q"), "<i4", n), unpacked(block.column("angles"), "<f4", n).astype(float),
            block.column("norm").to_numpy(), block.column("vec_id").to_numpy())


def positives_of(rows: pa.Table, block: pa.Table, k: int) -> tuple[_Best, int]:
    """The ``k`` best rows of the part for each anchor of the block (of one label), and the pairs that were scored."""
    q, angles, norm, ids = _anchors(block)
    best, scored = _Best(len(ids), k), 0
    for row_ids, _, x, low, high, least, most in _windows(rows):
        _, up = score_bounds(angles, norm, low, high, least, most)
        mine = np.flatnonzero(up >= best.floor)
        if not len(mine):
            continue
        s = _scores(q[mine], x, norm[mine].max() * most)
        scored += s.size
        a, r = np.nonzero((s >= best.floor[mine][:, None]) & (ids[mine][:, None] != row_ids[None, :]))
        best.add(mine[a], s[a, r], row_ids[r])
    return best, scored


def negatives_of(rows: pa.Table, block: pa.Table, k: int, low_pct: int, high_pct: int) -> tuple[_Best, int, int]:
    """The ``k`` best fitting rows for each anchor and positive (target ``anchor * width + positive``), width, pairs scored."""
    q, angles, norm, _ = _anchors(block)
    label = np.array(block.column("label").to_pylist(), object)
    wanted = [[p["score"] for p in ps] for ps in block.column("positives").to_pylist()]
    width = max(map(len, wanted))
    goal = np.full((len(wanted), width), -1, np.int64)  # a negative score has no fitting rows, so -1 stands for none
    for i, w in enumerate(wanted):
        goal[i, :len(w)] = w
    top = np.where(goal >= 0, goal * (high_pct / 100.0), -1.0) * (1 + 1e-9) + 1
    bottom = np.where(goal >= 0, goal * (low_pct / 100.0), np.inf) * (1 - 1e-9) - 1
    best, scored = _Best(goal.size, k), 0
    for row_ids, labels, x, low, high, least, most in _windows(rows):
        down, up = score_bounds(angles, norm, low, high, least, most)
        floor = np.maximum(bottom, best.floor.reshape(goal.shape))
        mine = np.flatnonzero(((goal >= 0) & (up[:, None] >= floor) & (down[:, None] <= top)).any(axis=1))
        if not len(mine):
            continue
        s = _scores(q[mine], x, norm[mine].max() * most)
        scored += s.size
        other = label[mine][:, None] != labels[None, :]
        targets, scores, found = [], [], []
        for j in range(width):
            g = goal[mine, j][:, None]
            a, r = np.nonzero(other & (g >= 0) & (100 * s >= low_pct * g) & (100 * s <= high_pct * g)
                              & (s >= best.floor[mine * width + j][:, None]))
            targets.append(mine[a] * width + j)
            scores.append(s[a, r])
            found.append(row_ids[r])
        best.add(*(np.concatenate(v) for v in (targets, scores, found)))
    return best, width, scored


def _dealt(rows: DataFrame, anchors: DataFrame, by: list[str]):
    """Rows and anchors grouped by ``by``, block and part: every anchor of a group meets every row of it in one task."""
    tasks = 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = F.greatest(F.ceil(F.sum(F.octet_length("q")) / F.lit(PART_BYTES)),
                       F.least(F.ceil(F.count(F.lit(1)) / F.lit(PART_ROWS)), F.lit(tasks))).cast("int")
    blocks = F.ceil(F.sum(F.octet_length("q")) / F.lit(BLOCK_BYTES)).cast("int")
    sizes = (rows.groupBy(*by).agg(F.greatest(parts, F.lit(1)).alias("parts"))
             .join(anchors.groupBy(*by).agg(F.greatest(blocks, F.lit(1)).alias("blocks")), by))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = (rows.join(sizes, by).withColumn("part", F.pmod(F.xxhash64("vec_id", "slot"), "parts").cast("int"))
            .withColumn("block", numbers("blocks")).drop("parts", "blocks"))
    right = (anchors.join(sizes, by).withColumn("block", F.pmod(F.xxhash64("vec_id", "key"), "blocks").cast("int"))
             .withColumn("part", numbers("parts")).drop("parts", "blocks"))
    right = right.select(*(F.col(c).alias(c) for c in right.columns))  # columns of their own beside the rows'
    keys = [*by, "block", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def _task(find, names):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = find(left, right) if left.num_rows and right.num_rows else [[] for _ in names]
        release()
        return pa.table([pa.array(c, t) for c, t in zip(columns, names.values())], names=list(names))
    return run


LONG, TEXT, INT = pa.int64(), pa.string(), pa.int32()


def hard_negatives(df: DataFrame, anchor, positives: int = 5, negatives: int = 5, low_pct: int = 80, high_pct: int = 100,
                   scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchor`` is true.

    Scores are integer inner products of ``floor(scale * x)``.  An anchor's positives
    are the ``positives`` best rows of its label with another id; for each of them the
    ``negatives`` best rows of other labels that score from ``low_pct`` to ``high_pct``
    percent of the positive.  Higher scores first, ties by smaller id.

    Rows with a null id, label, vector, or a null or non-finite component take no part,
    nor do vectors whose scaled squared norm is 2^56 or more (their scores may not fit a
    long).  Vectors of different lengths have no score and never meet; an empty vector
    scores 0.  Repeated rows each count among positives and negatives; an anchor that
    is repeated as a whole is answered once, and anchors that share an id but differ
    are answered each.  A positive with a negative score has no fitting rows.  Other
    columns are ignored; an empty table gives an empty result.
    """
    scaled = scaled_rows(df, label_col, anchor, scale, id_col, vector_col)
    rows = written(with_angles(scaled, reference_directions(scaled)), "angles")
    anchors = (rows.where("anchor").groupBy("vec_id", "label", "dim", "q", "norm").agg(F.min("angles").alias("angles"))
               .withColumn("key", F.md5(F.concat(F.col("label").cast("binary"), F.lit(b"\0"), F.col("q")))))
    rows = rows.drop("anchor")

    def near(left, right):
        best, _ = positives_of(left, right, positives)
        at = pa.array(best.target)
        return [right.column("vec_id").take(at).combine_chunks(), right.column("key").take(at).combine_chunks(), best.ids, best.score]

    ranked = lambda of: F.row_number().over(Window.partitionBy(*of).orderBy(F.desc("score"), "id"))
    best = (_dealt(rows, anchors, ["dim", "label"])
            .applyInArrow(_task(near, {"vec_id": LONG, "key": TEXT, "id": LONG, "score": LONG}), "vec_id bigint, key string, id bigint, score bigint")
            .withColumn("place", ranked(["vec_id", "key"])).where(F.col("place") <= positives)
            .groupBy("vec_id", "key").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("positives")))
    asked = written(anchors.join(best, ["vec_id", "key"]), "positives")

    def hard(left, right):
        found, width, _ = negatives_of(left, right, negatives, low_pct, high_pct)
        at, place = pa.array(found.target // width), found.target % width
        chosen = [ps[j] for ps, j in zip(right.column("positives").take(at).to_pylist(), place)]
        return [right.column("vec_id").take(at).combine_chunks(), right.column("key").take(at).combine_chunks(), [p["place"] for p in chosen],
                [p["id"] for p in chosen], [p["score"] for p in chosen], found.ids, found.score]

    names = {"anchor_id": LONG, "key": TEXT, "place": INT, "positive_id": LONG, "positive_score": LONG, "id": LONG, "score": LONG}
    return (_dealt(rows, asked, ["dim"])
            .applyInArrow(_task(hard, names), "anchor_id bigint, key string, place int, positive_id bigint, positive_score bigint, id bigint, score bigint")
            .withColumn("rank", ranked(["anchor_id", "key", "place"])).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


ORACLE = """
WITH e AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(coalesce(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])), 0) AS BIGINT) AS score
  FROM e a JOIN e b ON len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT rid, anchor_id, id, score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, id) AS place
  FROM s WHERE same AND id <> anchor_id QUALIFY place <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.rid, p.place ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON p.rid = n.rid AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""
