"""Quality rules: an isolation forest on rule statistics.

Each document gets counts that quality rules look at.  Ratios of them (free of the
document's length) go through isolation forests: trees that split at random places
isolate unusual documents after few splits, so a short mean path marks an anomaly.
One forest sees all ratios, and one more sees each ratio alone, as an oddity in one
of them is drowned by harmless spread in the others.  Forests and thresholds come
from labelled rows: each threshold is the lowest that rejects at most
``CLEAN_LOSS`` of label 1, and a document goes if any forest finds it above.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import append, marked_rows, mix, per_text, steps, window_starts, word_codes, written

U = np.uint64
SYMBOLS = b"#*$%&|<>"
IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Trees of a forest, and rows that each draws among all labelled ones.
TREES, TREE_ROWS, SEED = 64, 256, 7
CLEAN_LOSS = 0.0002
#: Ratios that each forest sees.
VIEWS = ((0, 1, 2, 3), (0,), (1,), (2,), (3,))

STATISTICS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _repeat_words(ids: np.ndarray, n_codes: int, counts: np.ndarray) -> np.ndarray:
    """Words of each text in 3-word windows that it holds twice or more."""
    at = window_starts(counts, 3)
    doc = np.repeat(np.arange(len(counts)), counts)
    if n_codes < 1 << 21:
        key = (ids[at].astype(np.int64) << 42) | (ids[at + 1].astype(np.int64) << 21) | ids[at + 2]
    else:
        pair = np.unique(ids[at].astype(np.int64) * n_codes + ids[at + 1], return_inverse=True)[1]
        key = pair.astype(np.int64) * n_codes + ids[at + 2]
    order = np.argsort(mix(key.view(U) ^ mix(doc[at].astype(U))))
    key, d = key[order], doc[at][order]
    same = (key[1:] == key[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    change = np.zeros(len(ids) + 4, np.int64)
    hit = at[order[twice]]
    change[hit] += 1
    change[hit + 3] -= 1  # starts are distinct, so no index repeats
    return per_text((np.cumsum(change)[:len(ids)] > 0).astype(np.int64), counts)


def rule_statistics(texts: list[bytes]) -> np.ndarray:
    """The five counts of ``STATISTICS`` for each text, as rows."""
    out = np.zeros((len(texts), 5), np.int64)
    for lo, hi in steps(texts):
        part = texts[lo:hi]
        codes, ids, counts = word_codes(part)
        chars = np.fromiter((len(w.decode()) for w in codes), np.int64, len(codes))
        out[lo:hi, 0] = counts
        out[lo:hi, 1] = per_text(chars[ids], counts)
        out[lo:hi, 4] = _repeat_words(ids, len(codes), counts)
        sizes = np.fromiter(map(len, part), np.int64, len(part))
        out[lo:hi, 2] = per_text(IS_SYMBOL[np.frombuffer(b"".join(part), np.uint8)], sizes)
        for i, t in enumerate(part, lo):
            lines = [x for x in t.split(b"\n") if x and not x.isspace()]
            out[i, 3] = len(lines) - len(set(lines))
    return out


def features(stats: np.ndarray) -> np.ndarray:
    """Length-free ratios of the statistics."""
    n = np.maximum(stats[:, 0], 1)
    return np.stack([stats[:, 1] / n, stats[:, 2] / n, stats[:, 3] / n, stats[:, 4] / n], 1)


def base_failed(stats: np.ndarray) -> np.ndarray:
    return (stats[:, 0] < MIN_WORDS) | (100 * stats[:, 4] > MAX_REPEAT_PERCENT * stats[:, 0])


def _average_path(n: float) -> float:
    """Mean path of an unsuccessful search in a binary tree of ``n`` keys."""
    return 0.0 if n <= 1 else 1.0 if n <= 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees side by side: split column (-1 in a leaf), split place, first child, path length of a leaf."""
    column: np.ndarray
    place: np.ndarray
    child: np.ndarray
    length: np.ndarray
    norm: float
    view: tuple[int, ...]
    threshold: float = np.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score of each row: 2 ** (-mean path / expected path), higher is stranger."""
        x = x[:, self.view]
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for column, place, child, length in zip(self.column, self.place, self.child, self.length):
            at = np.zeros(len(x), np.int64)
            while (inner := column[at] >= 0).any():
                go = x[rows, np.maximum(column[at], 0)] >= place[at]
                at = np.where(inner, child[at] + go, at)
            total += length[at]
        return 2.0 ** (-total / (len(self.column) * self.norm))


def _tree(x: np.ndarray, depth: int, rng) -> list[tuple]:
    nodes: list = [None]
    todo = [(0, x, 0)]
    while todo:
        at, rows, d = todo.pop()
        low, high = rows.min(0), rows.max(0)
        wide = np.flatnonzero(high > low)
        if d >= depth or len(rows) <= 1 or not len(wide):
            nodes[at] = (-1, 0.0, 0, d + _average_path(len(rows)))
            continue
        c = int(rng.choice(wide))
        place = rng.uniform(low[c], high[c])
        place = place if place > low[c] else high[c]
        go = rows[:, c] >= place
        nodes[at] = (c, place, len(nodes), 0.0)
        todo += [(len(nodes), rows[~go], d + 1), (len(nodes) + 1, rows[go], d + 1)]
        nodes += [None, None]
    return nodes


def grown(samples: list[np.ndarray], view: tuple[int, ...], rng) -> Forest:
    """A forest of one tree for each sample of rows."""
    rows = max(map(len, samples))
    depth = int(np.ceil(np.log2(max(rows, 2)))) + 2
    trees = [_tree(x[:, view], depth, rng) for x in samples]
    width = max(map(len, trees))
    padded = [t + [(-1, 0.0, 0, 0.0)] * (width - len(t)) for t in trees]
    cols = [np.array([[n[k] for n in t] for t in padded]) for k in range(4)]
    return Forest(*cols, norm=max(_average_path(rows), 1e-9), view=view)


def fit_forest(x: np.ndarray, view: tuple[int, ...], trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    rng = np.random.default_rng(seed)
    return grown([x[rng.choice(len(x), min(rows, len(x)), replace=False)] for _ in range(trees)], view, rng)


def tree_samples(rows: DataFrame, clean: int, other: int, trees: int = TREES, size: int = TREE_ROWS, seed: int = SEED) -> list[np.ndarray]:
    """The ratios of ``size`` rows a tree (all, if fewer), drawn without replacement by hash among all of ``rows``.

    Anomalies are rare where a forest grows: label 0 is drawn less often, so that it makes
    up a tenth of a tree's rows at most.  A fixed number of rows comes to the driver.
    """
    thin = min(1.0, clean / 9 / other) if clean and other else 1.0
    rate = min(1.0, 2 * size / (clean + thin * other))
    names = [c for c in rows.columns if c != "label"]
    even = F.shiftrightunsigned(F.xxhash64(*names, "tree", F.lit(seed)), 11) * F.lit(2.0 ** -53)
    place = even / F.when(F.col("label") == 0, F.lit(rate * thin)).otherwise(F.lit(rate))
    drawn = (rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("place", place).where("place < 1")
             .withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy("place", *names))).where(F.col("rank") <= size))
    got = drawn.orderBy("tree", "rank").toPandas()
    x, tree = features(got[[c.split()[0] for c in STATISTICS.split(", ")]].to_numpy(np.int64)), got["tree"].to_numpy()
    return [x[tree == t] for t in np.unique(tree)]


def calibrated(forests: list[Forest], clean: DataFrame, n: int, clean_loss: float = CLEAN_LOSS) -> list[Forest]:
    """Set the thresholds: scores above are rejected; at most ``clean_loss`` of the ``n`` rows ``clean`` lie above each.

    Every row is scored in tasks; a threshold is the score of its exact rank.
    """
    if not n:
        return forests
    names = [f"s{i}" for i in range(len(forests))]

    def run(batches):
        for batch in batches:
            x = features(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(f.scores(x)) for f in forests], names=names)

    scores = written(clean.select(*(c.split()[0] for c in STATISTICS.split(", "))).mapInArrow(run, ", ".join(f"{c} double" for c in names)), "rule-scores")
    rank = n - int(np.ceil((n - 1) * (1 - clean_loss)))
    for f, c in zip(forests, names):
        f.threshold = float(scores.select(c).orderBy(F.col(c).desc()).limit(rank).agg(F.min(c)).first()[0])
    return forests


def margins(forests: list[Forest], x: np.ndarray) -> np.ndarray:
    """The largest excess of a row's anomaly scores over the thresholds; above 0 the row goes."""
    return np.max([f.scores(x) - f.threshold for f in forests], axis=0)


def fit_rules(docs: DataFrame, labels: DataFrame) -> list[Forest] | None:
    """Forests and thresholds from all labelled rows; None without labelled rows.

    Rows that fail the base rules are left out, unless all do.  Statistics are taken where
    the texts lie and then joined to the labels, so no text is shuffled.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    rows = written(append_statistics(texts, ["doc_id"]).join(marked_rows(labels, "quality", F.lit(True)), "doc_id"), "rule-statistics")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counts = {(r["label"], r["failed"]): r["count"] for r in rows.groupBy("label", failed.alias("failed")).count().collect()}
    if not counts:
        return None
    some = any(not f for _, f in counts)
    if some:
        rows = rows.where(~failed)
    clean, other = (sum(n for (k, f), n in counts.items() if k == label and not (some and f)) for label in (1, 0))
    samples = tree_samples(rows, clean, other)
    return calibrated([grown(samples, view, np.random.default_rng(SEED)) for view in VIEWS], rows.where("label = 1"), clean)


def append_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    return append(docs, lambda texts: list(rule_statistics(texts).T), STATISTICS, keep)


def quality_rules(docs: DataFrame, forests: list[Forest] | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, statistics, ``base_failed``, ``anomaly`` and ``kept`` of each row.

    ``anomaly`` is the largest excess over a forest's threshold.  Null and empty texts
    have no words, so they fail the base rules.  ``kept`` is false where the base rules
    fail or ``anomaly`` is above 0; with no labelled rows (``forests`` None) the base
    rules alone decide.  Repeated rows repeat; an empty table gives an empty result;
    other columns are ignored.
    """
    def make(texts):
        stats = rule_statistics(texts)
        failed = base_failed(stats)
        anomaly = np.full(len(stats), -1.0) if forests is None or not len(stats) else margins(forests, features(stats))
        return [*stats.T, failed, anomaly, ~failed & (anomaly <= 0)]

    return append(docs, make, STATISTICS + ", base_failed boolean, anomaly double, kept boolean", list(keep))
