"""Quality classifier: histogram gradient-boosted trees over statistics of the text.

Trees are grown on quantile bins and kept as flat arrays (feature, threshold, left child, value), so that all rows of a batch
step down all trees together in numpy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, frugal, text_bytes
from .shingles import shingle_hashes, word_hashes

#: Labelled documents that the model is fitted on at most, those of smallest hashed id (the documented bound).
FIT_DOCS = 20_000
TREES, DEPTH, BINS, RATE, LEAST_ROWS, SHRINK = 60, 5, 64, 0.15, 10, 1.0
FEATURES = (
    "log_chars", "log_words", "word_length", "upper", "digit", "symbol", "bang", "pipe", "other_punctuation", "non_ascii", "space",
    "distinct_words", "most_frequent_word", "distinct_runs", "distinct_lines", "words_a_line", "compressed",
)


def _classes() -> np.ndarray:
    """Class of each byte: upper 0, digit 1, symbol 2, ! 3, | 4, other punctuation 5, beyond ASCII 6, white space 7, else 8."""
    c = np.full(256, 8)
    c[33:127] = 5
    for lo, hi, k in ((65, 91, 0), (48, 58, 1), (128, 256, 6), (97, 123, 8)):
        c[lo:hi] = k
    c[[ord(x) for x in "#*$%&<>=~^_\\{}@"]] = 2
    c[33], c[124] = 3, 4
    c[[9, 10, 11, 12, 13, 32]] = 7
    return c


CLASSES = _classes()


def statistics(col: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text; null counts as empty, all zeros."""
    data, off = text_bytes(col)
    n = len(off) - 1
    size = np.diff(off)
    words, starts = word_hashes(data, off)
    count = np.diff(starts)
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * 9 + CLASSES[data], minlength=n * 9).reshape(n, 9)
    lines = np.bincount(doc[data == 10], minlength=n) + 1
    run_doc, *_ = shingle_hashes(words, starts, 3)
    runs = np.bincount(run_doc, minlength=n)
    out = np.zeros((n, len(FEATURES)))
    raw = data.tobytes()
    for i in range(n):
        if not size[i]:
            continue
        text = raw[off[i] : off[i + 1]]
        own, times = np.unique(words[starts[i] : starts[i + 1]], return_counts=True)
        whole = text.split(b"\n")
        w = max(count[i], 1)
        k = kinds[i] / size[i]
        out[i] = (
            np.log(size[i]), np.log(w), (size[i] - kinds[i, 7]) / w, *k[:8], len(own) / w, times.max() / w if len(times) else 0, runs[i] / max(count[i] - 2, 1), len(set(whole)) / len(whole), w / lines[i],
            len(zlib.compress(text, 1)) / size[i],
        )
    return out


class Trees:
    """Flat trees: a node's left child is `child`, its right child the next; a leaf is its own child."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, child: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.threshold, self.child, self.value = base, feature, threshold, child, value

    def score(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        z = np.full(len(x), self.base)
        for t in range(len(self.feature)):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                right = x[rows, self.feature[t, at]] > self.threshold[t, at]
                at = np.where(self.child[t, at] == at, at, self.child[t, at] + right)
            z += self.value[t, at]
        return 1 / (1 + np.exp(-z))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for the logistic loss: gradients and curvatures are summed by bin, the best gain splits, to DEPTH levels."""
    n, m = x.shape if x.size else (0, len(FEATURES))
    nodes = 2 ** (DEPTH + 1)
    rate = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate / (1 - rate)))
    trees = TREES if n and 0 < y.sum() < n else 0
    feature, threshold = np.zeros((trees, nodes), np.int64), np.zeros((trees, nodes))
    child, value = np.tile(np.arange(nodes), (trees, 1)), np.zeros((trees, nodes))
    if not trees:
        return Trees(base, feature, threshold, child, value)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)], axis=1)
    z = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        todo, free = [(0, np.arange(n), 0)], 1
        while todo:
            node, rows, level = todo.pop(0)
            G, H = g[rows].sum(), h[rows].sum()
            best = (1e-6, -1, -1)
            if level < DEPTH and len(rows) >= 2 * LEAST_ROWS:
                for j in range(m):
                    b = binned[rows, j]
                    gl, hl, nl = (np.cumsum(np.bincount(b, w, minlength=BINS)) for w in (g[rows], h[rows], np.ones(len(rows))))
                    ok = (nl >= LEAST_ROWS) & (len(rows) - nl >= LEAST_ROWS)
                    ok[len(edges[j]) :] = False
                    gain = np.where(ok, gl**2 / (hl + SHRINK) + (G - gl) ** 2 / (H - hl + SHRINK) - G**2 / (H + SHRINK), 0)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], j, k)
            if best[1] < 0:
                value[t, node] = RATE * G / (H + SHRINK)
                z[rows] += value[t, node]
                continue
            _, j, k = best
            feature[t, node], threshold[t, node], child[t, node] = j, edges[j][k], free
            left = binned[rows, j] <= k
            todo += [(free, rows[left], level + 1), (free + 1, rows[~left], level + 1)]
            free += 2
    return Trees(base, feature, threshold, child, value)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", bound: int = FIT_DOCS) -> Trees:
    """Trees from at most `bound` labelled whole texts; the driver gets their statistics only (a few MB).

    Rows without an id or label teach nothing; of several labels of an id the largest counts, and an id counts with all its rows. Without both labels the score
    is the rate of the one there is (a half without any).
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(id_col).agg(F.max(label).cast("int").alias("_y"))
    times = docs.groupBy(id_col).agg(F.count("*").alias("_n"))
    some = known.join(times, id_col).withColumn("_h", F.xxhash64(id_col)).orderBy("_h", id_col).limit(bound)
    total = F.sum("_n").over(Window.orderBy("_h", id_col).rowsBetween(Window.unboundedPreceding, 0))  # over at most `bound` rows
    some = some.withColumn("_r", total).where(F.col("_r") <= bound).select(id_col, "_y")
    rows = docs.select(id_col, text).join(F.broadcast(some), id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                x = statistics(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["id", "y", "x"])

    got = rows.mapInArrow(frugal(run), f"id {docs.schema[id_col].dataType.simpleString()}, y int, x array<double>").orderBy("id").toPandas()
    return grow(np.array(got["x"].tolist(), np.float64).reshape(len(got), len(FEATURES)), got["y"].to_numpy(np.float64))


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id and score (0 to 1) of every row, by its whole text alone; null counts as empty. No shuffle; the trees are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.score(statistics(part.column(1))))], names=[id_col, "score"])

    return docs.select(id_col, text).mapInArrow(frugal(run), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double")
