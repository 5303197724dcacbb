"""Quality classifier: histogram gradient-boosted trees over statistics of a
document's whole text, flattened into arrays and traversed with numpy.

Training. Statistics of about ``SAMPLE_ROWS`` labelled rows (chosen by a hash
of doc_id; all when there are fewer) come to the driver, a few hundred bytes a
row. They are cut into at most 64 quantile bins; each tree of a fixed depth
grows level by level from per-node histograms of gradients and Hessians of the
logistic loss. All trees together are three arrays over complete binary trees.

Scoring. One narrow pass: statistics of a batch of whole texts, then all rows
step down each tree together.

Defined cases: a null or empty text has the statistics of an empty text and
gets a score like any other; a row whose doc_id has several labels is learned
once per label; with labels of one class only, the score is that class's rate
(0 or 1 smoothed); with no labels it is 0.5.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_sample

#: Labelled rows learned from: an upper bound in expectation.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
BINS, DEPTH, TREES, RATE = 64, 4, 80, 0.15

STATISTICS = (
    "log_chars", "log_words", "word_len", "letters", "upper", "digits", "spaces", "symbols",
    "symbol_words", "line_words", "line_end", "repeated_lines", "distinct_words", "top_word",
    "short_words", "long_words", "upper_words", "repeated_pairs", "bars", "marks", "non_ascii",
    "byte_entropy", "log_lines",
)
_END = (".", "!", "?", '"', "”", "…", ":")
_KINDS = np.zeros((256, 6))
for _b in range(256):
    _c = chr(_b)
    _KINDS[_b] = [_b >= 128 or _c.isalpha(), 65 <= _b <= 90, 48 <= _b <= 57, _c in " \t\n\r\f\v",
                  _b < 128 and not _c.isalnum() and not _c.isspace(), _b >= 128]
_SYMBOL = re.compile(r"[^\w\s.,;:'\"()\-?]")


def statistics(text: str | None) -> list[float]:
    """The numbers a document is judged by, from its whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    n = max(1, len(raw))
    count = np.bincount(raw, minlength=256)
    letters, upper, digits, spaces, symbols, wide = (count @ _KINDS).tolist()
    words = text.split()
    w = max(1, len(words))
    bag = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    k = max(1, len(lines))
    pairs = len(set(zip(words, words[1:], strict=False)))
    p = count[count > 0] / n
    return [
        np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / w, letters / n, upper / max(1.0, letters),
        digits / n, spaces / n, symbols / n, sum(1 for x in words if _SYMBOL.search(x)) / w, len(words) / k,
        sum(x.rstrip().endswith(_END) for x in lines) / k, 1 - len(set(lines)) / k, len(bag) / w,
        max(bag.values(), default=0) / w, sum(len(x) <= 3 for x in words) / w, sum(len(x) >= 12 for x in words) / w,
        sum(x.isupper() for x in words) / w, 1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        int(count[124]) / w, (int(count[33]) + int(count[63])) / w, wide / n, float(-(p * np.log2(p)).sum()),
        np.log1p(len(lines)),
    ]


@dataclass(frozen=True)
class Trees:
    """Complete binary trees as arrays: inner node i has children 2i+1, 2i+2."""
    base: float
    feature: np.ndarray    # tree x inner node
    threshold: np.ndarray  # tree x inner node; go right above it
    leaf: np.ndarray       # tree x leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - (2 ** DEPTH - 1)]
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Boosted trees of depth DEPTH on the logistic loss."""
    inner, leaves = 2 ** DEPTH - 1, 2 ** DEPTH
    rate = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(rate / (1 - rate)))
    if len(y) == 0 or y.min() == y.max():
        empty = np.zeros((0, inner))
        return Trees(base, empty.astype(int), empty, np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    bins = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    score = np.full(len(y), base)
    feature, threshold, leaf = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        f, t = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            nodes, first = 2 ** level, 2 ** level - 1
            best = np.full(nodes, 1e-6)
            for j, c in enumerate(cuts):
                if len(c) == 0:
                    continue
                cell = (at - first) * BINS + bins[:, j]
                gs = np.bincount(cell, g, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                hs = np.bincount(cell, h, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1)
                gl, hl, ga, ha = gs[:, :len(c)], hs[:, :len(c)], gs[:, -1:], hs[:, -1:]
                gain = (gl ** 2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga ** 2 / (ha + ridge))
                gain[(hl < least * 0.01) | (ha - hl < least * 0.01)] = 0
                k = gain.argmax(axis=1)
                top = gain[np.arange(nodes), k]
                better = top > best
                best[better] = top[better]
                f[first:first + nodes][better] = j
                t[first:first + nodes][better] = c[k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), f[at]] > t[at])
        cell = at - inner
        value = -RATE * np.bincount(cell, g, leaves) / (np.bincount(cell, h, leaves) + ridge)
        score += value[cell]
        feature.append(f), threshold.append(t), leaf.append(value)
    return Trees(base, np.array(feature), np.array(threshold), np.array(leaf))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees from docs (doc_id, text) and labels (doc_id, quality)."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "quality")
    # Bounded distinct rows, so their ids may be broadcast to the scan of
    # documents; of documents that share an id one counts, the least.
    marked = F.broadcast(bounded_sample(marked, "doc_id", sample_rows))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([statistics(t.as_py()) for t in b.column(0)], pa.list_(pa.float64())),
                 b.column(1).cast(pa.float64()), b.column(2).cast(pa.int64())], names=["x", "y", "doc_id"])

    rows = (docs.select("doc_id", "text").join(marked, "doc_id").select("text", "quality", "doc_id")
            .mapInArrow(measure, "x array<double>, y double, doc_id long")
            .groupBy("doc_id", "y").agg(F.min("x").alias("x")).toArrow())
    x = np.array(rows.column("x").to_pylist(), dtype=float).reshape(-1, len(STATISTICS))
    y = rows.column("y").to_numpy().astype(float)
    order = np.lexsort((y, *x.T))  # the same trees however rows arrive
    return fit(x[order], y[order])


def predict(docs: DataFrame, trees: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """docs with ``score`` (0 to 1) and ``predicted`` (1 if at least
    ``threshold``), replacing columns of these names."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    at = keep.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t.as_py()) for t in b.column(at)]).reshape(-1, len(STATISTICS))
            s = shared.value.score(x)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=[*keep, "score", "predicted"])

    schema = docs.select(*keep).schema.add("score", T.DoubleType()).add("predicted", T.IntegerType())
    return docs.select(*keep).mapInArrow(run, schema)
