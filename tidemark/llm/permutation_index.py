"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``prefix`` nearest pivots in order of distance.
Each block of rows posts its vectors in one inverted file per pivot: (row,
place of the pivot). A query reads the files of its own nearest pivots and
adds up min(prefix - its place, prefix - the row's place); the footrule
distance of the two orders (a pivot outside a prefix counts as place
``prefix``) is a constant less twice that sum, so the largest sums are the
smallest footrule distances. The best of a block (``rerank_budget``: an eighth
of its rows, at least 50 k, never more than half), equal sums to the smaller
vec_id, are reranked by exact Euclidean distance. Blocks of every size go this
way; only one that holds no more than k rows besides the query is taken whole.

Pivots are at most ``pivots`` rows, chosen by the smallest hash of vec_id (a
bounded, repeatable sample); every row is indexed. Vectors of a length that
the sample misses have their block's first rows as pivots.

Besides the vectors named in ``vector_blocks``, zero vectors take no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vector_blocks

PIVOTS, PREFIX = 256, 64
#: Rows reranked of a block: one in SHARE, at least PER_RESULT for each result.
SHARE, PER_RESULT = 8, 50


def rerank_budget(n: int, k: int) -> int:
    """How many of a block's n rows are reranked for k results."""
    return max(k, min(max(PER_RESULT * k, -(-n // SHARE)), n // 2))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Row by row the ``prefix`` nearest pivots, nearest first."""
    d = (pivots ** 2).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.argsort(d, axis=1, kind="stable")[:, :prefix]


class InvertedFiles:
    """Per pivot the rows that hold it in their prefix, with its place."""

    def __init__(self, orders: np.ndarray, pivots: int):
        n, prefix = orders.shape
        pivot, row = orders.ravel(), np.repeat(np.arange(n), prefix)
        place = np.tile(np.arange(prefix), n)
        by = np.argsort(pivot, kind="stable")
        self.rows, self.left = row[by], (prefix - place)[by]
        self.at = np.searchsorted(pivot[by], np.arange(pivots + 1))
        self.n, self.prefix = n, prefix

    def nearness(self, order: np.ndarray) -> np.ndarray:
        """Per row a number that falls as the footrule distance rises."""
        out = np.zeros(self.n, dtype=np.int64)
        for place, p in enumerate(order):
            span = slice(self.at[p], self.at[p + 1])
            out[self.rows[span]] += np.minimum(self.left[span], self.prefix - place)
        return out


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, pivots: int = PIVOTS, prefix: int = PREFIX,
            candidates: int | None = None, **blocks: int) -> DataFrame:
    """For queries (vec_id divisible by ``every``) the k nearest found of all
    other rows: query_id, rank, vec_id, score (Euclidean distance)."""
    rows = vector_blocks.usable(vectors, zero=False)
    # Bounded: at most ``pivots`` vectors come to the driver and go out again.
    chosen = [np.array(r["v"]) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()]

    def search(qid, q, rid, r):
        by_id = np.argsort(rid, kind="stable")
        rid, r = rid[by_id], r[by_id]
        some = np.array([p for p in chosen if len(p) == q.shape[1]])
        if not len(some):
            some = r[:pivots]
        budget = candidates or rerank_budget(len(r), k)
        files = orders = None
        if len(r) > budget + 1:
            length = min(prefix, len(some))
            files = InvertedFiles(nearest_pivots(r, some, length), len(some))
            orders = nearest_pivots(q, some, length)
        at, who, far = [], [], []
        for i in range(len(q)):
            pick = np.arange(len(r))
            if files is not None:
                # Equal sums: the smaller vec_id, whatever the order of the rows.
                near = files.nearness(orders[i]) * len(r) - pick
                pick = np.argpartition(-near, budget)[:budget + 1]  # one may be the query's own
            pick = pick[rid[pick] != qid[i]]
            d = np.sqrt(((r[pick] - q[i]) ** 2).sum(axis=1))
            top = np.lexsort((rid[pick], d))[:k]
            at.append(np.full(len(top), i)), who.append(by_id[pick[top]]), far.append(d[top])
        return np.concatenate(at), np.concatenate(who), np.concatenate(far)

    return vector_blocks.search(rows, F.col("vec_id") % every == 0, k, search, "double", True, **blocks)
