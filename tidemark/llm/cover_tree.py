"""Exact top-k inner products by a dual-tree search over cover trees.

Each block of rows and each block of queries becomes a cover tree: a node has
a centre (one of its points) and a covering radius. Its children's centres are
chosen farthest first, so every point lies within its child's radius and the
centres are at least the widest child's radius apart. Both trees are walked
together. For a query node with centre c and radius s, and a row node with
centre p and radius r, every inner product lies within

    c.p +- (|c| r + s |p| + s r)

A query node carries the row nodes that its queries may still need. The lower
ends give a floor under its worst kth score: that of the nodes which together
hold k candidates. Row nodes whose upper end is below the floor are dropped
for the whole group; nodes wider than the group are opened; the rest goes to
the group's children. A leaf of queries visits its nodes by falling upper end,
in steps that double, until none reaches the worst kth score found. An equal
bound is visited: ties go to the smaller id. Node pairs are handled as arrays.

Bounds of this kind prune where vectors lie in clusters. Among directions that
are all about equally far apart no radius is small, and every pair is visited.

Vectors here are the integers floor(256 x); products are exact in doubles.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vector_blocks

QUERY_LEAF, ROW_LEAF, FAN, STEP = 4, 8, 8, 16


class CoverTree:
    """Nodes as arrays: the points of node n are ``order[lo[n]:hi[n]]``, its
    children are the nodes ``child[n]`` to ``child[n] + kids[n] - 1``."""

    def __init__(self, points: np.ndarray, leaf: int, fan: int = FAN):
        self.points, self.order = points, np.arange(len(points))
        lo, hi, centre, radius, child, kids = [0], [len(points)], [0], [], [], []
        todo = 0
        while todo < len(lo):  # children stand behind their parents
            span = slice(lo[todo], hi[todo])
            at = self.order[span]
            x = points[at]
            gap = self._squares(x, points[centre[todo]])
            radius.append(float(np.sqrt(gap.max())))
            child.append(len(lo))
            kids.append(0)
            if len(at) > leaf and radius[-1] > 0:
                own, starts = np.zeros(len(at), dtype=np.int64), [centre[todo]]
                for c in range(1, fan):
                    far = int(gap.argmax())
                    if gap[far] == 0:
                        break
                    d = self._squares(x, x[far])
                    own[d < gap] = c
                    gap = np.minimum(gap, d)
                    starts.append(int(at[far]))
                self.order[span] = at[np.argsort(own, kind="stable")]
                ends = lo[todo] + np.cumsum(np.bincount(own, minlength=len(starts)))
                lo += [lo[todo], *ends[:-1].tolist()]
                hi += ends.tolist()
                centre += starts
                kids[-1] = len(starts)
            todo += 1
        self.lo, self.hi, self.centre = np.array(lo), np.array(hi), np.array(centre)
        self.radius, self.child, self.kids = np.array(radius), np.array(child), np.array(kids)
        self.at_centre = points[self.centre]
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.at_centre, self.at_centre))

    @staticmethod
    def _squares(x: np.ndarray, p: np.ndarray) -> np.ndarray:
        away = x - p
        return np.einsum("ij,ij->i", away, away)

    def opened(self, nodes: np.ndarray) -> np.ndarray:
        """All children of ``nodes``."""
        return spans(self.child[nodes], self.child[nodes] + self.kids[nodes])

    def rows(self, nodes: np.ndarray, enough: int | None = None) -> np.ndarray:
        """The points of ``nodes``; of nodes whose points are all equal the
        first ``enough``."""
        hi = self.hi[nodes]
        if enough is not None:
            hi = np.where(self.radius[nodes] == 0, np.minimum(hi, self.lo[nodes] + enough), hi)
        return self.order[spans(self.lo[nodes], hi)]


def spans(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all ranges lo..hi-1, one after the other."""
    size = hi - lo
    return np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)


def dual_search(qid: np.ndarray, q: np.ndarray, rid: np.ndarray, r: np.ndarray, k: int, counts: dict | None = None):
    """Positions and scores of each query's k best rows of another id.
    ``counts`` takes the number of query-row pairs that were scored."""
    order = np.argsort(rid, kind="stable")
    r, ids = r[order], rid[order]
    qt, rt = CoverTree(q, QUERY_LEAF), CoverTree(r, ROW_LEAF)
    best = np.full((len(q), k), -np.inf)
    who = np.full((len(q), k), -1, dtype=np.int64)
    last = np.iinfo(np.int64).max
    # Candidates that are surely enough, whatever rows a query's own id has.
    enough = k + int(np.unique(ids, return_counts=True)[1].max())
    slack = 1e-9 * (1.0 + float(qt.norm.max() + qt.radius[0]) * float(rt.norm.max() + rt.radius[0]))

    def reach(a: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Products of the centres, and how far other pairs may be from them."""
        off = qt.norm[a] * rt.radius[nodes] + qt.radius[a] * (rt.norm[nodes] + rt.radius[nodes])
        return rt.at_centre[nodes] @ qt.at_centre[a], off

    def score(at: np.ndarray, rows: np.ndarray) -> None:
        if counts is not None:
            counts["scored"] = counts.get("scored", 0) + len(at) * len(rows)
        s = q[at] @ r[rows].T
        s[qid[at][:, None] == ids[rows][None, :]] = -np.inf
        hit = (s >= best[at, -1:]) & ~np.isneginf(s)
        some = hit.any(axis=0)
        go = np.flatnonzero(hit.any(axis=1))
        if len(go):
            to = at[go]
            s = np.concatenate([best[to], s[go][:, some]], axis=1)
            w = np.concatenate([who[to], np.broadcast_to(rows[some], (len(go), int(some.sum())))], axis=1)
            tie = np.where(np.isneginf(s), last, ids[w])
            pick = np.lexsort((tie, -s), axis=-1)[:, :k]
            best[to] = np.take_along_axis(s, pick, 1)
            who[to] = np.take_along_axis(w, pick, 1)

    todo = [(0, np.array([0]))]
    while todo:
        a, nodes = todo.pop()
        wide = (rt.kids[nodes] > 0) & (rt.radius[nodes] >= qt.radius[a])
        if qt.kids[a] and wide.any():
            nodes = np.concatenate([nodes[~wide], rt.opened(nodes[wide])])
        mid, off = reach(a, nodes)
        by = np.argsort(off - mid, kind="stable")
        held = np.cumsum((rt.hi - rt.lo)[nodes[by]])
        at = int(np.searchsorted(held, enough))
        floor = (mid - off)[by[at]] if at < len(by) else -np.inf
        near = mid + off >= floor - slack
        nodes, top = nodes[near], (mid + off)[near]
        if qt.kids[a]:
            todo += [(c, nodes) for c in range(qt.child[a], qt.child[a] + qt.kids[a])]
            continue
        group, step = qt.order[qt.lo[a]:qt.hi[a]], STEP
        while len(nodes):
            first = np.argsort(-top, kind="stable")
            now, nodes, top = nodes[first[:step]], nodes[first[step:]], top[first[step:]]
            inner = rt.kids[now] > 0
            if (~inner).any():
                score(group, rt.rows(now[~inner], enough))  # equal vectors: the smaller ids win
            if inner.any():
                more = rt.opened(now[inner])
                mid, off = reach(a, more)
                nodes, top = np.concatenate([nodes, more]), np.concatenate([top, mid + off])
            near = top >= max(floor, float(best[group, -1].min())) - slack
            nodes, top = nodes[near], top[near]
            step *= 2
    i, j = np.nonzero(~np.isneginf(best))
    return i, order[who[i, j]], best[i, j].astype(np.int64)


def top_inner_products(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256,
                       **blocks: int) -> DataFrame:
    """For queries (vec_id divisible by ``every``) the k best of all other
    rows by integer inner product: query_id, rank, vec_id, score (long)."""
    rows = vector_blocks.usable(vectors).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))
    return vector_blocks.search(
        rows, F.col("vec_id") % every == 0, k, lambda a, b, c, d: dual_search(a, b, c, d, k), "long", False, **blocks)
