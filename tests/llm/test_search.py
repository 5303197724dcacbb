"""The two vector searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import cover_tree, permutation_index, vector_blocks

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("score", T.StringType()), T.StructField("rank", T.StringType())])


def frame(spark, x: np.ndarray, extra=()):
    rows = [(i, [float(v) for v in r], "s", "r") for i, r in enumerate(x)]
    return spark.createDataFrame([*rows, *extra], SCHEMA)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[100:400] = x[100]          # a third are one vector: ties
    x[400:500] = x[400] + rng.normal(size=(100, 16)).astype(np.float32) * 0.01
    return x


ODD = [(50_000, None, "", ""), (50_100, [], "", ""), (50_200, [1.0, None] * 8, "", ""),
       (50_300, [float("nan")] * 16, "", ""), (50_400, [float("inf")] * 16, "", ""), (None, [1.0] * 16, "", "")]


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 200, "block_queries": 7}])
def test_cover_tree_is_exact(spark, points, blocks):
    got = cover_tree.top_inner_products(frame(spark, points, ODD), every=10, k=5, **blocks).collect()
    v = np.floor(points.astype(float) * 256)
    ids = np.arange(len(v))
    want = set()
    for q in range(0, len(v), 10):
        s = v @ v[q]
        others = ids[ids != q]
        top = others[np.lexsort((others, -s[others]))][:5]
        want |= {(q, r + 1, int(j), int(s[j])) for r, j in enumerate(top)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want


def test_cover_tree_covers_and_separates(points):
    x = points.astype(float)
    t = cover_tree.CoverTree(x, leaf=8)
    assert sorted(t.order) == list(range(len(x))) and (t.lo[0], t.hi[0]) == (0, len(x))
    leaves = 0
    for n in range(len(t.lo)):
        at = t.rows(np.array([n]))
        assert np.sqrt(((x[at] - t.at_centre[n]) ** 2).sum(axis=1)).max() <= t.radius[n] + 1e-9
        assert t.centre[n] in at
        if not t.kids[n]:
            leaves += len(at)
            continue
        kids = t.opened(np.array([n]))
        assert sorted(np.concatenate([t.rows(np.array([c])) for c in kids])) == sorted(at)
        c = t.at_centre[kids]
        apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2))
        assert apart[~np.eye(len(kids), dtype=bool)].min() >= t.radius[kids].max() - 1e-9
    assert leaves == len(x)


def test_cover_tree_prunes_clusters():
    """Where vectors lie in clusters, few pairs are scored; the result is that
    of brute force, repeated ids and ties included."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(60, 32))
    x = np.floor(256 * (centres[rng.integers(0, 60, 6_000)] + rng.normal(size=(6_000, 32)) * 0.02))
    x[3_000:4_000] = x[3_000]
    ids = np.arange(6_000)
    ids[10:20] = 100
    q = np.flatnonzero(ids % 50 == 0)
    q = q[np.unique(ids[q], return_index=True)[1]]
    counts = {}
    i, j, s = cover_tree.dual_search(ids[q], x[q], ids, x, 5, counts)
    got = {}
    for a, b, c in zip(i, j, s):
        got.setdefault(int(a), []).append((int(c), int(ids[b])))
    for a, at in enumerate(q):
        full = x @ x[at]
        other = np.flatnonzero(ids != ids[at])
        top = other[np.lexsort((ids[other], -full[other]))][:5]
        assert got[a] == [(int(full[b]), int(ids[b])) for b in top]
    assert counts["scored"] <= 0.1 * len(q) * len(x)


def test_small_tables(spark):
    one = frame(spark, np.ones((1, 4), np.float32))
    assert cover_tree.top_inner_products(one).collect() == []
    assert permutation_index.nearest(one).collect() == []
    none = one.where("false")
    assert cover_tree.top_inner_products(none).collect() == []
    assert permutation_index.nearest(none).collect() == []
    three = frame(spark, np.eye(3, dtype=np.float32))
    assert [(r["rank"], r["vec_id"]) for r in permutation_index.nearest(three).collect()] == [(1, 1), (2, 2)]


def test_permutation_index_recall(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(6_000, 32)).astype(np.float32)
    x[:2_000] = x[0] + rng.normal(size=(2_000, 32)).astype(np.float32) * 0.3
    x[10] = 0  # zero vectors take no part
    got = permutation_index.nearest(frame(spark, x, ODD), every=100, k=10, candidates=1_200).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    v, hits, total = x.astype(float), 0, 0
    assert set(found) == set(range(0, 6_000, 100))
    for q, rows in found.items():
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        assert [r for r, _, _ in sorted(rows)] == list(range(1, 11))
        for _, j, s in rows:
            assert j not in (q, 10) and s == pytest.approx(d[j], abs=1e-12)
        d[[q, 10]] = np.inf
        hits += len(set(np.argsort(d, kind="stable")[:10].tolist()) & {j for _, j, _ in rows})
        total += 10
    assert hits / total >= 0.9


def test_permutation_index_whole_blocks_are_exact(spark, points):
    got = permutation_index.nearest(frame(spark, points), every=100, k=10).collect()
    v = points.astype(float)
    for q in range(0, 900, 100):
        d = np.sqrt(((v - v[q]) ** 2).sum(axis=1))
        others = np.flatnonzero(np.arange(900) != q)
        want = others[np.lexsort((others, d[others]))][:10].tolist()
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want


@pytest.mark.parametrize("n", [14, 500, 2_000])
def test_permutation_index_serves_small_blocks(spark, monkeypatch, n):
    """Every query of a block reads the inverted files, also when the block is
    smaller than the rerank of a large one."""
    x = np.random.default_rng(8).normal(size=(n, 8))
    taken = []
    monkeypatch.setattr(vector_blocks, "search", lambda rows, q, k, nearest, *a, **b: taken.append(nearest))
    permutation_index.nearest(frame(spark, x), every=100, k=10)
    asked = []
    nearness = permutation_index.InvertedFiles.nearness
    monkeypatch.setattr(permutation_index.InvertedFiles, "nearness", lambda f, o: asked.append(f.n) or nearness(f, o))
    ids = np.arange(n)
    at, who, _ = taken[0](ids[::100], x[::100], ids, x)
    assert asked == [n] * len(ids[::100]) and len(who) == 10 * len(asked)
    assert permutation_index.rerank_budget(n, 10) <= max(10, n // 2)
    # A length that no pivot has, rows in any order.
    mixed = np.random.default_rng(9).permutation(n)
    _, other, _ = taken[0](ids[:1], x[:1, :5], ids[mixed], x[mixed][:, :5])
    assert asked[-1] == n and len(asked) == len(ids[::100]) + 1 and 0 not in ids[mixed][other]


@pytest.mark.parametrize("n", [3_000, 40_000])
def test_permutation_index_recall_at_production_parameters(spark, n):
    """Under one block and in three of them (16,384 rows at most each)."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, 32)).astype(np.float32)
    x[::3] = x[0] + rng.normal(size=(len(x[::3]), 32)).astype(np.float32) * 0.3
    every = n // 30
    got = permutation_index.nearest(frame(spark, x), every=every, k=10).collect()
    found, v, hits = {}, x.astype(float), 0
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert set(found) == set(range(0, n, every))
    for q, ids in found.items():
        d = ((v - v[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        assert len(ids) == 10 and q not in ids
        hits += len(set(np.argsort(d, kind="stable")[:10].tolist()) & ids)
    print(f"recall at 10 of {n} rows: {hits / len(got):.3f}")
    assert hits / len(got) >= 0.9


def test_footrule():
    rng = np.random.default_rng(1)
    x, p = rng.normal(size=(50, 8)), rng.normal(size=(20, 8))
    o = permutation_index.nearest_pivots(x, p, 6)
    files = permutation_index.InvertedFiles(o, 20)
    place = np.full((50, 20), 6)
    np.put_along_axis(place, o, np.arange(6)[None].repeat(50, 0), 1)
    foot = np.abs(place - place[0]).sum(axis=1)
    near = files.nearness(o[0])
    assert (foot == 2 * (6 + 5 + 4 + 3 + 2 + 1) - 2 * near).all()
