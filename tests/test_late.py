"""Late rows replayed from carries, and profiles kept by date."""

from __future__ import annotations

import datetime as dt
import uuid

import numpy as np
import pytest

from tidemark.operators import repair as RP
from tidemark.plans import late as L
from tidemark.plans.features import build_features
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.sinks import stage

T0 = dt.datetime(2024, 1, 1)
COLUMNS = "series string, open_time timestamp_ntz, open double, high double, low double, close double, volume double"


def candles(spark, sizes: dict, seed: int = 4):
    rng = np.random.default_rng(seed)
    rows = []
    for k, n in sizes.items():
        close = np.round(100 + np.cumsum(rng.normal(0, 1, n)), 2)
        rows += [(k, T0 + dt.timedelta(hours=i), float(c), float(c) + 1, float(c) - 1, float(c), 5.0) for i, c in enumerate(close)]
    return rows


def same(got, want):
    cols = want.columns
    a = sorted(map(str, got.select(*cols).collect()))
    b = sorted(map(str, want.collect()))
    assert len(a) == len(b)
    assert a == b


# First rows, a middle one, a whole missing day, the newest rows, a series that is all late, a NULL key.
LATE = {"a": {0, 3, 900, 2_399, *range(1_512, 1_536)}, "short": {20}, "new": set(range(60)), None: {40, 1_100}}


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 256}, {"horizon": 5}])
def test_repair_equals_a_rebuild(spark, sizes):
    rows = candles(spark, {"a": 2_400, "short": 30, "new": 60, None: 1_200})
    hour = lambda r: int((r[1] - T0).total_seconds() // 3600)
    late = [r for r in rows if hour(r) in LATE[r[0]]]
    kept = [r for r in rows if hour(r) not in LATE[r[0]]]
    t = L.LateTables.named(spark, uuid.uuid4().hex[:12])
    build = {k: v for k, v in sizes.items() if k == "block_rows"}
    L.build_tables(spark.createDataFrame(kept, COLUMNS), t, **build)
    batch = spark.createDataFrame([*late, *kept[:5], late[0]], COLUMNS)     # with re-delivered rows
    done = L.take_up(batch, t, **sizes)
    whole = spark.createDataFrame(rows, COLUMNS)
    same(spark.table(t.features).drop(L.PART), build_features(whole))
    assert done.candles.count() == len(late)
    # Carries as a whole build has them.
    want = {(r["series"], r[L.PART]): r for r in RP.build(whole, ["series"], ["open_time"]).carries.collect()}
    got = {(r["series"], r[L.PART]): r for r in spark.table(t.carries).collect()}
    assert set(got) == set(want)
    for k, r in got.items():
        assert r["n"] == want[k]["n"]
        mean = want[k]["avg_gain"]
        assert r["avg_gain"] == (mean if mean is None else pytest.approx(mean, rel=1e-9))
    # Once more: nothing is new, nothing changes.
    again = L.take_up(batch, t, **sizes)
    assert again.candles.isEmpty() and again.replayed.isEmpty()
    same(spark.table(t.features).drop(L.PART), build_features(whole))


def test_replay_is_local(spark):
    """A late row replays from its day until the means have met, and reads 167
    rows before it: not the series."""
    rows = candles(spark, {"a": 24 * 400, "b": 24 * 400})
    gone = T0 + dt.timedelta(hours=24 * 200 + 5)
    t = L.LateTables.named(spark, uuid.uuid4().hex[:12])
    L.build_tables(spark.createDataFrame([r for r in rows if r[1] != gone or r[0] == "b"], COLUMNS), t)
    batch = spark.createDataFrame([r for r in rows if r[1] == gone and r[0] == "a"], COLUMNS)
    fresh = batch.withColumn(L.PART, L.part_of("open_time", "day"))
    parts = RP.plan_segments(spark.table(t.carries), fresh, ["series"], RP.HORIZON).collect()
    day = dt.date(2024, 1, 1) + dt.timedelta(days=200)
    assert {r["series"] for r in parts} == {"a"} and {r["_seg"] for r in parts} == {1}
    replayed = sorted(r[L.PART] for r in parts if r["_replay"])
    assert replayed == [day + dt.timedelta(days=i) for i in range(len(replayed))]
    assert 24 * (len(replayed) - 1) >= RP.HORIZON > 24 * (len(replayed) - 3)
    assert sorted(r[L.PART] for r in parts if not r["_replay"]) == [day - dt.timedelta(days=i) for i in range(7, 0, -1)]
    assert [r[L.PART] for r in parts if r["_meet"]] == replayed[-1:]
    # The stored candles are pruned to these dates when they are read.
    plan = RP.in_parts(spark.table(t.candles), fresh)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    done = L.take_up(batch, t)
    assert done.replayed.count() == len(replayed)
    same(spark.table(t.features).drop(L.PART), build_features(spark.createDataFrame(rows, COLUMNS)))


def test_feature_rows_are_written_once_besides_their_table(spark):
    """Of a build and of a replay, one written stage holds the feature columns."""
    n = 1_200
    rows = candles(spark, {"a": n})
    late = rows[5::100]
    base = f"{ensure_checkpoint_dir(spark)}/tidemark-stage"
    fs = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    stages = lambda: {f.getPath().toString() for f in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(base))}
    spark.range(1).transform(stage)                     # the folder is there
    before = stages()
    t = L.LateTables.named(spark, uuid.uuid4().hex[:12])
    L.build_tables(spark.createDataFrame([r for r in rows if r not in late], COLUMNS), t)
    assert L.take_up(spark.createDataFrame(late, COLUMNS), t).replayed.count() == n // 24
    staged = [spark.read.parquet(p) for p in stages() - before]
    assert sum(x.count() for x in staged if "ma_168" in x.columns) == n - len(late) + n
    same(spark.table(t.features).drop(L.PART), build_features(spark.createDataFrame(rows, COLUMNS)))


def test_empty_batch_and_empty_table(spark):
    none = spark.createDataFrame([], COLUMNS)
    t = L.LateTables.named(spark, uuid.uuid4().hex[:12])
    L.build_tables(none, t)
    assert L.take_up(none, t).features.isEmpty()
    rows = candles(spark, {"a": 50})
    L.take_up(spark.createDataFrame(rows, COLUMNS), t)
    same(spark.table(t.features).drop(L.PART), build_features(spark.createDataFrame(rows, COLUMNS)))


def test_null_key_series_over_many_blocks(spark):
    """A NULL key's means carry over block edges like any other's."""
    rows = candles(spark, {"a": 1_000})
    with_null = build_features(spark.createDataFrame([(None, *r[1:]) for r in rows], COLUMNS), block_rows=256)
    named = build_features(spark.createDataFrame(rows, COLUMNS), block_rows=256)
    assert sorted(map(str, with_null.drop("series").collect())) == sorted(map(str, named.drop("series").collect()))


def test_profile_refresh_reads_its_dates(spark):
    rows = candles(spark, {"a": 240, None: 50})
    rows.append(("a", None, None, 1.0, 1.0, None, None))
    first, second = rows[:200], [*rows[190:], rows[0]]
    raw, profile = (f"default.p_{uuid.uuid4().hex[:12]}" for _ in range(2))
    L.append_profiled(spark.createDataFrame(first, COLUMNS), raw, profile)
    kept = {(r["series"], r[L.PART]): r for r in spark.table(profile).collect()}
    L.append_profiled(spark.createDataFrame(second, COLUMNS), raw, profile)
    states = spark.table(profile).collect()
    assert len({(r["series"], r[L.PART]) for r in states}) == len(states)
    day = dt.date(2024, 1, 5)
    assert [r for r in states if (r["series"], r[L.PART]) == ("a", day)] == [kept["a", day]]
    got = {r["series"]: r for r in L.merged_profile(spark.table(profile)).collect()}
    for k in ("a", None):
        all_rows = [r for r in [*first, *second] if r[0] == k]
        times = [r[1] for r in all_rows if r[1] is not None]
        close = np.array([r[5] for r in all_rows if r[5] is not None])
        assert got[k]["total_rows"] == len(all_rows)
        assert got[k]["duplicate_rows"] == len(times) - len(set(times))
        assert got[k]["close_nulls"] == len(all_rows) - len(close)
        assert got[k]["stddev"] == pytest.approx(close.std(ddof=1), abs=0.00501)
        assert got[k]["min_price"] == close.min() and got[k]["max_price"] == close.max()
