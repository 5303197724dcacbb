"""Layouts for long and hot series: levels, sampled ranges, time frames, gaps,
mergeable states, ordered and bucketed tables."""

from __future__ import annotations

import datetime as dt
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paths import SF001
from tidemark.operators import clean, moments, positions, scan, timeframes
from tidemark.operators.ranges import ranged, with_range_position
from tidemark.plans import refit
from tidemark.plans import registry as R
from tidemark.sources import sinks
from tidemark.sources.tables import order_ticks

T0 = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fan", [2, 3, 50, 1024])
def test_carried_sums_by_levels(spark, fan):
    rows = [(k, i, float((i * 7) % 11)) for k, n in (("a", 300), (None, 40), ("b", 1)) for i in range(n)]
    x = spark.createDataFrame(rows, "k string, at long, v double")
    got = {(r["k"], r["at"]): r["c"] for r in scan.carried_sums(x, ["k"], "at", "v", "c", fan).collect()}
    assert got == {(k, i): sum(v for kk, j, v in rows if kk == k and j < i) for k, i, _ in rows}
    assert scan.carried_sums(x.limit(0), ["k"], "at", "v", "c", fan).collect() == []


def test_no_window_over_a_whole_series(spark):
    """Every window of the level scans is over a block or a group."""
    x = spark.range(2_000).selectExpr("'a' as k", "id as at", "1.0D as v")
    text = scan.carried_sums(x, ["k"], "at", "v", "c", 16)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.split("\n") if "Window [" in line]
    assert windows and all("_up#" in line.split("windowspecdefinition(")[1] for line in windows)


def test_block_tables_do_not_shuffle_the_rows(spark):
    """Offsets and carries have one row per bucket or block: where they are
    under the broadcast limit, the many rows they meet are not shuffled."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        x = spark.range(0, 40_000, 1, 4).selectExpr("'a' as k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) as ts", "id",
                                                    "rand(5) as v")
        posd = positions.with_position(x, ["k"], ["ts", "id"])
        mean = scan.ewm(positions.halo_blocks(posd, ["k"], 4_096), ["k"], {"y": "v"}, 13, 0, 4_096, spent=["ts"])
        for df in (posd, mean):
            assert "BroadcastHashJoin" in plan(df) and "Exchange hashpartitioning" not in plan(df)
        assert mean.columns == ["k", "id", "v", "_n", "_pos", "_blk", "y"] and mean.where("y is not null").count() == 40_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(("com", "fan"), [(9, 4), (9, 64), (0, 8), (0.5, 3), (200, 16)])
def test_ewm_over_gaps_equals_pandas(spark, com, fan):
    rng = np.random.default_rng(7)
    rows = []
    for k, n, share in (("a", 400, 0.5), (None, 90, 0.97), ("all null", 20, 1.0), ("b", 1, 0.0)):
        x = np.where(rng.random(n) < share, np.nan, rng.normal(100, 20, n))
        x[:min(5, n // 2)] = np.nan
        if n > 300:
            x[60:200] = np.nan
        rows += [(k, i, None if np.isnan(v) else float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, _pos long, x double")
    got = {(r["k"], r["_pos"]): r["y"] for r in scan.ewm_gaps(df, ["k"], {"y": "x"}, com, fan).collect()}
    assert len(got) == len(rows)
    for k in {r[0] for r in rows}:
        want = pd.Series([np.nan if v is None else v for kk, _, v in rows if kk == k]).ewm(com=com, adjust=False).mean()
        mine = np.array([np.nan if got[k, i] is None else got[k, i] for i in range(len(want))])
        assert np.allclose(mine, want.to_numpy(), rtol=1e-12, equal_nan=True)


def test_range_positions_split_a_hot_instant(spark):
    t = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 3 = 0, null, 'a') as k", "timestamp_ntz'2024-01-01' as ts", "id")
    x = ranged(t, ["k"], ["ts", "id"])
    assert max(r["count"] for r in x.groupBy("_part").count().collect()) < 12_000
    got = with_range_position(t, ["k"], ["ts", "id"]).collect()
    assert {(r["k"], r["id"]): r["_pos"] for r in got} == {
        ("a" if i % 3 else None, i): (i // 3 if i % 3 == 0 else i - i // 3 - 1) for i in range(40_000)}
    assert with_range_position(t.limit(0), ["k"], ["ts"]).collect() == []


def test_range_positions_are_the_last_resort_of_auto(spark):
    t = spark.range(3_000).selectExpr("'a' as k", "timestamp_ntz'2024-01-01' as ts", "id")
    assert positions.choose_bucket_unit(t, ["k"], "ts", target_rows=1_000) == "range"
    a = positions.with_position(t, ["k"], ["ts", "id"], bucket_unit="range").collect()
    assert {(r["id"], r["_pos"], r["_n"]) for r in a} == {(i, i, 3_000) for i in range(3_000)}


@pytest.mark.parametrize("block", [None, 7_200, 86_400])
def test_time_frames_equal_brute_force(spark, block):
    rng = np.random.default_rng(3)
    rows = [(k, None if rng.random() < 0.05 else T0 + dt.timedelta(seconds=int(rng.integers(0, 200_000)) // 10 * 10), i,
             round(float(rng.uniform(1, 500)), 2)) for i, k in enumerate(["a"] * 300 + ["b"] * 40 + [None] * 30)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, i int, p double")
    got = {r["i"]: (r["m"], r["s"]) for r in timeframes.time_features(df, ["k"], "ts", "p", 36_000, "m", "s", block).collect()}
    assert len(got) == len(rows)
    for k, ts, i, _ in rows:
        if ts is None:
            assert got[i] == (None, None)
            continue
        x = [p for kk, t, _, p in rows if kk == k and t is not None and ts - dt.timedelta(seconds=36_000) <= t <= ts]
        assert abs(got[i][0] - np.mean(x)) < 0.00501
        assert (got[i][1] is None) if len(x) == 1 else abs(got[i][1] - np.std(x, ddof=1)) < 0.00501


@pytest.mark.parametrize("block", [None, 7_200])
def test_time_frames_are_running_totals(spark, block):
    """No sliding frame, whose work grows with the square of a span's rows;
    many rows of one span, NULL values among them, have the right means."""
    df = spark.range(20_000).selectExpr("'a' as k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 5) as ts", "id",
                                        "if(id % 3 = 0, null, cast(id % 100 as double)) as p")
    x = timeframes.time_features(df, ["k"], "ts", "p", 36_000, "m", "s", block)
    frames = [line for line in x._jdf.queryExecution().optimizedPlan().toString().split("\n") if "RangeFrame" in line]
    assert frames and all(f.count("RangeFrame, unboundedpreceding$()") == f.count("RangeFrame") for f in frames)
    pdf = df.select("id", "p").toPandas().set_index("id").p
    want = pdf.rolling(7_201, min_periods=1)
    got = x.toPandas().set_index("id").sort_index()
    assert len(got) == 20_000 and got.m.isna().sum() == 1
    assert np.allclose(got.m, want.mean(), atol=0.00501, equal_nan=True)
    assert np.allclose(got.s, want.std(), atol=0.00501, equal_nan=True)


def test_states_merge_in_any_grouping(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(1e6, 1, (500, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(0, 0.1, 500)
    df = spark.createDataFrame([("a" if i % 2 else None, int(i % 7), *map(float, x[i]), float(y[i])) for i in range(500)],
                               "k string, part int, u double, v double, t double")
    parts = moments.states(df, ["u", "v", "t"], ["k", "part"])
    model = {r["k"]: r for r in moments.solved(moments.merged(parts, 3, ["k"]), 2, ["k"]).collect()}
    for k, odd in (("a", 1), (None, 0)):
        at = np.arange(500) % 2 == odd
        want, *_ = np.linalg.lstsq(x[at] - x[at].mean(0), y[at] - y[at].mean(), rcond=None)
        assert np.allclose([model[k]["coef_0"], model[k]["coef_1"]], want, rtol=1e-6)
        assert model[k]["train_rows"] == 250


def test_refit_reads_states_and_one_block(spark):
    frame = spark.range(1_000).selectExpr("'a' as series", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) as open_time",
                                          "cast(id as double) as close", "2.0D * id + 1 as target")
    tables = refit.ModelTables.named(spark, uuid.uuid4().hex[:12], block=100)
    refit.append_rows(frame.where("close < 900"), tables, ["close"])
    refit.append_rows(frame.where("close >= 900"), tables, ["close"])
    model, bounds = refit.refit(spark, tables, ["close"], fraction=0.75)
    r = model.first()
    assert r["train_rows"] == 750 and abs(r["coef_0"] - 2) < 1e-9 and abs(r["intercept"] - 1) < 1e-6
    assert "dynamicpruning" in plan(model) or "PartitionFilters: [isnotnull" in plan(model)
    assert refit.test_rows(spark, tables, bounds).count() == 250


def test_weighted_medians_shuffle_runs(spark):
    df = spark.range(0, 20_000, 1, 4).selectExpr("if(id % 3 = 0, 'x', 'y') as k", "cast(id % 12 as double) as m",
                                                 "if(id % 5 = 0, null, cast(id % 9 as double)) as h")
    got = {r["k"]: (r["_med_m"], r["_med_h"]) for r in clean.exact_medians(df, ["m", "h"], ["k"], runs=True).collect()}
    want = df.toPandas().groupby("k").median()
    assert got == {k: (want.m[k], want.h[k]) for k in ("x", "y")}
    assert got == {r["k"]: (r["_med_m"], r["_med_h"]) for r in clean.exact_medians(df, ["m", "h"], ["k"]).collect()}


def test_bucketed_guard_does_not_move_stored_rows(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(R.QUERIES["append_new_only_stored"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    stored = text[text.rindex("SortMergeJoin"):]
    side = [line for line in stored.split("\n") if "bucketed" in line]
    assert side, text
    depth = stored.split("\n").index(side[-1])
    assert "Exchange" not in "".join(stored.split("\n")[depth - 3:depth])


def test_ordered_table_prunes_by_time(spark):
    sinks.create_namespaces(spark, ["gold"])
    name = f"gold.ordered_{uuid.uuid4().hex[:12]}"
    t = order_ticks(spark, SF001)
    sinks.write_ordered(t.select("ts", "tick_id", "price"), name, ["ts", "tick_id"])
    files = spark.table(name).groupBy(F.col("_metadata.file_name").alias("f")).agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi")).orderBy("f").collect()
    assert len(files) > 2 and all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))
    early = spark.table(name).where(F.col("ts") <= F.lit(files[0]["lo"]))
    assert "PushedFilters: [IsNotNull(ts)" in plan(early)
    assert {r[0] for r in early.select(F.col("_metadata.file_name")).distinct().collect()} <= {files[0]["f"], files[1]["f"]}
