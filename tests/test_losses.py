"""Rows that must not vanish or change: NULL keys and times, late candles,
series without a fit, prices far over a million."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.columns import half_up_div
from tidemark.operators import incremental, ml, positions
from tidemark.plans.features import build_features

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "series string, open_time timestamp, open double, high double, low double, close double, volume double"


def candles(spark, hours, series="a", scale=1.0):
    rows = [(series, T0 + dt.timedelta(hours=h), *[scale * (100.0 + (h * 7 % 23) + d) for d in (0.25, 1.0, -1.0, 0.5)], 1.0 + h)
            for h in hours]
    return spark.createDataFrame(rows, SCHEMA)


def test_null_keys_and_times_keep_their_rows(spark):
    rows = [("a", T0, 1), ("a", None, 2), (None, T0, 3), (None, None, 4), ("a", T0 + dt.timedelta(days=2), 5)]
    df = spark.createDataFrame(rows, "k string, t timestamp, i int")
    got = positions.with_position(df, ["k"], ["t", "i"], bucket_unit="day").collect()
    assert {(r["i"], r[positions.POS], r[positions.SLEN]) for r in got} == {
        (2, 0, 3), (1, 1, 3), (5, 2, 3), (4, 0, 2), (3, 1, 2)}


def test_late_candles_are_returned_and_rebuilt(spark):
    stored = candles(spark, [h for h in range(60) if h != 40])
    new = candles(spark, [40, 60, 61])
    res = incremental.append_candles(stored, new, incremental.feature_state(stored))
    assert res.appended.count() == 2 and [r["open_time"] for r in res.late.collect()] == [T0 + dt.timedelta(hours=40)]
    whole = stored.unionByName(res.appended.select(*stored.columns))
    fixed = incremental.rebuild(whole, res.late)
    want = build_features(candles(spark, range(62)))
    order = sorted(want.columns)
    assert sorted(map(str, fixed.features.select(*order).collect())) == sorted(map(str, want.select(*order).collect()))


def test_large_prices_do_not_overflow(spark):
    small = build_features(candles(spark, range(40))).select("volatility_24").collect()
    large = build_features(candles(spark, range(40), scale=1e7)).select("volatility_24").collect()
    assert len(large) == len(small) and all(abs(a[0] / 1e7 - b[0]) <= 0.006 for a, b in zip(large, small, strict=True))


def test_integer_half_up_division(spark):
    n = (1 << 60) + 1
    df = spark.createDataFrame([(n, 2), (-n, 2), (5, 2), (-5, 2), (4, 3)], "a long, b long")
    got = [r[0] for r in df.select(half_up_div(F.col("a"), F.col("b"))).collect()]
    assert got == [(n + 1) // 2, -((n + 1) // 2), 3, -3, 1]


def test_series_without_a_fit_keep_their_rows(spark):
    frame = spark.createDataFrame([("a", "train", 1.0, 2.0), ("a", "train", 2.0, 4.0), ("a", "test", 3.0, 6.0),
                                   ("b", "test", 1.0, 2.0)], "series string, split string, close double, target double")
    pred = ml.predict_simple(frame, ml.fit_simple(frame))
    assert {(r["series"], r["close"], r["prediction"]) for r in pred.collect()} == {
        ("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, 6.0), ("b", 1.0, None)}
