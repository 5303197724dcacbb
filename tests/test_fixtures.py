"""Small hand-made series with known answers."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import clean as CL
from tidemark.operators import incremental as INC
from tidemark.plans.features import FEATURE_COLUMNS, build_features
from tidemark.sources.tables import CANDLE_SCHEMA, candles_from_rows

T0 = dt.datetime(2024, 1, 1, 0, 0)


def _rows(closes, hours=None, volume=1.0):
    hours = hours if hours is not None else range(len(closes))
    return [(T0 + dt.timedelta(hours=h), c, c, c, c, volume) for h, c in zip(hours, closes)]


def _feat(spark, closes, trim=False, **kw):
    df = candles_from_rows(spark, _rows(closes, **kw))
    return build_features(df, trim=trim).orderBy("open_time").collect()


@pytest.mark.parametrize("closes,expect", [
    ([10, 11, 10, 12], [None, 100.0, 92.86, 93.81]),   # rsi_mixed
    ([5, 5, 5], [None, 0.0, 0.0]),                     # rsi_flat
    ([3, 2, 1], [None, 0.0, 0.0]),                     # rsi_loss
    ([1, 2, 3], [None, 100.0, 100.0]),                 # rsi_gain
])
def test_rsi_edge_values(spark, closes, expect):
    rows = _feat(spark, [float(c) for c in closes])
    assert [r["rsi_14"] for r in rows] == expect


def test_short_24_has_no_features(spark):
    assert _feat(spark, [float(100 + i) for i in range(24)], trim=True) == []


def test_short_25_one_row_rsi_null(spark):
    rows = _feat(spark, [float(100 + i) for i in range(25)], trim=True)
    assert len(rows) == 1
    r = rows[0]
    assert r["rsi_14"] is None                      # seeded after the trim
    assert r["ma_168"] == round(sum(100 + i for i in range(25)) / 25, 2)
    assert r["lag_24"] == 100.0 and r["lag_1"] == 123.0


def test_one_row(spark):
    (r,) = _feat(spark, [42.5])
    assert r["lag_1"] is None and r["lag_24"] is None and r["returns"] is None
    assert r["volatility_24"] is None
    assert r["ma_7"] == r["ma_24"] == r["ma_168"] == 42.5


def test_tie_mean_rounds_half_up(spark):
    rows = _feat(spark, [0.01, 0.02])
    assert rows[1]["ma_7"] == 0.02                 # 0.015 -> 0.02


def test_gap_uses_previous_row_not_hour(spark):
    rows = _feat(spark, [1.0, 2.0, 3.0], hours=[0, 1, 5])
    assert rows[2]["lag_1"] == 2.0


def test_feature_columns_and_types(spark):
    df = build_features(candles_from_rows(spark, _rows([float(i + 1) for i in range(30)])))
    assert df.columns == ["series", *FEATURE_COLUMNS]
    types = dict(df.dtypes)
    assert types["hour"] == types["day_of_week"] == types["month"] == "int"
    assert types["open_time"] == "timestamp_ntz"


def test_dup_time_lowest_id_survives_then_filter(spark):
    schema = T.StructType(CANDLE_SCHEMA.fields + [T.StructField("id", T.LongType())])
    rows = [("s", T0, 1.0, 1.0, 1.0, 0.0, 1.0, 1),     # lowest id, close 0 -> slot removed
            ("s", T0, 2.0, 2.0, 2.0, 2.0, 1.0, 2),
            ("s", T0 + dt.timedelta(hours=1), 3.0, 3.0, 3.0, 3.0, 1.0, 5)]
    df = spark.createDataFrame(rows, schema)
    out = CL.clean_candles(df, ["series"], ["open_time"], tiebreak=["id"]).collect()
    assert [r["id"] for r in out] == [5]


def test_bad_values_removed(spark):
    rows = [("s", T0 + dt.timedelta(hours=i), 1.0, 1.0, 1.0, c, v)
            for i, (c, v) in enumerate([(-1.0, 1.0), (0.0, 1.0), (math.nan, 1.0), (5.0, -1.0),
                                        (5.0, 1.0)])]
    df = spark.createDataFrame(rows, CANDLE_SCHEMA)
    out = CL.clean_candles(df).collect()
    assert len(out) == 1 and out[0]["close"] == 5.0


def test_redelivered_append_changes_nothing(spark):
    df = candles_from_rows(spark, _rows([float(100 + i) for i in range(40)]))
    state = INC.feature_state(df)
    res = INC.append_candles(df, df.filter(F.col("open_time") >= T0 + dt.timedelta(hours=30)),
                             state)
    assert res.features.count() == 0
    assert res.state.collect()[0]["last_pos"] == 39


def test_late_candle_detected(spark):
    df = candles_from_rows(spark, _rows([float(100 + i) for i in range(40)]))
    state = INC.feature_state(df)
    late = candles_from_rows(spark, [(T0 + dt.timedelta(hours=3, minutes=30), 1.0, 1.0, 1.0, 1.0, 1.0)])
    assert INC.late_rows(late, state, ["series"]).count() == 1
