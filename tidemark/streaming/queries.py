"""Registered streaming queries."""

from __future__ import annotations

import uuid

from tidemark.plans import oracle as O
from tidemark.plans.registry import query
from tidemark.streaming import candles as S


_CLOSED = O.with_(O.CANDLES, """
SELECT * FROM candles
WHERE open_time + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")


@query("stream_candles", _CLOSED)
def stream_candles(spark, sf):
    """Candles from a tick stream with a 10-minute watermark; only closed
    windows are emitted."""
    loc = S.stream_location(spark, f"stream-candles-{uuid.uuid4().hex}")
    S.run_available(S.candle_stream(S.tick_stream(spark, sf)), f"{loc}/out", f"{loc}/ck")
    return spark.read.parquet(f"{loc}/out")


@query("stream_candles_redelivered", _CLOSED)
def stream_candles_redelivered(spark, sf):
    """The same candles when ticks arrive again, half of them in the
    same micro-batch and all of them after a restart of the stream."""
    loc = S.stream_location(spark, f"stream-again-{uuid.uuid4().hex}")
    events = spark.read.parquet(f"{sf}/events.parquet")
    for delivery in (events.unionByName(events.where("event_id % 2 = 0")), events):
        delivery.write.mode("append").parquet(f"{loc}/in")
        ticks = S.tick_stream(spark, f"{loc}/in", glob="*.parquet")
        S.run_available(S.candle_stream(ticks, once=True), f"{loc}/out", f"{loc}/ck")
    return spark.read.parquet(f"{loc}/out")


@query("stream_features", O.with_(O.FEATURES, """
SELECT series, open_time, close, ma_24, rsi_14 FROM features
WHERE open_time + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""))
def stream_features(spark, sf):
    """Closed candles -> per-batch incremental features; windows look back
    only, so they equal the batch features of the closed candles."""
    loc = S.stream_location(spark, f"stream-features-{uuid.uuid4().hex}")
    return S.run_feature_stream(spark, sf, loc).select(
        "series", "open_time", "close", "ma_24", "rsi_14")
