"""Readers for the input tables and the series views built on them.

A *series frame* is any DataFrame with key column(s), an order and OHLCV or
tick columns. The library's convention:

* ticks:   ``series, ts, tick_id, price``           order ``(ts, tick_id)``
* candles: ``series, open_time, open, high, low, close, volume``
           order ``open_time`` (unique per series after cleaning)

Readers only declare the scan; column pruning and filter push-down into the
Parquet reader are left to Catalyst.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Raw candle schema (explicit, not inferred).
CANDLE_SCHEMA = T.StructType([
    T.StructField("series", T.StringType(), False),
    T.StructField("open_time", T.TimestampNTZType(), False),
    T.StructField("open", T.DoubleType(), False),
    T.StructField("high", T.DoubleType(), False),
    T.StructField("low", T.DoubleType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("volume", T.DoubleType(), False),
])

CANDLE_COLUMNS = ["open_time", "open", "high", "low", "close", "volume"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the input Parquet tables."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def ticks(spark: SparkSession, sf_dir: str, key: str = "event_type") -> DataFrame:
    """``events`` as price ticks: one series per ``key`` value.

    ``key`` is ``event_type`` (few long series) or ``user_id`` (many short
    ones); ``None`` makes all events one series.
    """
    ev = load(spark, sf_dir, "events")
    series = F.lit("all") if key is None else F.col(key).cast("string")
    return ev.select(
        series.alias("series"),
        F.col("ts"),
        F.col("event_id").alias("tick_id"),
        F.col("value").alias("price"),
    )


def order_ticks(spark: SparkSession, sf_dir: str, key: str | None = None) -> DataFrame:
    """``orders`` as a price series ordered by ``(o_orderdate, o_orderkey)``.

    ``key=None``: one long series with many ties on the date; ``key="o_custkey"``:
    many short series.
    """
    o = load(spark, sf_dir, "orders")
    series = F.lit("all") if key is None else F.col(key).cast("string")
    return o.select(
        series.alias("series"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("tick_id"),
        F.col("o_totalprice").alias("price"),
    )


def ticks_as_candles(t: DataFrame) -> DataFrame:
    """Read each tick as a degenerate candle (open = high = low = close).

    Lets the feature operators run at tick resolution, which is how long
    series are exercised: ``open_time`` is the tick time, ``tick_id`` breaks
    ties and ``volume`` is the tick value.
    """
    return t.select(
        "series",
        F.col("ts").alias("open_time"),
        "tick_id",
        F.col("price").alias("open"),
        F.col("price").alias("high"),
        F.col("price").alias("low"),
        F.col("price").alias("close"),
        F.col("price").alias("volume"),
    )


def candles_from_rows(spark: SparkSession, rows, series: str = "s") -> DataFrame:
    """Local rows -> candle frame with the explicit schema (tests, appends).

    ``rows``: iterables of (open_time, open, high, low, close, volume).
    """
    data = [(series, *r) for r in rows]
    return spark.createDataFrame(data, schema=CANDLE_SCHEMA)
