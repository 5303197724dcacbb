"""Ticks -> OHLCV candles, the candle shape rule and a growth index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import cents
from tidemark.operators import positions as P
from tidemark.operators.scan import FAN, running_sum

_TRUNC_UNITS = {"second", "minute", "hour", "day", "week", "month", "quarter", "year"}


def candle_start(ts: str, freq: str = "hour"):
    """Start of the candle holding ``ts``: a ``date_trunc`` unit or a
    ``window`` duration such as ``'15 minutes'``."""
    if freq in _TRUNC_UNITS:
        return F.date_trunc(freq, F.col(ts))
    return F.window(F.col(ts), freq).start


def resample(ticks: DataFrame, freq: str = "hour", keys: Sequence[str] = ("series",),
             ts: str = "ts", tick_id: str = "tick_id", price: str = "price") -> DataFrame:
    """OHLCV candles per key and period.

    open/close are the first/last tick by ``(ts, tick_id)`` (``min_by`` /
    ``max_by`` on a struct, so ties resolve the same way every run), volume is
    the sum of tick values in exact cents. All aggregates combine map-side, so
    a hot key costs one partial row per task before the shuffle.
    """
    order = F.struct(F.col(ts), F.col(tick_id))
    start = candle_start(ts, freq)
    if isinstance(ticks.schema[ts].dataType, T.TimestampNTZType):
        start = start.cast("timestamp_ntz")       # date_trunc returns a zoned timestamp
    return (ticks
            .groupBy(*keys, start.alias("open_time"))
            .agg(F.min_by(price, order).alias("open"),
                 F.max(price).alias("high"),
                 F.min(price).alias("low"),
                 F.max_by(price, order).alias("close"),
                 (F.sum(cents(price)) / F.lit(100.0)).alias("volume")))


def candle_shape(ticks: DataFrame, keys: Sequence[str] = ("series",),
                 order: Sequence[str] = ("ts", "tick_id"), price: str = "price",
                 spread: float = 0.0, block_rows: int = P.DEFAULT_BLOCK_ROWS,
                 bucket_unit: str = "auto") -> DataFrame:
    """Candle shape from a price path: open = previous price (the first row
    opens at its own price), high = max(open, close) + spread,
    low = min(open, close) - spread, all rounded to cents.

    The previous price is a lag over halo blocks, so a long series is not one task.
    """
    x = P.halo_blocks(P.with_position(ticks, keys, order, bucket_unit=bucket_unit,
                                      with_length=False), keys, block_rows, back=1)
    w = P.block_window(keys)
    prev = F.lag(price, 1).over(w)
    x = P.home_rows(x.withColumn("_prev", prev), block_rows)
    o = F.coalesce(F.col("_prev"), F.col(price))
    return x.select(
        *keys, *order,
        F.round(o, 2).alias("open"),
        F.round(F.greatest(o, F.col(price)) + spread, 2).alias("high"),
        F.round(F.least(o, F.col(price)) - spread, 2).alias("low"),
        F.round(F.col(price), 2).alias("close"),
    )


def growth_index(df: DataFrame, keys: Sequence[str] = ("series",),
                 order: Sequence[str] = ("open_time",), close: str = "close",
                 base: float = 100.0, digits: int = 4,
                 block_rows: int = P.DEFAULT_BLOCK_ROWS, bucket_unit: str = "auto",
                 fan: int = FAN) -> DataFrame:
    """Compounded growth ``base * exp(sum of log returns so far)`` per series.

    The running sum is a block scan (local sums plus a carry of earlier block
    totals, added up by levels of ``fan``), so no window spans a whole series.
    """
    x = P.halo_blocks(P.with_position(df, keys, order, bucket_unit=bucket_unit,
                                      with_length=False), keys, block_rows, back=1)
    prev = F.lag(close, 1).over(P.block_window(keys))
    x = P.home_rows(x.withColumn("_lr", F.coalesce(F.ln(F.try_divide(F.col(close), prev)),
                                                     F.lit(0.0))), block_rows)
    x = running_sum(x, keys, "_lr", "_cum_lr", block_rows, fan)
    return x.select(*keys, *order, close,
                    F.round(F.lit(base) * F.exp(F.col("_cum_lr")), digits).alias("growth_index"))
