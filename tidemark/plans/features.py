"""The feature table (silver): 20 reference columns per series.

Clean -> positions -> halo blocks -> all bounded frames and lags in one
Window node -> trim -> RSI as a block scan on the same blocks. The numbered
rows and the block scan are written once each while the plan is built. Data
moves in two full shuffles (numbering buckets, then blocks) while the tables
of bucket offsets and block carries can be broadcast; beyond that limit each
of their joins shuffles the rows once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (RSI_PERIOD, RSI_ZERO_LOSS, price_range, safe_div,
                                        time_parts)
from tidemark.operators import positions as P
from tidemark.operators.clean import clean_candles
from tidemark.operators.scan import ewm
from tidemark.operators.windows import (CENTS, LAGS, MAX_LOOKBACK, PREFIX, add_feature_columns,
                                        gain_loss, price_delta, with_cents, with_prefix)

# Rows needed before the first feature row: lag_24 must exist.
TRIM = max(LAGS)

FEATURE_COLUMNS = [
    "open_time", "open", "high", "low", "close", "volume",
    "hour", "day_of_week", "month", "price_range", "returns",
    "ma_7", "ma_24", "ma_168", "volatility_24",
    "lag_1", "lag_3", "lag_6", "lag_24", "rsi_14",
]

# The 19 model inputs (5 OHLCV + 14 engineered), in the reference's order.
MODEL_INPUTS = [
    "close", "open", "high", "low", "volume",
    "returns", "ma_7", "ma_24", "ma_168",
    "volatility_24", "rsi_14",
    "lag_1", "lag_3", "lag_6", "lag_24",
    "hour", "day_of_week", "month", "price_range",
]


def rsi_from_means(avg_gain, avg_loss, digits: int = 2):
    """round(100 - 100 / (1 + gain / loss), 2), a zero loss replaced by 1e-10."""
    loss = F.when(avg_loss == 0, F.lit(RSI_ZERO_LOSS)).otherwise(avg_loss)
    rs = safe_div(avg_gain, loss)
    return F.round(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs), digits)


def with_rsi(x: DataFrame, keys: Sequence[str], delta: str, start, block_rows: int,
             out: str = "rsi_14", period: int = RSI_PERIOD, keep_means: bool = False,
             seed_gain=None, seed_loss=None, spent: Sequence[str] = ()) -> DataFrame:
    """RSI over home rows of a halo-block frame that carry ``delta``.

    ``start`` (int or Column) is the first position of the RSI's series; its
    delta does not count (the series has no earlier row), the next one seeds
    the means. With ``seed_gain``/``seed_loss`` (Columns, NULL where absent)
    the means instead start *at* ``start`` from those carried values.
    ``keep_means`` keeps ``_avg_gain``/``_avg_loss`` for a state table. Columns
    in ``spent`` are not needed after the means and not written with the rows.
    """
    gain, loss = gain_loss(F.col(delta))
    start_c = F.col(start) if isinstance(start, str) else (
        F.lit(start) if isinstance(start, int) else start)
    seed = start_c + 1
    if seed_gain is not None:
        carried = seed_gain.isNotNull()
        at_start = F.col(P.POS) == start_c
        gain = F.when(carried & at_start, seed_gain).otherwise(gain)
        loss = F.when(carried & at_start, seed_loss).otherwise(loss)
        seed = F.when(carried, start_c).otherwise(seed)
    x = x.withColumn("_gain", gain).withColumn("_loss", loss).withColumn("_seed", seed)
    x = ewm(x, keys, {"_avg_gain": "_gain", "_avg_loss": "_loss"}, com=period - 1,
            seed_pos=F.col("_seed"), block_rows=block_rows, spent=["_gain", "_loss", *spent])
    x = x.withColumn(out, rsi_from_means(F.col("_avg_gain"), F.col("_avg_loss")))
    drop = ["_seed"] + ([] if keep_means else ["_avg_gain", "_avg_loss"])
    return x.drop(*drop)


def windowed(candles: DataFrame, keys: Sequence[str], order: Sequence[str],
             clean: bool = True, block_rows: int = P.DEFAULT_BLOCK_ROWS,
             bucket_unit: str = "auto") -> DataFrame:
    """Home rows with ``_pos``, ``_blk``, every bounded window column of the
    feature table and ``_delta`` (close - previous close); nothing trimmed.

    Cleaning de-duplicates on (keys, order) and drops invalid prices."""
    keys, order = list(keys), list(order)
    # Cleaning runs inside the numbering exchange: de-duplication is
    # partitioned by (keys, bucket, order), which that exchange already gives.
    prep = (lambda x: clean_candles(x, [*keys, P.BKT], order)) if clean else None
    x = P.with_position(candles, keys, order, bucket_unit=bucket_unit, with_length=False,
                        prepare=prep)
    w = P.block_window(keys)
    x = with_prefix(with_cents(P.halo_blocks(x, keys, block_rows, back=MAX_LOOKBACK)), w)
    x = add_feature_columns(x, w, delta="_delta")
    return P.home_rows(x, block_rows).drop(CENTS, *PREFIX)


def build_features(candles: DataFrame, keys: Sequence[str] = ("series",),
                   order: Sequence[str] = ("open_time",), clean: bool = True,
                   block_rows: int = P.DEFAULT_BLOCK_ROWS, bucket_unit: str = "auto",
                   trim: bool = True, keep_position: bool = False) -> DataFrame:
    """Candles -> the feature table, per series.

    ``order`` is the time column plus any tie-break (ticks read as candles use
    ``("open_time", "tick_id")``). With ``trim`` the first 24 rows of a series
    are dropped and RSI is seeded after the trim, as in the reference's batch
    run; without it every row is kept and RSI starts at the first row.
    """
    keys, order = list(keys), list(order)
    time = order[0]
    x = windowed(candles, keys, order, clean, block_rows, bucket_unit)
    x = with_rsi(x, keys, "_delta", TRIM if trim else 0, block_rows)
    if trim:
        x = trim_rows(x)
    return feature_projection(x, keys, order, keep_position)


def trim_rows(x: DataFrame) -> DataFrame:
    """Rows with a full 24-row history (the reference's not-null filters)."""
    return x.filter((F.col(P.POS) >= TRIM) & F.col("lag_24").isNotNull()
                    & F.col("returns").isNotNull() & F.col("volatility_24").isNotNull())


def feature_projection(x: DataFrame, keys: Sequence[str], order: Sequence[str],
                       keep_position: bool = False) -> DataFrame:
    """Keys, extra order columns, then the 20 feature columns in order."""
    keys, order = list(keys), list(order)
    time = order[0]
    parts = time_parts(time)
    out = x.select(
        *keys, *[c for c in order if c != time and c not in FEATURE_COLUMNS],
        F.col(time).alias("open_time") if time != "open_time" else F.col(time),
        "open", "high", "low", "close", "volume",
        parts["hour"].alias("hour"), parts["day_of_week"].alias("day_of_week"),
        parts["month"].alias("month"), price_range().alias("price_range"),
        *FEATURE_COLUMNS[10:],
        *([P.POS] if keep_position else []),
    )
    return out
