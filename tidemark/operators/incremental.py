"""Incremental maintenance of the feature table.

The reference appends one candle by pulling the last 168 raw rows to the
driver and re-deriving every feature by hand. Here the batch feature code is
re-used on a bounded slice:

1. ``new_only``      new rows anti-joined against the stored keys (a
                     re-delivered candle is dropped, so reruns are safe).
2. history           the last 167 stored rows per series (``row_number``
                     with a partial WindowGroupLimit before the shuffle).
3. windows           the same block windows as the batch plan over
                     history + new rows, positioned at their absolute place in
                     the series (offset from the state table).
4. RSI               continued from the carried state (last position, close,
                     average gain and loss) instead of re-seeding, so it equals
                     the full rebuild.
5. state             the last row per series after the append.

Late data: new rows must be later than the stored rows of their series;
candles inside the stored history are handed back as ``late``, and ``rebuild``
builds their series anew with them in place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import positions as P
from tidemark.operators.clean import clean_candles
from tidemark.operators.windows import (CENTS, MAX_LOOKBACK, PREFIX, add_feature_columns,
                                        price_delta, with_cents, with_prefix)
from tidemark.plans.dashboard import last_rows
from tidemark.plans.features import TRIM, feature_projection, trim_rows, windowed, with_rsi
from tidemark.sources.sinks import stage

STATE_COLUMNS = ["last_pos", "last_time", "last_close", "avg_gain", "avg_loss"]


@dataclass
class AppendResult:
    features: DataFrame      # feature rows of the appended candles
    state: DataFrame         # state per series after the append
    appended: DataFrame      # the candles that were appended (cleaned, new only)
    late: DataFrame          # new candles inside the stored history: not appended, see rebuild


def new_only(new: DataFrame, existing: DataFrame, keys: Sequence[str],
             order: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose (keys, order) are not stored yet (left anti join).

    A stored table bucketed by (keys, order) (:func:`sinks.write_bucketed`) is
    read where it lies: only the new rows are dealt out to its buckets.
    """
    k = [*keys, *order]
    return new.join(existing.select(*k), k, "left_anti")


def late_rows(new: DataFrame, state: DataFrame, keys: Sequence[str],
              time: str = "open_time") -> DataFrame:
    """New rows not after the newest stored time of their series."""
    return (new.join(state.select(*keys, "last_time"), list(keys))
               .filter(F.col(time) <= F.col("last_time")).drop("last_time"))


def _state_of(x: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    last = F.max_by(F.struct(F.col(P.POS).alias("last_pos"), F.col(time).alias("last_time"),
                             F.col("close").alias("last_close"),
                             F.col("_avg_gain").alias("avg_gain"),
                             F.col("_avg_loss").alias("avg_loss")), F.col(P.POS))
    return x.groupBy(*keys).agg(last.alias("_s")).select(*keys, "_s.*")


def feature_state(candles: DataFrame, keys: Sequence[str] = ("series",),
                  order: Sequence[str] = ("open_time",), clean: bool = True,
                  block_rows: int = P.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """State per series after a full build: last position, time, close and
    the RSI means (NULL while the series is too short to have an RSI)."""
    x = windowed(candles, keys, order, clean, block_rows)
    x = with_rsi(x, keys, "_delta", TRIM, block_rows, keep_means=True)
    return _state_of(x, keys, order[0])


def append_candles(existing: DataFrame, new: DataFrame, state: DataFrame,
                   keys: Sequence[str] = ("series",), order: Sequence[str] = ("open_time",),
                   clean: bool = True, block_rows: int = P.DEFAULT_BLOCK_ROWS) -> AppendResult:
    """Feature rows for candles appended after ``existing``.

    ``existing`` is the stored raw table, or just its last 167 rows per series
    (:func:`history_tail`); ``state`` the table from :func:`feature_state` or a
    previous append. Work grows with the new rows plus at most 167 history rows
    per touched series.
    """
    keys, order = list(keys), list(order)
    time = order[0]
    # Written once each: the new rows, and the history slice below. So ``new``
    # is evaluated once and ``existing`` twice (its keys, its last rows).
    fresh = stage(new_only(clean_candles(new, keys, order) if clean else new, existing, keys, order),
                  "append-new")
    late = late_rows(fresh, state, keys, time)
    # Only rows after the newest stored one extend a series; older ones are
    # late (see late_rows) and need a rebuild from their time on.
    fresh = (fresh.join(state.select(*keys, F.col("last_time").alias("_lt")), keys, "left")
                  .filter(F.col("_lt").isNull() | (F.col(time) > F.col("_lt"))).drop("_lt"))
    touched = fresh.select(*keys).distinct()
    hist = stage(last_rows(existing.join(touched, keys, "left_semi"), MAX_LOOKBACK, keys, order),
                 "append-history")
    cols = hist.columns
    both = (hist.withColumn("_new", F.lit(False))
                .unionByName(fresh.select(*cols).withColumn("_new", F.lit(True))))

    # Absolute positions: stored rows of the series minus the history slice.
    n_hist = hist.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nh"))
    offs = (state.select(*keys, "last_pos", "avg_gain", "avg_loss")
                 .join(n_hist, keys, "full")
                 .select(*keys,
                         (F.coalesce(F.col("last_pos") + 1, F.lit(0))
                          - F.coalesce(F.col("_nh"), F.lit(0))).alias("_off"),
                         F.col("last_pos"), F.col("avg_gain").alias("_sg"),
                         F.col("avg_loss").alias("_sl")))
    x = P.with_position(both, keys, order, with_length=False)
    x = x.join(offs, keys, "left").withColumn(
        P.POS, F.col(P.POS) + F.coalesce(F.col("_off"), F.lit(0)))
    w = P.block_window(keys)
    x = with_prefix(with_cents(P.halo_blocks(x, keys, block_rows, back=MAX_LOOKBACK)), w)
    x = add_feature_columns(x, w, delta="_delta")
    x = P.home_rows(x, block_rows).drop(CENTS, *PREFIX)
    # With a carried state the means continue from the last stored row;
    # otherwise the series is short and fully present, and RSI starts at TRIM.
    start = F.when(F.col("_sg").isNotNull(), F.col("last_pos")).otherwise(F.lit(TRIM))
    x = with_rsi(x, keys, "_delta", start, block_rows, keep_means=True,
                 seed_gain=F.col("_sg"), seed_loss=F.col("_sl"))
    touched_state = _state_of(x, keys, time)
    new_state = touched_state.unionByName(
        state.join(touched_state.select(*keys), keys, "left_anti"))
    out = trim_rows(x.filter(F.col("_new")))
    return AppendResult(feature_projection(out, keys, order), new_state, fresh, late)


def rebuild(existing: DataFrame, late: DataFrame, keys: Sequence[str] = ("series",),
            order: Sequence[str] = ("open_time",), clean: bool = True,
            block_rows: int = P.DEFAULT_BLOCK_ROWS) -> AppendResult:
    """Features and state of the series that have late rows, from their whole
    history with the late rows in place (RSI runs through every later row, so
    a late candle changes all of them). ``existing`` is the whole raw table."""
    keys, order = list(keys), list(order)
    touched = late.select(*keys).distinct()
    late = new_only(late, existing, keys, order)
    whole = existing.join(touched, keys, "left_semi").unionByName(late.select(*existing.columns))
    x = with_rsi(windowed(whole, keys, order, clean, block_rows), keys, "_delta", TRIM, block_rows,
                 keep_means=True)
    return AppendResult(feature_projection(trim_rows(x), keys, order), _state_of(x, keys, order[0]),
                        late, late.limit(0))


def history_tail(existing: DataFrame, keys: Sequence[str] = ("series",),
                 order: Sequence[str] = ("open_time",)) -> DataFrame:
    """The last 167 rows per series: all an append needs from the past."""
    return last_rows(existing, MAX_LOOKBACK, list(keys), list(order))
