"""Bounded row-frame features: lags, log returns, moving averages, volatility.

The expressions take an *ordered* window spec and work the same over a plain
per-series window or over a halo block
(:func:`tidemark.operators.positions.block_window`); the block form is what
the plans use, the plain form is kept for comparison.

Frames are row counts, not time spans (reference semantics): a missing hour
stretches a "24-hour" frame.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, cents_mean, clip_zero, log_return

# Fixed values of the reference's feature table.
MA_PERIODS = (7, 24, 168)
LAGS = (1, 3, 6, 24)
VOLATILITY_PERIOD = 24
MAX_LOOKBACK = max(MA_PERIODS) - 1      # 167 earlier rows cover every frame and lag


def frame(w: Window, n: int) -> Window:
    """The last ``n`` rows up to and including the current one."""
    return w.rowsBetween(-(n - 1), 0)


CENTS = "_cents"   # integer cents of close, added once before the windows
# Running totals over the ordered window: non-null count, cent sum, square sum.
PREFIX = ("_p0", "_p1", "_p2")


def with_cents(df, close: str = "close"):
    """Add the integer-cent column the exact averages and deviations use."""
    return df.withColumn(CENTS, cents(close))


def with_prefix(df, w: Window):
    """Add running totals of the cents over ``w`` (needs ``_cents``).

    A frame of the last n rows is then ``total - lag(total, n)``: O(1) per
    row, where a sliding ``rowsBetween(-(n-1), 0)`` frame re-aggregates all n
    rows for every row (168 for ``ma_168``). Integer totals make the
    difference exact; cent totals stay far below 2^63 (a block of 4,096 rows
    at 10^9 cents is 4 * 10^12). Squares are added as decimals, which hold a
    block of prices up to 10^17 cents.
    """
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    c = F.col(CENTS)
    return df.select("*", F.count(c).over(run).alias(PREFIX[0]),
                     F.sum(c).over(run).alias(PREFIX[1]),
                     F.sum(_squared(c)).over(run).alias(PREFIX[2]))


def _last(w: Window, total: str, n: int) -> Column:
    """Sum of the last n rows from a running total."""
    return F.col(total) - F.coalesce(F.lag(total, n).over(w), F.lit(0))


def moving_average(w: Window, n: int, close: str = "close") -> Column:
    """round(avg(close), 2) over the last n rows, exact: cent sums rounded
    half-up in integer arithmetic. Partial frames at the start are kept.
    Needs the running totals (:func:`with_prefix`)."""
    return cents_mean(_last(w, PREFIX[1], n), _last(w, PREFIX[0], n))


def _squared(c: Column) -> Column:
    """Square of integer cents as a decimal: exact for prices far over 10^9."""
    return c.cast("decimal(18,0)") * c.cast("decimal(18,0)")


def _variance(k: Column, s1: Column, s2: Column) -> Column:
    """Sample variance from a count, an integer sum and a decimal square sum."""
    s1 = s1.cast("decimal(19,0)")
    top = (k.cast("decimal(10,0)") * s2 - s1 * s1).cast("double")
    return F.try_divide(top, (k * (k - 1)).cast("double"))


def rolling_std(w: Window, n: int, close: str = "close") -> Column:
    """round(sample stddev(close), 2) over the last n rows; NULL on one row.

    Computed from exact integer cent sums (n*S2 - S1^2) and one square root,
    so it does not depend on summation order. Needs the running totals
    (:func:`with_prefix`): a sliding frame would add n decimals for every row.
    """
    k, s1, s2 = (_last(w, total, n) for total in PREFIX)
    var_cents = _variance(k, s1, s2)
    return F.when(k > 1, F.round(F.sqrt(var_cents) / 100.0, 2))


def lag(w: Window, k: int, close: str = "close") -> Column:
    return F.lag(close, k).over(w)


def lead(w: Window, k: int, close: str = "close") -> Column:
    return F.lead(close, k).over(w)


def price_delta(w: Window, close: str = "close") -> Column:
    """First difference close - previous close (NULL on the first row)."""
    return F.col(close) - F.lag(close, 1).over(w)


def lag_with_fallback(w: Window, first_w: Window, k: int, close: str = "close") -> Column:
    """lag(close, k), or the oldest close in reach when history is shorter
    (the reference's one-row append rule for lag_24)."""
    return F.coalesce(F.lag(close, k).over(w), F.first(close).over(first_w))


FEATURE_WINDOW_COLUMNS = ["returns", *[f"ma_{n}" for n in MA_PERIODS],
                          f"volatility_{VOLATILITY_PERIOD}", *[f"lag_{k}" for k in LAGS]]


def add_feature_columns(df, w: Window, close: str = "close", delta: str | None = "_delta"):
    """Add the window columns of the feature table (and ``delta``) over ``w``.

    Needs the running totals (:func:`with_cents`, :func:`with_prefix`). Two steps: first the window functions alone (lags,
    frame sums and counts) as plain columns, then the exact rounding as a
    projection over those columns. Written inline, the rounding would repeat
    each lag subtree several times per expression.
    """
    step1 = [F.lag(close, k).over(w).alias(f"lag_{k}") for k in LAGS]
    for n in MA_PERIODS:
        step1.append(_last(w, PREFIX[1], n).alias(f"_s{n}"))
        step1.append(_last(w, PREFIX[0], n).alias(f"_k{n}"))
    step1 += [_last(w, total, VOLATILITY_PERIOD).alias(name)
              for total, name in zip(PREFIX, ("_vk", "_vs1", "_vs2"))]
    x = df.select("*", *step1)
    k, s1, s2 = F.col("_vk"), F.col("_vs1"), F.col("_vs2")
    var_cents = _variance(k, s1, s2)
    step2 = {
        "returns": log_return(F.col(close), F.col("lag_1")),
        **{f"ma_{n}": cents_mean(F.col(f"_s{n}"), F.col(f"_k{n}")) for n in MA_PERIODS},
        f"volatility_{VOLATILITY_PERIOD}": F.when(k > 1, F.round(F.sqrt(var_cents) / 100.0, 2)),
    }
    if delta:
        step2[delta] = F.col(close) - F.col("lag_1")
    x = x.select("*", *[v.alias(name) for name, v in step2.items()])
    tmp = [f"_s{n}" for n in MA_PERIODS] + [f"_k{n}" for n in MA_PERIODS] + ["_vk", "_vs1", "_vs2"]
    return x.drop(*tmp)


def feature_columns(w: Window, close: str = "close") -> dict[str, Column]:
    """The same window columns as single expressions (simple uses; the table
    builder uses :func:`add_feature_columns`)."""
    out = {"returns": log_return(F.col(close), F.lag(close, 1).over(w))}
    for n in MA_PERIODS:
        out[f"ma_{n}"] = moving_average(w, n, close)
    out[f"volatility_{VOLATILITY_PERIOD}"] = rolling_std(w, VOLATILITY_PERIOD, close)
    for k in LAGS:
        out[f"lag_{k}"] = lag(w, k, close)
    return out


def gain_loss(delta: Column) -> tuple[Column, Column]:
    """clip(delta, lower=0), clip(-delta, lower=0), NULL kept."""
    return clip_zero(delta), clip_zero(-delta)
