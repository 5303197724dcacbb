"""Column expressions shared by the operators.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen. No Python runs per row.

Prices carry two decimals. Averages of two-decimal prices often land exactly
on a half cent, and floating sums in different orders then round to different
cents. Money columns are therefore summed as integer cents and rounded half-up
in integer arithmetic, which gives one exact answer on any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the reference uses.
RSI_PERIOD = 14          # RSI look-back; exponential mean with com = period - 1
RSI_ZERO_LOSS = 1e-10    # stands in for a zero average loss before dividing
RSI_OVERBOUGHT = 70.0
RSI_OVERSOLD = 30.0


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def q(name: str) -> str:
    """A column name quoted for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def sql_cols(exprs: dict[str, str]) -> list[Column]:
    """Columns from SQL expression text, one per output name.

    Long generated lists (cross products, dot products, per-input scaling)
    are written this way: each column is one parse on the JVM instead of a
    chain of Python-side Column calls, and the plan is the same.
    """
    return [F.expr(f"{e} AS {q(n)}") for n, e in exprs.items()]


def cents(c: str | Column) -> Column:
    """A two-decimal price as exact integer cents (bigint)."""
    return F.round(col_(c) * 100).cast("bigint")


def half_up_div(num: Column, den: Column) -> Column:
    """round(num / den), halves away from zero (SQL ROUND), for integers
    num and den > 0, exactly.

    |num| -> (2|num| + den) div (2 den) in integer division, so no floating
    step can move a result across a half; the sign is put back after."""
    quot = F.call_function("div", F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -quot).otherwise(quot)


def cents_mean(sum_cents: Column, n: Column) -> Column:
    """Mean of prices given their cent sum and count, rounded half-up to a cent,
    returned as a double with two decimals."""
    return F.when(n > 0, half_up_div(sum_cents, n) / F.lit(100.0))


def micros_mean(sum_micros: Column, n: Column, scale: float = 1e6) -> Column:
    """Mean of values held as exact integers at ``scale`` (e.g. micro-units)."""
    return F.when(n > 0, half_up_div(sum_micros, n) / F.lit(scale))


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of raising on a zero divisor (ANSI)."""
    return F.try_divide(num, den)


def clip_zero(c: Column) -> Column:
    """max(c, 0) that keeps NULL as NULL (``greatest(NULL, 0)`` is 0)."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def log_return(close: Column, prev_close: Column, digits: int = 6) -> Column:
    """round(ln(close / prev_close), digits); NULL without a previous close."""
    return F.round(F.ln(safe_div(close, prev_close)), digits)


def time_parts(t: str | Column) -> dict[str, Column]:
    """Calendar fields of the feature table: hour, day_of_week (1=Sun..7=Sat), month."""
    t = col_(t)
    return {
        "hour": F.hour(t).cast("int"),
        "day_of_week": F.dayofweek(t).cast("int"),
        "month": F.month(t).cast("int"),
    }


def price_range(high: str | Column = "high", low: str | Column = "low") -> Column:
    return F.round(col_(high) - col_(low), 2)


def is_valid_number(c: str | Column) -> Column:
    """Not NULL and not NaN (``NaN > 0`` is true in Spark, so test it)."""
    c = col_(c)
    return c.isNotNull() & ~F.isnan(c)
