"""Text formatting of numbers without floating rounding ambiguity.

``format_number`` / ``format_string('%.2f')`` round the double's decimal
expansion and can disagree with other engines on values such as 12.345.
Here a number is first turned into an exact scaled integer (half away from
zero) and the digits are assembled as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_int(c: Column, decimals: int) -> Column:
    """round(c * 10^decimals) as bigint, halves away from zero."""
    return F.round(c * (10 ** decimals)).cast("bigint")


def fixed(c: Column, decimals: int, from_decimals: int | None = None) -> Column:
    """``c`` as text with exactly ``decimals`` digits after the point.

    When ``c`` is already rounded to ``from_decimals`` places, the value is
    first read as that exact integer and rounded half-up to ``decimals`` in
    integer arithmetic.
    """
    if from_decimals is not None and from_decimals > decimals:
        v = scaled_int(c, from_decimals)
        step = 10 ** (from_decimals - decimals)
        mag = F.abs(v)
        q = ((mag * 2 + step) - F.pmod(mag * 2 + step, F.lit(2 * step))) / (2 * step)
        iv = F.when(v < 0, -q.cast("bigint")).otherwise(q.cast("bigint"))
    else:
        iv = scaled_int(c, decimals)
    sign = F.when(iv < 0, F.lit("-")).otherwise(F.lit(""))
    mag = F.abs(iv)
    unit = 10 ** decimals
    whole = (mag / unit).cast("bigint").cast("string") if decimals else mag.cast("string")
    if decimals == 0:
        return F.concat(sign, whole)
    frac = F.lpad(F.pmod(mag, F.lit(unit)).cast("string"), decimals, "0")
    return F.when(c.isNotNull(), F.concat(sign, F.floor(mag / unit).cast("bigint").cast("string"),
                                          F.lit("."), frac))
