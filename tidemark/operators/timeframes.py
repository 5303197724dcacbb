"""Time frames: aggregates over a span of time instead of a count of rows.

A missing hour stretches a 24-row frame; a RANGE frame of 24 hours keeps its
length. A window over a whole series would put a hot series in one task, so
time is cut into blocks and each row also goes to the later blocks whose
frames reach back to it: ``span / block`` copies, rounded up, and one more. A
copy joins its block at the block's start; where the row's span ends inside a
block, one more copy takes it out again.

Inside a block the frame of an instant is then a running total: all that joined
up to it less all that left. A sliding frame would add up its rows anew for
each row, which grows with the square of the rows in one span; the totals are
integers and decimals, so the difference is exact.

The block is the caller's choice: as long as the span (three copies of a row at
most), or shorter where a series has very many rows in one span, at the price
of more copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, cents_mean

TBLK = "_tblk"
_SECOND = 1_000_000


def micros(time: str) -> Column:
    """Microseconds of a timestamp, exact."""
    return F.unix_micros(F.col(time).cast("timestamp"))


def time_halo(df: DataFrame, keys: Sequence[str], time: str, span_seconds: int,
              block_seconds: int | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``_tblk``, ``_us`` and ``_sign``: every row in its own block
    at its own instant, at the start of the later blocks that hold an instant
    less than or equal to the span after it (both 1), and in the last of them
    once more right after its span (-1), unless that is behind the block. Of
    the columns, copies keep the keys and ``carried``; ``_home`` is true for
    the row itself."""
    step, span = (block_seconds or span_seconds) * _SECOND, span_seconds * _SECOND
    us = F.col("_us")

    def block(at: Column) -> Column:
        return F.call_function("div", at - F.pmod(at, F.lit(step)), F.lit(step))

    def move(blk: Column, at: Column, sign: int, home: bool) -> Column:
        return F.struct(blk.alias("blk"), at.cast("bigint").alias("at"), F.lit(sign).alias("sign"), F.lit(home).alias("home"))

    x = df.withColumn("_us", micros(time))
    lo, hi, out = block(us), block(us + span), us + span + 1
    later = F.filter(F.transform(F.sequence(lo, hi), lambda b: move(b, b * step, 1, False)), lambda m: m["blk"] > lo)
    leaves = F.filter(F.array(move(hi, out, -1, False)), lambda m: m["at"] < (m["blk"] + 1) * step)
    moves = F.concat(F.array(move(lo, us, 1, True)), later, leaves)
    x = x.withColumn("_move", F.explode(moves))
    kept = [F.col(c) if c in (*keys, *carried) else F.when(F.col("_move.home"), F.col(c)).alias(c) for c in df.columns]
    return x.select(*kept, F.col("_move.at").alias("_us"), F.col("_move.sign").alias("_sign"),
                    F.col("_move.home").alias("_home"), F.col("_move.blk").alias(TBLK)).repartition(*keys, TBLK)


def time_window(keys: Sequence[str]) -> Window:
    """All that joined or left a block up to a row's instant."""
    return Window.partitionBy(*keys, TBLK).orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)


def home_times(df: DataFrame) -> DataFrame:
    """Only each row itself, in its own block."""
    return df.where("_home").drop(TBLK, "_us", "_sign", "_home")


def time_features(df: DataFrame, keys: Sequence[str], time: str, value: str, span_seconds: int,
                  mean: str, deviation: str, block_seconds: int | None = None) -> DataFrame:
    """Add ``mean`` (to the cent, exact) and ``deviation`` (sample standard
    deviation, two decimals, NULL on one row) of ``value`` over the span. Rows
    without a time have neither."""
    timed = df.where(F.col(time).isNotNull()).withColumn("_c", cents(value))
    x = time_halo(timed, keys, time, span_seconds, block_seconds, ["_c"])
    w = time_window(keys)
    square = F.col("_c").cast("decimal(18,0)") * F.col("_c").cast("decimal(18,0)")
    x = x.select("*", F.sum(F.when(F.col("_c").isNotNull(), F.col("_sign")).otherwise(0)).over(w).alias("_k"),
                 F.sum(F.col("_sign") * F.col("_c")).over(w).alias("_s"),
                 F.sum(F.when(F.col("_sign") < 0, -square).otherwise(square)).over(w).alias("_q"))
    x = home_times(x)
    k, s = F.col("_k"), F.col("_s").cast("decimal(19,0)")
    var = F.try_divide((k.cast("decimal(10,0)") * F.col("_q") - s * s).cast("double"), (k * (k - 1)).cast("double"))
    out = x.select(*df.columns, cents_mean(F.col("_s"), k).alias(mean),
                   F.when(k > 1, F.round(F.sqrt(var) / 100.0, 2)).alias(deviation))
    return out.unionByName(df.where(F.col(time).isNull()), allowMissingColumns=True)
