"""Row positions by sampled range partitions.

``positions.with_position`` numbers rows inside time buckets, so rows of one
instant always share a bucket. Here the buckets are the partitions of a range
exchange over (keys, order): their boundaries are sampled from the rows
themselves, on the tie-break columns too, so a series or an instant that holds
a large share of all rows spreads over many partitions of about equal size.
No time column is needed and no sizing pass.

1. One range exchange, sorted inside each partition; every row gets its
   partition and its place there (``monotonically_increasing_id`` after the
   sort). The rows are written once.
2. Per (series, partition): first place and row count, a small table with at
   most one row per series and one per partition. Its running total per series
   gives the rows before the partition. The total over a hot series runs over
   one row per partition.
3. Both meet again on (series, partition), which no series can make heavy.

Keys are compared as a struct, in which NULLs are equal, so the join stays a
plain equi-join. NULL order values come first. Rows that are equal in every
order column are numbered in an arbitrary order unless ``tiebreak`` is set,
which adds the row's own place in the input as the last order column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.positions import POS, SLEN
from tidemark.sources.sinks import stage

_PLACE_BITS = 33        # monotonically_increasing_id: partition above, place below


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
           tiebreak: bool = False) -> DataFrame:
    """``df`` range partitioned and sorted by (keys, order), written once, with
    ``_part`` (range partition, ascending) and ``_place`` (place inside it)."""
    by = [*map(F.col, keys), *_order(order)]
    if tiebreak:
        df = df.withColumn("_row", F.monotonically_increasing_id())
        by.append(F.col("_row"))
    if not by:
        raise ValueError("ranged needs keys or an order")
    at = F.monotonically_increasing_id()
    x = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", at)
    x = x.withColumn("_part", F.shiftright("_at", _PLACE_BITS)).withColumn(
        "_place", F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)).drop("_at", "_row")
    return stage(x, "ranged")


def with_range_position(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                        with_length: bool = True, tiebreak: bool = False) -> DataFrame:
    """Add ``_pos`` (0-based position in the series by ``order``) and ``_n``
    (rows of the series). ``keys`` may be empty: one position over all rows."""
    keys = list(keys)
    x = ranged(df, keys, order, tiebreak)
    key = F.struct(*[F.col(k) for k in keys], F.col("_part"))
    runs = x.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    series = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.sum("_rows").over(series.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(key.alias("_key"), "_first", F.coalesce(before, F.lit(0)).alias("_before"),
                       *([F.sum("_rows").over(series).alias(SLEN)] if with_length else []))
    out = x.withColumn("_key", key).join(runs, "_key")
    pos = (F.col("_before") + F.col("_place") - F.col("_first")).alias(POS)
    return out.select(*df.columns, pos, *([SLEN] if with_length else []))
