"""Row positions within a series and halo blocks.

A row-count window over a whole series (``Window.partitionBy(series)``) puts
every row of a series into one task; one hot series then decides the run time
and may not fit in memory. The operators here cut a series into bounded pieces:

``with_position``
    0-based position of each row in its series, without a window over the
    series. Rows are numbered inside (series, time bucket) groups, and each
    bucket gets an offset from a running sum over the small table of bucket
    counts. Counting is a map-side partial aggregate. The numbered rows are
    written once and read back, which loses their layout: where the offset
    table is over the broadcast limit, the join back shuffles the rows again.

``halo_blocks``
    Splits the positions into blocks of ``block_rows``. Rows near a block edge
    are also emitted to the neighbour blocks (``back`` rows of look-back and
    ``fwd`` rows of look-ahead), so every bounded row frame and lag/lead can
    be evaluated with ``Window.partitionBy(series, _blk).orderBy(_pos)`` and
    then restricted to the block's own rows with ``home_rows``.

NULL keys form a series of their own; NULL times sort first in their series.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POS = "_pos"     # position within the series, 0-based
SLEN = "_n"      # rows in the series
BKT = "_bkt"     # numbering bucket
BLK = "_blk"     # block the row is evaluated in

DEFAULT_BLOCK_ROWS = 4096

# Numbering buckets: the coarsest unit whose fullest (series, bucket) stays
# under TARGET_BUCKET_ROWS rows ("auto"), so a bucket is one bounded task and
# the per-series table of bucket counts stays small.
BUCKET_UNITS = ("day", "hour", "minute")
TARGET_BUCKET_ROWS = 2_000_000


def choose_bucket_unit(df: DataFrame, keys: Sequence[str], time: str,
                       target_rows: int = TARGET_BUCKET_ROWS) -> str:
    """Pick the numbering bucket from the data.

    One aggregation over (keys, time) only: rows per (key, minute), rolled up
    to hours and days on the small result; three scalars reach the driver.
    """
    t = F.col(time)
    per_min = df.groupBy(*keys, F.date_trunc("minute", t).alias("_m")).agg(
        F.count(F.lit(1)).alias("_n"))
    per_hour = per_min.groupBy(*keys, F.date_trunc("hour", "_m").alias("_h")).agg(
        F.sum("_n").alias("_n"), F.max("_n").alias("_max_min"))
    per_day = per_hour.groupBy(*keys, F.date_trunc("day", "_h").alias("_d")).agg(
        F.sum("_n").alias("_n"), F.max("_n").alias("_max_hour"),
        F.max("_max_min").alias("_max_min"))
    top = per_day.agg(F.max("_n"), F.max("_max_hour"), F.max("_max_min")).first()
    if top is None or top[0] is None:
        return "day"
    for unit, most in zip(BUCKET_UNITS, top):
        if most <= target_rows:
            return unit
    return "range"


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  bucket: Column | None = None, bucket_unit: str = "auto",
                  with_length: bool = True, prepare=None, materialize: bool = True) -> DataFrame:
    """Add ``_pos`` (0-based position in the series by ``order``) and ``_n``.

    ``bucket`` groups rows for numbering; by default the first order column
    truncated to ``bucket_unit`` (``"auto"``: :func:`choose_bucket_unit`;
    ``"range"``: sampled ranges of (keys, order), see ``ranges``). It
    must be monotone in ``order`` (a coarser copy of it), so buckets are
    contiguous runs of the series.

    ``prepare`` (optional) runs on the rows right after the (keys, bucket)
    exchange, e.g. a de-duplication partitioned by (keys, ``_bkt``, order), so
    it shares that shuffle. The numbered rows are written once (``materialize``)
    because they feed both the bucket counts and the final join; pass
    ``materialize=False`` when ``df`` is already a cheap scan.
    """
    from tidemark.sources.sinks import stage

    keys, order = list(keys), list(order)
    if bucket is None:
        if bucket_unit == "auto":
            bucket_unit = choose_bucket_unit(df, keys, order[0])
        if bucket_unit == "range":
            # Even a minute holds too many rows: buckets cut on the tie-break.
            from tidemark.operators.ranges import with_range_position

            rows = df if prepare is None else prepare(df.withColumn(BKT, F.lit(0))).drop(BKT)
            return with_range_position(rows, keys, order, with_length)
        bucket = F.date_trunc(bucket_unit, F.col(order[0]))
    x = df.withColumn(BKT, bucket).repartition(*keys, BKT)
    if prepare is not None:
        x = prepare(x)
    w = Window.partitionBy(*keys, BKT).orderBy(*order)
    x = x.select("*", (F.row_number().over(w) - 1).alias("_rn"),
                 F.count(F.lit(1)).over(Window.partitionBy(*keys, BKT)).alias("_bn"))
    if materialize:
        x = stage(x, "numbered")
    counts = x.groupBy(*keys, BKT).agg(F.max("_bn").alias("_bn"))
    by_key = Window.partitionBy(*keys).orderBy(BKT)
    offsets = counts.select(
        *keys, BKT,
        F.coalesce(F.sum("_bn").over(by_key.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        *([F.sum("_bn").over(Window.partitionBy(*keys)).alias(SLEN)] if with_length else []),
    )
    # Null-safe: rows with a NULL key are a series of their own, rows with a
    # NULL time come first in theirs; none is lost.
    by = [*keys, BKT]
    names = {c: f"_by{i}" for i, c in enumerate(by)}
    # Written, the offsets have a known size: they are broadcast where they are
    # small, and the rows are not shuffled once more.
    offsets = stage(offsets.select(*[F.col(c).alias(n) for c, n in names.items()],
                                   *[c for c in offsets.columns if c not in by]), "offsets")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
    out = x.join(offsets, same).withColumn(POS, F.col("_off") + F.col("_rn"))
    return out.drop("_rn", "_off", "_bn", BKT, *names.values())


def halo_blocks(df: DataFrame, keys: Sequence[str], block_rows: int = DEFAULT_BLOCK_ROWS,
                back: int = 0, fwd: int = 0) -> DataFrame:
    """Emit each positioned row to every block whose frames reach it.

    Block ``b`` owns positions ``[b*B, (b+1)*B)`` and needs ``back`` rows before
    and ``fwd`` rows after them. Duplication is ``(back + fwd) / B``.
    """
    if block_rows <= max(back, fwd):
        raise ValueError("block_rows must exceed the look-back and look-ahead")
    p = F.col(POS)
    lo = F.greatest(F.floor((p - fwd) / block_rows), F.lit(0)).cast("bigint")
    hi = F.floor((p + back) / block_rows).cast("bigint")
    out = df.withColumn(BLK, F.explode(F.sequence(lo, hi)))
    # The block exchange is explicit so that every consumer of the block
    # layout (windows, block-end aggregates, carry joins) shares it.
    return out.repartition(*keys, BLK)


def home_block(block_rows: int) -> Column:
    return F.floor(F.col(POS) / block_rows).cast("bigint")


def home_rows(df: DataFrame, block_rows: int) -> DataFrame:
    """Keep each row only in its own block (drop the halo copies)."""
    return df.filter(F.col(BLK) == home_block(block_rows))


def block_window(keys: Sequence[str]) -> Window:
    """Ordered window over one halo block."""
    return Window.partitionBy(*keys, BLK).orderBy(POS)
