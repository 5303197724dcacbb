"""Late rows repaired from stored carries: replay from their time until the
state meets the stored one.

A stored series is cut into parts by time (days, months). Each part has one
carry: its row count and the RSI means after its last row. A late row changes
the windows of the next 167 rows, and the means after it by an amount that
decays with every row, so:

1. Parts with late rows start a replay; it runs over the following parts until
   ``horizon`` rows have passed the last late one. Replays that touch are one
   segment; far-apart ones are segments of their own.
2. A segment reads its parts and the earlier ones that hold its 167 rows of
   look-back, takes its means from the carry before it, and its positions from
   the carries' row counts. Nothing else of the series is read.
3. The means at a segment's end must meet the stored carry there. Where one does
   not, the horizon is doubled and the replay done again.

Rows behind the stored end are the same case (a segment that ends with the
series), and a series without carries is built whole, so one call takes any
mixture of late, new and re-delivered rows. The plan over the carries is one
window per series over its parts, not its rows. NULL times sort first and lie
in a part of their own; NULL keys are a series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import positions as P
from tidemark.operators.clean import clean_candles
from tidemark.operators.windows import CENTS, MAX_LOOKBACK, PREFIX, add_feature_columns, with_cents, with_prefix
from tidemark.plans.features import TRIM, feature_projection, trim_rows, windowed, with_rsi
from tidemark.sources.sinks import stage

PART = "row_part"
#: 13/14 to the 640th is 3e-21: below the precision of the means themselves.
HORIZON = 640
TOLERANCE = 1e-12


def part_of(time: str, unit: str) -> Column:
    """The part a time lies in; NULL times have the first part of all."""
    return F.coalesce(F.to_date(F.date_trunc(unit, F.col(time))), F.lit("0001-01-01").cast("date"))


def key_of(keys: Sequence[str]) -> Column:
    """The key columns as one struct, in which NULLs are equal."""
    return F.struct(*[F.col(k) for k in keys])


def in_parts(stored: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows of ``stored`` in the parts named in ``scope``. The short list of
    parts is written once, so it is broadcast and only its partitions are
    read; the comparison holds for every part and lets Spark prune by it."""
    parts = stage(scope.select(PART).distinct(), "parts").where(F.col(PART) >= F.lit("0001-01-01").cast("date"))
    return stored.join(parts, PART, "left_semi").select(*stored.columns)


def carries_of(x: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per (series, part): rows and the means after the last of them."""
    last = F.max_by(F.struct(F.col("_avg_gain").alias("avg_gain"), F.col("_avg_loss").alias("avg_loss")), P.POS)
    return (x.groupBy(*keys, PART).agg(F.count(F.lit(1)).alias("n"), last.alias("_s"))
             .select(*keys, PART, "n", "_s.avg_gain", "_s.avg_loss"))


@dataclass
class Built:
    candles: DataFrame       # cleaned candles (of a repair: those that were taken up)
    features: DataFrame      # feature rows (of a repair: all of the replayed parts)
    carries: DataFrame       # carries of the parts built
    replayed: DataFrame      # (keys, part) whose stored features and carries these replace


def build(candles: DataFrame, keys: Sequence[str], order: Sequence[str], unit: str = "day",
          block_rows: int = P.DEFAULT_BLOCK_ROWS) -> Built:
    """The whole table with its carries."""
    keys, order = list(keys), list(order)
    x = with_rsi(windowed(candles, keys, order, True, block_rows), keys, "_delta", TRIM, block_rows, keep_means=True,
                 spent=["_delta"])
    # The scan of the means has written the rows: the tables are read from there.
    x = x.withColumn(PART, part_of(order[0], unit))
    return _built(x.select(*candles.columns, PART), x, keys, order, unit)


def _built(candles: DataFrame, x: DataFrame, keys: list[str], order: list[str], unit: str) -> Built:
    features = feature_projection(trim_rows(x), keys, order).withColumn(PART, part_of("open_time", unit))
    carries = stage(carries_of(x, keys), "late-carries")
    return Built(candles, features, carries, carries.select(*keys, PART))


def plan_segments(carries: DataFrame, fresh: DataFrame, keys: Sequence[str], horizon: int) -> DataFrame:
    """One row per (series, part, segment) to read: ``_replay`` (else look-back),
    ``_start`` (position of the part's first row after the repair), the carried
    means before it and the stored ones after it; ``_meet`` where a segment
    ends before the series does."""
    keys = list(keys)
    late = fresh.groupBy(*keys, PART).agg(F.count(F.lit(1)).alias("_late"))
    p = (carries.select(*keys, PART, "n", "avg_gain", "avg_loss")
         .unionByName(late, allowMissingColumns=True)
         .groupBy(*keys, PART).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                                   F.coalesce(F.sum("_late"), F.lit(0)).alias("_late"),
                                   F.max("avg_gain").alias("avg_gain"), F.max("avg_loss").alias("avg_loss")))
    w = Window.partitionBy(*keys).orderBy(PART)
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("_end", F.sum(F.col("n") + F.col("_late")).over(to_here))
    p = p.withColumn("_start", F.col("_end") - F.col("n") - F.col("_late"))
    p = p.withColumn("_hot", F.last(F.when(F.col("_late") > 0, F.col("_end")), ignorenulls=True).over(to_here))
    p = p.withColumn("_replay", F.coalesce(F.col("_start") - F.col("_hot") < horizon, F.lit(False)))
    p = p.withColumn("_first", F.col("_replay") & ~F.lag("_replay", 1, False).over(w))
    p = p.withColumn("_seg", F.sum(F.col("_first").cast("int")).over(to_here))
    after = w.rowsBetween(1, Window.unboundedFollowing)
    p = p.withColumn("_next", F.first(F.when(F.col("_first"), F.col("_start")), ignorenulls=True).over(after))
    p = p.withColumn("_sg", F.when(F.col("_first"), F.lag("avg_gain").over(w)))
    p = p.withColumn("_sl", F.when(F.col("_first"), F.lag("avg_loss").over(w)))
    p = p.withColumn("_meet", F.col("_replay") & ~F.lead("_replay", 1, True).over(w))
    own = F.when(F.col("_replay"), F.struct(F.col("_seg").alias("seg"), F.lit(True).alias("replay")))
    ahead = F.when(F.col("_end") > F.col("_next") - MAX_LOOKBACK,
                   F.struct((F.col("_seg") + 1).alias("seg"), F.lit(False).alias("replay")))
    p = p.withColumn("_role", F.explode(F.array_compact(F.array(own, ahead))))
    return p.select(*keys, PART, F.col("_role.seg").alias("_seg"), F.col("_role.replay").alias("_replay"),
                    "_start", "_first", "_sg", "_sl", "_meet", "avg_gain", "avg_loss")


def _replay(rows: DataFrame, parts: DataFrame, keys: list[str], order: list[str], block_rows: int) -> DataFrame:
    """Feature columns and means of the replayed parts' rows."""
    segs = parts.groupBy(*keys, "_seg").agg(
        F.min("_start").alias("_base"), F.min(F.when(F.col("_replay"), F.col("_start"))).alias("_from"),
        F.max(F.when(F.col("_replay"), F.col("_sg"))).alias("_sg"),
        F.max(F.when(F.col("_replay"), F.col("_sl"))).alias("_sl"))
    part_key = key_of([*keys, "_seg"]).alias("_key")
    roles = parts.select(key_of(keys).alias("_key"), PART, "_seg")
    x = rows.withColumn("_key", key_of(keys)).join(roles, ["_key", PART]).drop("_key")
    ks = [*keys, "_seg"]
    x = P.with_position(x, ks, order, with_length=False)
    x = x.withColumn("_key", part_key).join(segs.select(part_key, "_base", "_from", "_sg", "_sl"), "_key").drop("_key")
    x = x.withColumn(P.POS, F.col(P.POS) + F.col("_base"))
    w = P.block_window(ks)
    x = with_prefix(with_cents(P.halo_blocks(x, ks, block_rows, back=MAX_LOOKBACK)), w)
    x = P.home_rows(add_feature_columns(x, w, delta="_delta"), block_rows).drop(CENTS, *PREFIX)
    start = F.when(F.col("_sg").isNotNull(), F.col("_from") - 1).otherwise(F.lit(TRIM))
    x = with_rsi(x, ks, "_delta", start, block_rows, keep_means=True, seed_gain=F.col("_sg"), seed_loss=F.col("_sl"),
                 spent=["_delta"])
    return x.where(F.col(P.POS) >= F.col("_from")).drop("_base", "_from", "_sg", "_sl")


def _unmet(parts: DataFrame, carries: DataFrame, keys: list[str]) -> DataFrame:
    """Segment ends whose replayed means differ from the stored ones."""
    ends = parts.where("_meet AND _replay").select(key_of([*keys, PART]).alias("_key"), F.col("avg_gain").alias("_g"),
                                                   F.col("avg_loss").alias("_l"))
    both = ends.join(carries.withColumn("_key", key_of([*keys, PART])), "_key")
    near = [F.col(a).eqNullSafe(F.col(b)) | F.coalesce(F.abs(F.col(a) - F.col(b)) <= TOLERANCE * F.abs(F.col(b)), F.lit(False))
            for a, b in (("avg_gain", "_g"), ("avg_loss", "_l"))]
    return both.where(~(near[0] & near[1]))


def repair(stored: DataFrame, carries: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
           unit: str = "day", horizon: int = HORIZON, block_rows: int = P.DEFAULT_BLOCK_ROWS) -> Built:
    """Take up ``batch`` (late, new and re-delivered candles in any mixture).

    ``stored`` are the cleaned candles partitioned by ``row_part``, ``carries``
    their carries. Returns what replaces the stored features and carries of the
    replayed parts."""
    keys, order = list(keys), list(order)
    columns = [c for c in stored.columns if c != PART]
    batch = stage(clean_candles(batch.select(*columns), keys, order).withColumn(PART, part_of(order[0], unit)), "late-batch")
    at = key_of([*keys, *order]).alias("_at")
    held = in_parts(stored, batch).select(at, PART)
    fresh = stage(batch.withColumn("_at", at).join(held, ["_at", PART], "left_anti").select(*columns, PART), "late-new")
    while True:
        parts = stage(plan_segments(carries, fresh, keys, horizon), "late-parts")
        rows = in_parts(stored, parts).select(*columns, PART).unionByName(fresh)
        x = _replay(rows, parts, keys, order, block_rows)       # written by the scan of the means
        done = _built(fresh, x, keys, order, unit)
        if _unmet(parts, done.carries, keys).isEmpty():
            return done
        horizon *= 2
