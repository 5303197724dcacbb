"""Prefix scans over a series without a window that spans the series.

Both scans take a frame of *home rows* laid out by
:func:`tidemark.operators.positions.halo_blocks` (columns ``_pos`` and
``_blk``), so the work inside a block is one ordered window over at most
``block_rows`` rows, and what crosses block edges is one small row per block.

``running_sum``  local cumulative sum + sum of all earlier block totals, which
                 are added up by levels (``carried_sums``).

``ewm_gaps``     exponential mean over columns with NULLs, a scan of composable
                 runs by levels (``scan_levels``).

``ewm``          exponential mean ``y0 = x0``, ``y = (1-a) y' + a x``
                 (``a = 1/(1+com)``, the recursive / non-adjusted form).
                 Inside a block: ``L(p) = d^(p-s) * sum(w(q) x(q) d^-(q-s))``
                 with ``d = 1-a`` and ``s`` the block start; the carry into a
                 block folds the preceding block ends with ``d^B`` per block.
                 ``d^(B*m)`` underflows to zero after ``m`` blocks, so ``m``
                 block ends make the carry exact in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.positions import BLK, POS
from tidemark.sources.sinks import stage


FAN = 1024          # rows of one level that one task adds up for the next


def _last(df: DataFrame, at: str) -> int:
    """The highest place in ``at``: the one number that sets the levels."""
    top = df.agg(F.max(at)).first()[0]
    return -1 if top is None else int(top)


def carried_sums(totals: DataFrame, keys: Sequence[str], at: str, value: str, out: str,
                 fan: int = FAN, last: int | None = None) -> DataFrame:
    """``totals`` (one row per series and place ``at``) with ``out`` = the sum
    of ``value`` over the earlier places of the series.

    By levels: ``fan`` places are added up where they lie, their sums are
    carried the same way one level up, and come back by a join on (series,
    group). No window holds more than ``fan`` rows, however long a series is;
    the depth is the logarithm of its length. Keys are compared as a struct,
    in which NULLs are equal.
    """
    keys = list(keys)
    last = _last(totals, at) if last is None else last
    g, group = f"{at}_up", F.floor(F.col(at) / fan).cast("bigint")
    w = Window.partitionBy(*keys, g).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    x = totals.withColumn(g, group).withColumn("_in", F.coalesce(F.sum(value).over(w), zero))
    if last < fan:
        return x.withColumn(out, F.col("_in")).drop(g, "_in")
    up = totals.groupBy(*keys, group.alias(g)).agg(F.sum(value).alias("_v"))
    up = carried_sums(up, keys, g, "_v", f"{g}_before", fan, last // fan)
    key = F.struct(*[F.col(k) for k in keys], F.col(g)).alias("_key")
    x = x.withColumn("_key", key).join(up.select(key, f"{g}_before"), "_key")
    return x.withColumn(out, F.col(f"{g}_before") + F.col("_in")).drop(g, "_in", f"{g}_before", "_key")


def running_sum(df: DataFrame, keys: Sequence[str], value: str, out: str,
                block_rows: int, fan: int = FAN) -> DataFrame:
    """Add ``out`` = sum of ``value`` over all earlier rows of the series and
    the row itself (NULL values count as 0)."""
    keys = list(keys)
    v = F.coalesce(F.col(value), F.lit(0.0))
    w = Window.partitionBy(*keys, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    local = stage(df.withColumn("_v", v).withColumn("_local", F.sum("_v").over(w)), "runsum")
    totals = local.groupBy(*keys, BLK).agg(F.sum("_v").alias("_tot"))
    last = _last(local, BLK)
    if last >= fan:             # read by more than one level
        totals = stage(totals, "runsum-blocks")
    key = F.struct(*[F.col(k) for k in keys], F.col(BLK)).alias("_key")
    carry = carried_sums(totals, keys, BLK, "_tot", "_carry", fan, last).select(key, "_carry")
    return (local.withColumn("_key", key).join(carry, "_key")
                 .withColumn(out, F.col("_local") + F.col("_carry"))
                 .drop("_local", "_carry", "_v", "_key"))


def scan_levels(df: DataFrame, keys: Sequence[str], at: str, item: str,
                compose: Callable[[Column, Column], Column], out: str,
                fan: int = 64, last: int | None = None) -> DataFrame:
    """Add ``out`` = the composition of ``item`` over all rows of the series up
    to the row itself, for any associative ``compose(earlier, later)``.

    Places ``at`` are 0, 1, 2, ... in each series. ``fan`` rows are folded where
    they lie; the groups' compositions are scanned one level up and the one
    before a group is composed with its rows. Written once per level.
    """
    keys = list(keys)
    last = _last(df, at) if last is None else last
    g = f"{at}_up"
    w = Window.partitionBy(*keys, g).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    x = df.withColumn(g, F.floor(F.col(at) / fan).cast("bigint")).withColumn(
        "_list", F.collect_list(item).over(w))
    rest = F.slice("_list", F.lit(2), F.greatest(F.size("_list") - 1, F.lit(0)))
    x = x.withColumn("_in", F.aggregate(rest, F.element_at("_list", 1), compose)).drop("_list")
    if last < fan:
        return x.withColumn(out, F.col("_in")).drop(g, "_in")
    x = stage(x, "scan-level")
    up = x.groupBy(*keys, g).agg(F.max_by("_in", at).alias("_item"))
    up = scan_levels(up, keys, g, "_item", compose, f"{g}_to", fan, last // fan)
    key = [F.col(k) for k in keys]
    up = up.select(F.struct(*key, (F.col(g) + 1).alias("_at")).alias("_key"), f"{g}_to")
    x = x.withColumn("_key", F.struct(*key, F.col(g).alias("_at"))).join(up, "_key", "left")
    whole = F.when(F.col(f"{g}_to").isNull(), F.col("_in")).otherwise(compose(F.col(f"{g}_to"), F.col("_in")))
    return x.withColumn(out, whole).drop(g, "_in", "_key", f"{g}_to")


def ewm_gaps(df: DataFrame, keys: Sequence[str], inputs: dict[str, str], com: float,
             fan: int = 64) -> DataFrame:
    """Exponential means of columns with NULLs: a NULL row keeps the last mean
    and lets its weight decay, as ``ewm(com, adjust=False)`` does; rows before
    the first value have no mean. ``inputs`` maps output -> input column;
    ``df`` is positioned (``_pos``).

    The state is a mean ``y`` and its weight ``w``. A NULL turns w into d*w; a
    value x turns y into (d*w*y + a*x) / (d*w + a) and w into 1. A run of rows
    is kept as (seen, lead, x, scale, shift, weight): the first value x meets
    the mean with weight w*lead, its result m leaves as scale*m + shift, and
    the weight after the run is ``weight`` (without a value: w*lead). Two runs
    compose to a third of the same form, whatever comes before them, so runs
    are scanned by levels and gaps may cross any number of blocks.
    """
    if com < 0:
        raise ValueError("com must be at least 0")
    a = 1.0 / (1.0 + com)
    d = 1.0 - a
    one, zero = F.lit(1.0), F.lit(0.0)

    def run(seen, lead, x, scale, shift, weight):
        return F.struct(seen.alias("seen"), lead.alias("lead"), x.alias("x"), scale.alias("scale"),
                        shift.alias("shift"), weight.alias("weight"))

    def compose(p: Column, q: Column) -> Column:
        w = p["weight"] * q["lead"]
        held = F.when(w > 0, w / (w + a)).otherwise(0.0)
        both = run(F.lit(True), p["lead"], p["x"], q["scale"] * held * p["scale"],
                   q["scale"] * (held * p["shift"] + (1 - held) * q["x"]) + q["shift"], q["weight"])
        lead = p["lead"] * q["lead"]
        return (F.when(p["seen"] & q["seen"], both)
                .when(p["seen"], run(F.lit(True), p["lead"], p["x"], p["scale"], p["shift"], w))
                .otherwise(run(q["seen"], lead, q["x"], q["scale"], q["shift"], q["weight"])))

    x = df
    for out, c in inputs.items():
        seen = F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        item = run(seen, F.lit(d), F.when(seen, F.col(c).cast("double")).otherwise(0.0), one, zero, one)
        x = scan_levels(x.withColumn("_item0", item), keys, POS, "_item0", compose, "_run", fan)
        mean = F.col("_run.scale") * F.col("_run.x") + F.col("_run.shift")
        x = x.withColumn(out, F.when(F.col("_run.seen"), mean)).drop("_item0", "_run")
    return x


def carry_blocks(com: float, block_rows: int) -> int:
    """Block ends needed so that older ones decay below the double range."""
    decay_per_block = block_rows * math.log1p(1.0 / com)
    return max(1, math.ceil(800.0 / decay_per_block))


def max_block_rows(com: float) -> int:
    """Largest block for which ``d^-(B-1)`` stays far inside the double range."""
    return max(1, int(600.0 / math.log1p(1.0 / com)))


def scan_rows(com: float, block_rows: int) -> int:
    """Rows scanned at once: the block, or its largest even part that stays
    inside the double range."""
    most = max_block_rows(com)
    return next(block_rows // n for n in range(1, block_rows + 1)
                if block_rows % n == 0 and block_rows // n <= most)


def ewm(df: DataFrame, keys: Sequence[str], inputs: dict[str, str], com: float,
        seed_pos, block_rows: int, spent: Sequence[str] = ()) -> DataFrame:
    """Exponential means of several columns at once.

    ``inputs`` maps output column -> input column. ``seed_pos`` (a Column or
    an int) is the first position of the mean: its input seeds the mean with
    weight 1, later rows have weight ``a``; outputs before it are NULL.
    A NULL input after the seed contributes 0 (``ewm_gaps`` keeps the mean over
    NULLs instead). ``com`` is any number from 0
    on: where a whole block would leave the double range, the block is scanned
    in equal parts. Columns in ``spent`` only feed the means and are not kept.
    """
    if com < 0:
        raise ValueError("com must be at least 0")
    keys = list(keys)
    seed = F.col(seed_pos) if isinstance(seed_pos, str) else (
        seed_pos if not isinstance(seed_pos, int) else F.lit(seed_pos))
    p = F.col(POS)
    if com == 0:                                          # no memory: the input itself
        same = {o: F.when(p >= seed, F.coalesce(F.col(c), F.lit(0.0))) for o, c in inputs.items()}
        return df.withColumns(same).drop(*spent)
    a = 1.0 / (1.0 + com)
    d = 1.0 - a
    part_rows = scan_rows(com, block_rows)
    if part_rows < block_rows:
        # Parts are numbered through the series like blocks of their own size.
        parts = df.withColumn("_whole", F.col(BLK)).withColumn(BLK, F.floor(p / part_rows).cast("bigint"))
        done = ewm(parts, keys, inputs, com, seed, part_rows, spent)
        return done.withColumn(BLK, F.col("_whole")).drop("_whole")
    off = p - F.col(BLK) * block_rows                     # 0 .. B-1
    weight = F.when(p == seed, F.lit(1.0)).when(p > seed, F.lit(a))
    grow = F.pow(F.lit(1.0 / d), off)                    # d^-(q-s)
    shrink = F.pow(F.lit(d), off)                        # d^(p-s)
    w = Window.partitionBy(*keys, BLK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)

    local = [(shrink * F.sum(F.coalesce(weight * F.col(c), F.lit(0.0)) * grow).over(w))
             .alias(f"_L_{o}") for o, c in inputs.items()]
    # The block-local scan feeds the block ends and the final rows: write it once.
    x = stage(df.select("*", *local).drop(*spent), "ewm")

    m = carry_blocks(com, block_rows)
    ends = (x.groupBy(*keys, BLK)
             .agg(F.max_by(F.struct(*[F.col(f"_L_{o}") for o in inputs]), F.col(POS)).alias("_e")))
    j = F.explode(F.sequence(F.lit(1), F.lit(m))).alias("_j")
    spread = ends.select(*keys, BLK, "_e", j)
    decay = F.pow(F.lit(d), (F.col("_j") - 1) * block_rows)
    carry = (spread.groupBy(*keys, (F.col(BLK) + F.col("_j")).alias(BLK))
                   .agg(*[F.sum(F.col(f"_e._L_{o}") * decay).alias(f"_C_{o}") for o in inputs]))
    # Keys as a struct, in which NULLs are equal: a NULL key is a series too.
    key = F.struct(*[F.col(k) for k in keys], F.col(BLK)).alias("_key")
    # Written, the carries have a known size: one row per block is broadcast
    # where it is small, and the wide rows are not shuffled once more.
    carry = stage(carry.select(key, *[f"_C_{o}" for o in inputs]), "ewm-carry")
    x = x.withColumn("_key", key).join(carry, "_key", "left").drop("_key")
    into = F.pow(F.lit(d), off + 1)
    for o in inputs:
        y = F.col(f"_L_{o}") + into * F.coalesce(F.col(f"_C_{o}"), F.lit(0.0))
        x = x.withColumn(o, F.when(p >= seed, y))
    return x.drop(*[f"_L_{o}" for o in inputs], *[f"_C_{o}" for o in inputs])
