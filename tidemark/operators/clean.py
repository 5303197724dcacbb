"""Cleaning: de-duplication, validity filters, null handling, imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import is_valid_number, q


def dedup_first(df: DataFrame, keys: Sequence[str], tiebreak: Sequence[str]) -> DataFrame:
    """Keep one row per ``keys``: the first by ``tiebreak`` (repeatable,
    unlike ``dropDuplicates``, whose survivor is arbitrary).

    Partitioned on the full key, so a hot series spreads over its distinct
    times; AQE splits skewed partitions.
    """
    w = Window.partitionBy(*keys).orderBy(*tiebreak)
    return (df.withColumn("_dup_rn", F.row_number().over(w))
              .filter(F.col("_dup_rn") == 1).drop("_dup_rn"))


def valid_candles(df: DataFrame, close: str = "close", volume: str = "volume") -> DataFrame:
    """``close > 0`` and ``volume >= 0``, also rejecting NULL and NaN
    (Spark orders NaN above every number, so ``NaN > 0`` holds)."""
    return df.filter(is_valid_number(close) & (F.col(close) > 0)
                     & is_valid_number(volume) & (F.col(volume) >= 0))


def clean_candles(df: DataFrame, keys: Sequence[str] = ("series",),
                  order: Sequence[str] = ("open_time",),
                  tiebreak: Sequence[str] | None = None) -> DataFrame:
    """De-duplicate on (keys, order), then filter invalid values.

    The filter runs after the de-duplication, as in the reference: a bad
    survivor removes its time slot instead of letting a later copy in.
    """
    tiebreak = list(tiebreak) if tiebreak else ["open", "high", "low", "close", "volume"]
    if isinstance(order, str):
        order = [order]
    return valid_candles(dedup_first(df, [*keys, *order], tiebreak))


def null_mask(columns: Sequence[str]):
    """Column true when any of ``columns`` is NULL or NaN (numeric)."""
    if not columns:
        return F.lit(False)
    return F.expr(" OR ".join(f"{q(c)} IS NULL OR isnan({q(c)})" for c in columns))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL or NaN in any of ``columns``."""
    return df.filter(~null_mask(columns))


def dropna_report(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows before / after dropping incomplete rows, per key, in one pass."""
    bad = null_mask(columns)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(~bad).alias("rows_after"),
        F.count_if(bad).alias("rows_dropped"),
    )


def exact_medians(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                  runs: bool = False) -> DataFrame:
    """Exact median of each column per key (NULL and NaN skipped; the two
    middle values interpolated for an even count, as SQL ``median``).

    ``median`` keeps every distinct value of a group in one aggregation
    buffer, so one key holding a large share of continuous values would hold
    them all in one task. Here the values are found by rank instead:

    1. The columns are unpivoted to (keys, column, value) and range
       partitioned on that order, so a hot group spreads over many bounded
       partitions. The tagged rows are written once (two readers).
    2. Rows per (group, partition) give, over that small table, the
       partition holding each middle rank and the rank within it.
    3. Only those partitions are ranked (a window per group and partition,
       at most one range partition of rows) and the two values are read off.

    ``runs``: for columns whose values repeat (hours, months, rounded prices).
    Equal values are counted first, with partial counts where they lie, so at
    most one row per distinct value and task is shuffled; ranks then run on
    cumulative counts. Without it every cell is a run of one.

    Returns one row per key with ``_med_<column>``.
    """
    from tidemark.sources.sinks import stage

    keys, cols = list(keys), list(columns)
    name, v, pid = "_col", "_v", "_pid"
    cells = F.array(*[F.struct(F.lit(c).alias(name),
                               F.when(~F.isnan(F.col(c)), F.col(c)).cast("double").alias(v))
                      for c in cols])
    long = (df.select(*keys, F.explode(cells).alias("_cell"))
              .select(*keys, F.col(f"_cell.{name}").alias(name), F.col(f"_cell.{v}").alias(v))
              .filter(F.col(v).isNotNull()))
    g = [*keys, name]
    long = (long.groupBy(*g, v).agg(F.count(F.lit(1)).alias("_w")) if runs
            else long.withColumn("_w", F.lit(1).cast("bigint")))
    # Partition ids after a range exchange are increasing in (g, v), also
    # when AQE merges neighbouring partitions.
    tagged = stage(long.repartitionByRange(*g, v).withColumn(pid, F.spark_partition_id()),
                   "median_ranked")
    counts = tagged.groupBy(*g, pid).agg(F.sum("_w").alias("_c"))
    by_pid = Window.partitionBy(*g).orderBy(pid)
    ranges = counts.select(
        *g, pid, "_c",
        F.coalesce(F.sum("_c").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy(*g)).alias("_n"))
    n = F.col("_n")
    wanted = F.array(F.struct(F.lit(0).alias("_which"), F.floor((n - 1) / 2).alias("_rank")),
                     F.struct(F.lit(1).alias("_which"), F.floor(n / 2).alias("_rank")))
    need = (ranges.select(*g, pid, "_c", "_off", F.explode(wanted).alias("_w"))
                  .select(*g, pid, F.col("_w._which").alias("_which"),
                          (F.col("_w._rank") - F.col("_off")).alias("_r"), "_c")
                  .filter((F.col("_r") >= 0) & (F.col("_r") < F.col("_c"))).drop("_c"))
    # At most two rows per group, read twice: written once so the counts
    # aggregate over all tagged rows runs once.
    need = stage(need, "median_need")
    parts = need.select(*g, pid).distinct()
    ranked = (tagged.join(parts, [*g, pid], "left_semi")
                    .select(*g, pid, v, "_w", F.sum("_w").over(Window.partitionBy(*g, pid).orderBy(v).rowsBetween(
                        Window.unboundedPreceding, 0)).alias("_to")))
    # The run that holds a wanted rank: at most two ranks a group.
    picked = ranked.join(need, [*g, pid]).where(
        (F.col("_r") < F.col("_to")) & (F.col("_r") >= F.col("_to") - F.col("_w")))
    lo = F.max(F.when(F.col("_which") == 0, F.col(v)))
    hi = F.max(F.when(F.col("_which") == 1, F.col(v)))
    med = picked.groupBy(*g).agg((lo + (hi - lo) * 0.5).alias("_med"))
    # Back to one row per key: at most len(columns) rows per key.
    wide = med.groupBy(*keys).agg(*[F.max(F.when(F.col(name) == c, F.col("_med"))).alias(f"_med_{c}")
                                    for c in cols])
    return wide


def median_impute(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
                  exact: bool = True) -> DataFrame:
    """Fill NULL/NaN in ``columns`` with the column median per key.

    ``exact`` finds the medians by rank (:func:`exact_medians`, bounded
    memory per task however large one key is); ``exact=False`` uses
    ``percentile_approx`` (one pass, bounded sketch per key).

    The medians are equi-joined back on the keys. Without keys the median
    table has exactly one row and is broadcast; with keys it has one row per
    key and the join strategy is left to AQE's size check.
    """
    cols = list(columns)
    clean = {c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols}
    if keys:
        jk = list(keys)
        base = df
    else:
        jk = ["_all"]
        base = df.withColumn("_all", F.lit(0))
    if exact:
        med = exact_medians(base, cols, jk)
    else:
        med = base.groupBy(*jk).agg(*[F.percentile_approx(clean[c], 0.5, 10000).alias(f"_med_{c}")
                                      for c in cols])
    joined = base.join(med if keys else F.broadcast(med), jk, "left")
    out = joined.select(
        *[F.col(c) for c in df.columns if c not in cols],
        *[F.coalesce(clean[c], F.col(f"_med_{c}")).alias(c) for c in cols],
    )
    return out.select(*df.columns)
