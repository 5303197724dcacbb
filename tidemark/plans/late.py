"""Stored candles, features and carries that take up late rows, and profiles
kept by date.

Tables are partitioned by time, and a refresh overwrites only the partitions
it touches (dynamic partition overwrite of rows staged before)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, cents_mean
from tidemark.operators import repair as RP
from tidemark.operators.repair import PART, in_parts, key_of, part_of
from tidemark.sources.sinks import create_namespaces, stage, write_table

_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _touched_partitions_only(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


def replace_rows(table: str, rows: DataFrame, scope: DataFrame, keys: Sequence[str]) -> None:
    """In a table partitioned by ``row_part``: the rows of the (keys, part) in
    ``scope`` give way to ``rows``; only partitions in ``scope`` are read and
    written. The kept rows of these partitions are written beside the table
    first; ``rows`` must not read it."""
    spark = rows.sparkSession
    stored = spark.table(table)
    gone = scope.select(key_of([*keys, PART]).alias("_key")).distinct()
    kept = (in_parts(stored, scope).withColumn("_key", key_of([*keys, PART]))
            .join(gone, "_key", "left_anti").drop("_key"))
    # insertInto goes by position.
    new = stage(kept.select(*stored.columns), "kept").unionByName(rows.select(*stored.columns))
    with _touched_partitions_only(spark):
        new.hint("rebalance", PART).write.mode("overwrite").insertInto(table)


@dataclass(frozen=True)
class LateTables:
    """Table names and the layout of one set of candles, features and carries."""
    candles: str
    features: str
    carries: str
    keys: tuple[str, ...] = ("series",)
    order: tuple[str, ...] = ("open_time",)
    unit: str = "day"

    @staticmethod
    def named(spark: SparkSession, suffix: str, **layout) -> LateTables:
        create_namespaces(spark, ["bronze", "silver"])
        return LateTables(f"bronze.late_{suffix}", f"silver.late_{suffix}", f"silver.late_carries_{suffix}", **layout)


def build_tables(candles: DataFrame, t: LateTables, **sizes) -> None:
    """Build and write the three tables."""
    built = RP.build(candles, t.keys, t.order, t.unit, **sizes)
    for name, df in ((t.candles, built.candles), (t.features, built.features), (t.carries, built.carries)):
        write_table(df.hint("rebalance", PART), name, "overwrite", partition_by=[PART])


def take_up(batch: DataFrame, t: LateTables, **sizes) -> RP.Built:
    """Late, new or re-delivered candles into the three tables. The candles
    go in last: a run that fails before is done again whole."""
    spark = batch.sparkSession
    done = RP.repair(spark.table(t.candles), spark.table(t.carries), batch, t.keys, t.order, t.unit, **sizes)
    replace_rows(t.features, done.features, done.replayed, t.keys)
    # The carries' row counts and the candles must change together: the carries
    # are staged, and their short overwrite stands right before the append.
    replace_rows(t.carries, done.carries, done.replayed, t.keys)
    write_table(done.candles.hint("rebalance", PART), t.candles, "append", partition_by=[PART])
    return done


# ------------------------------------------------------------ profiles by date

def profile_states(rows: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """One mergeable state per (series, part): counts, NULLs, distinct times,
    exact cent sums, extremes, and the mean and squared deviations of close."""
    m = F.avg("close")
    return rows.groupBy(*keys, PART).agg(
        F.count(F.lit(1)).alias("n"), F.min(time).alias("earliest"), F.max(time).alias("latest"),
        F.count(time).alias("n_time"), F.count_distinct(time).alias("n_distinct"),
        F.count("close").alias("n_close"), F.sum(cents("close")).alias("s_close"),
        F.min("close").alias("min_close"), F.max("close").alias("max_close"), m.alias("mean"),
        (F.var_pop("close") * F.count("close")).alias("m2"),
        F.count("volume").alias("n_volume"), F.sum(cents("volume")).alias("s_volume"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in ("open", "high", "low", "close", "volume")])


def refresh_profile(raw: str, profile: str, touched: DataFrame, keys: Sequence[str] = ("series",),
                    time: str = "open_time") -> None:
    """States of the parts in ``touched`` anew, from just these partitions of
    ``raw``; other parts of the profile stay as they are."""
    spark = touched.sparkSession
    new = stage(profile_states(in_parts(spark.table(raw), touched), keys, time), "profile")
    with _touched_partitions_only(spark):
        (new.select(*spark.table(profile).columns).hint("rebalance", PART)
            .write.mode("overwrite").insertInto(profile))


def append_profiled(rows: DataFrame, raw: str, profile: str, keys: Sequence[str] = ("series",),
                    time: str = "open_time", unit: str = "day") -> None:
    """Append raw rows as delivered and refresh the dates they fall on. Both
    tables are made on the first call. A refresh recomputes a date whole, so
    it may be repeated after a failure."""
    spark = rows.sparkSession
    rows = stage(rows.withColumn(PART, part_of(time, unit)), "profile-rows")
    first = not spark.catalog.tableExists(profile)
    write_table(rows.hint("rebalance", PART), raw, "overwrite" if first else "append", partition_by=[PART])
    if first:
        write_table(profile_states(rows, keys, time).hint("rebalance", PART), profile, partition_by=[PART])
    else:
        refresh_profile(raw, profile, rows, keys, time)


def merged_profile(states: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """The profile per series from its states; no raw row is read. Squared
    deviations merge about the common mean (Chan's rule)."""
    keys = list(keys)
    total = states.groupBy(*keys).agg((F.sum(F.col("n_close") * F.col("mean")) / F.sum("n_close")).alias("_mean"))
    x = states.withColumn("_key", key_of(keys)).join(total.select(key_of(keys).alias("_key"), "_mean"), "_key")
    away = F.col("mean") - F.col("_mean")
    n, m2 = F.sum("n_close"), F.sum(F.col("m2") + F.col("n_close") * away * away)
    return x.groupBy(*keys).agg(
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest"), F.sum("n").alias("total_rows"),
        F.sum("n_distinct").alias("distinct_times"), (F.sum("n_time") - F.sum("n_distinct")).alias("duplicate_rows"),
        cents_mean(F.sum("s_close"), n).alias("avg_price"),
        F.round(F.when(n > 1, F.sqrt(m2 / (n - 1))), 2).alias("stddev"),
        F.round(F.min("min_close"), 2).alias("min_price"), F.round(F.max("max_close"), 2).alias("max_price"),
        cents_mean(F.sum("s_volume"), F.sum("n_volume")).alias("avg_volume"),
        *[F.sum(f"{c}_nulls").alias(f"{c}_nulls") for c in ("open", "high", "low", "close", "volume")])
