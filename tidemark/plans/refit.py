"""A model kept up to date: stored rows and states, refit on append.

Two tables per model. ``rows``: the model frame with its position, partitioned
by block (``pos div block``). ``states``: one mergeable state per (series,
block) and append (:mod:`tidemark.operators.moments`).

An append writes the new rows and their states. The training part is the first
``floor(0.8 n)`` rows of a series, so it grows by rows stored long ago: their
blocks' states are merged as they are, and of the one block that the boundary
cuts the rows before it are read (partition pruning). No other history is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ml, moments
from tidemark.operators.positions import POS
from tidemark.operators.ranges import with_range_position
from tidemark.sources.sinks import create_namespaces, stage, write_table

SBLK = "_sblk"


@dataclass(frozen=True)
class ModelTables:
    rows: str
    states: str
    block: int = 4096

    @staticmethod
    def named(spark: SparkSession, suffix: str, block: int = 4096) -> ModelTables:
        create_namespaces(spark, ["gold"])
        return ModelTables(f"gold.model_rows_{suffix}", f"gold.model_states_{suffix}", block)


def append_rows(frame: DataFrame, tables: ModelTables, inputs: Sequence[str], target: str = "target",
                keys: Sequence[str] = ("series",), time: str = "open_time") -> None:
    """Append model rows (later than the stored ones of their series) and the
    states of just these rows."""
    spark, keys = frame.sparkSession, list(keys)
    x = with_range_position(frame, keys, [time], with_length=False)
    first = not spark.catalog.tableExists(tables.states)
    if not first:
        held = spark.table(tables.states).groupBy(*keys).agg(F.sum("n").alias("_held"))
        key = F.struct(*[F.col(k) for k in keys]).alias("_key")
        x = x.withColumn("_key", key).join(held.select(key, "_held"), "_key", "left")
        x = x.withColumn(POS, F.col(POS) + F.coalesce("_held", F.lit(0))).drop("_key", "_held")
    x = stage(x.withColumn(SBLK, F.floor(F.col(POS) / tables.block).cast("bigint")), "model-rows")
    mode = "overwrite" if first else "append"
    new = stage(moments.states(x, [*inputs, target], [*keys, SBLK]), "model-states")
    write_table(x.hint("rebalance", SBLK), tables.rows, mode, partition_by=[SBLK])
    write_table(new, tables.states, mode)


def refit(spark: SparkSession, tables: ModelTables, inputs: Sequence[str], target: str = "target",
          keys: Sequence[str] = ("series",), fraction: float = ml.TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    """(model, bounds): coefficients per series from the stored states, and the
    first test position of each series (``_cut``)."""
    keys = list(keys)
    states = spark.table(tables.states)
    key = F.struct(*[F.col(k) for k in keys]).alias("_key")
    bounds = stage(states.groupBy(*keys).agg(F.floor(F.sum("n") * F.lit(fraction)).cast("bigint").alias("_cut"))
                   .withColumn(SBLK, F.floor(F.col("_cut") / tables.block).cast("bigint")), "model-bounds")
    cut = bounds.select(key, "_cut", F.col(SBLK).alias("_cutblk"))
    whole = states.withColumn("_key", key).join(cut, "_key").where(F.col(SBLK) < F.col("_cutblk"))
    # One block a series: joined on the partition column, so that only these
    # partitions are read.
    edge = spark.table(tables.rows).join(bounds, [*keys, SBLK]).where(F.col(POS) < F.col("_cut"))
    part = moments.states(edge, [*inputs, target], keys)
    columns = part.columns
    both = whole.select(*columns).unionByName(part)
    return moments.solved(moments.merged(both, len(inputs) + 1, keys), len(inputs), keys), bounds


def test_rows(spark: SparkSession, tables: ModelTables, bounds: DataFrame,
              keys: Sequence[str] = ("series",)) -> DataFrame:
    """Stored rows after the training part, marked ``split = 'test'``; blocks
    before the earliest boundary are not read (one number at the driver)."""
    keys = list(keys)
    least = bounds.agg(F.min(SBLK)).first()[0]
    key = F.struct(*[F.col(k) for k in keys]).alias("_key")
    rows = spark.table(tables.rows).where(F.col(SBLK) >= F.lit(least if least is not None else 0))
    rows = rows.withColumn("_key", key).join(bounds.select(key, "_cut"), "_key")
    return rows.where(F.col(POS) >= F.col("_cut")).withColumn("split", F.lit("test")).drop("_key", "_cut", SBLK, POS)
