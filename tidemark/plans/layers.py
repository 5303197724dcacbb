"""Stored layers: silver features, gold predictions and metrics as tables, and
dashboard data read back from them.

Silver and predictions are partitioned by the date of the row (``row_date``),
so a panel of the newest days reads only their partitions. Predictions are
overwritten by each run; metrics are appended, one row per series and run.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.gold import GoldResult
from tidemark.sources.sinks import create_namespaces, write_table

ROW_DATE = "row_date"


@dataclass(frozen=True)
class Layers:
    """Table names of one set of layers."""
    silver: str
    predictions: str
    metrics: str


def _dated(df: DataFrame, time: str) -> DataFrame:
    # Rebalanced by date: few files a date, and a heavy date is split.
    return df.withColumn(ROW_DATE, F.to_date(time)).hint("rebalance", ROW_DATE)


def write_silver(features: DataFrame, layers: Layers, time: str = "open_time") -> None:
    """Overwrite the feature table, partitioned by date."""
    write_table(_dated(features, time), layers.silver, "overwrite", partition_by=[ROW_DATE])


def write_gold(result: GoldResult, layers: Layers, time: str = "open_time") -> None:
    """Overwrite the predictions, append the metrics of this run."""
    write_table(_dated(result.predictions, time), layers.predictions, "overwrite", partition_by=[ROW_DATE])
    write_table(result.metrics, layers.metrics, "append")


def named(spark: SparkSession, suffix: str) -> Layers:
    """Layer names in the silver and gold schemas, which are made if missing."""
    create_namespaces(spark, ["silver", "gold"])
    return Layers(f"silver.features_{suffix}", f"gold.predictions_{suffix}", f"gold.metrics_{suffix}")


def newest_since(table: DataFrame, days: int, keys=("series",), time: str = "open_time") -> DataFrame:
    """Rows of the last ``days`` days of each series of a dated table.

    The bound of the series that ends first limits the partitions read (one
    row reaches the driver); each series' own bound then limits its rows."""
    since = table.groupBy(*keys).agg((F.max(time) - F.make_dt_interval(F.lit(days))).alias("since"))
    least = since.agg(F.min(F.to_date("since"))).first()[0]
    pruned = table.where(F.col(ROW_DATE) >= F.lit(least or dt.date.max))
    return pruned.join(since, list(keys)).where(F.col(time) >= F.col("since")).drop("since", ROW_DATE)
