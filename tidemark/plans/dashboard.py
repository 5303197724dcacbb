"""Serving datasets: the data behind the reference's dashboard and charts.

Drawing is not built; each chart's data is a small DataFrame. The recent
window is filtered on the executors before anything is read out, and the
bound (newest feature time minus N days) is computed per series from the
feature table and applied to features and predictions alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import RSI_OVERBOUGHT, RSI_OVERSOLD
from tidemark.functions.formatting import fixed

RECENT_DAYS = 30
LAST_N_ROWS = 7 * 24

# Fixed labels (the reference labels error > 0 as over-estimate; with
# error = actual - predicted that is an under-estimate, labelled here as such).
ZONE_OVERBOUGHT, ZONE_OVERSOLD, ZONE_NEUTRAL = "overbought", "oversold", "neutral"
COLOUR_UP, COLOUR_DOWN = "green", "red"
BAND_UNDER, BAND_OVER, BAND_EXACT = "underestimate", "overestimate", "exact"


def recent_bound(features: DataFrame, keys: Sequence[str] = ("series",),
                 days: int = RECENT_DAYS, time: str = "open_time") -> DataFrame:
    """Per series: newest time minus ``days`` (one row per series)."""
    return features.groupBy(*keys).agg(
        (F.max(time) - F.make_dt_interval(F.lit(days))).alias("since"))


def recent(df: DataFrame, bound: DataFrame, keys: Sequence[str] = ("series",),
           time: str = "open_time") -> DataFrame:
    """Rows of ``df`` at or after their series' bound (equi-join on the key
    plus a filter; the bound table has one row per series)."""
    return (df.join(bound, list(keys)).filter(F.col(time) >= F.col("since")).drop("since"))


def candle_colour(features: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    return features.select(*keys, "open_time", "open", "close", "volume",
                           F.when(F.col("close") >= F.col("open"), COLOUR_UP)
                            .otherwise(COLOUR_DOWN).alias("colour"))


def rsi_zone(rsi: str = "rsi_14"):
    r = F.col(rsi)
    return (F.when(r >= RSI_OVERBOUGHT, ZONE_OVERBOUGHT)
             .when(r <= RSI_OVERSOLD, ZONE_OVERSOLD)
             .when(r.isNotNull(), ZONE_NEUTRAL))


def rsi_zones(features: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    return features.select(*keys, "open_time", "rsi_14", rsi_zone().alias("zone"))


def error_band(error: str = "error"):
    e = F.col(error)
    return F.when(e > 0, BAND_UNDER).when(e < 0, BAND_OVER).when(e == 0, BAND_EXACT)


def error_bands(predictions: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    return predictions.select(*keys, "open_time", "error", error_band().alias("band"))


def actual_vs_predicted(features: DataFrame, predictions: DataFrame,
                        keys: Sequence[str] = ("series",)) -> DataFrame:
    """Close at each time with the prediction made *for* that time.

    Predictions are stamped with the feature row they were made from; the
    value they predict belongs to ``target_time``, so the overlay joins on it.
    """
    p = predictions.select(*keys, F.col("target_time").alias("open_time"),
                           F.col("predicted"), F.col("open_time").alias("made_at"))
    return features.select(*keys, "open_time", F.col("close").alias("actual")) \
                   .join(p, [*keys, "open_time"], "left")


def full_test_chart(predictions: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    return predictions.select(*keys, "open_time", "actual", "predicted",
                              F.round(F.col("actual") - F.col("predicted"), 2).alias("gap"))


def last_rows(df: DataFrame, n: int = LAST_N_ROWS, keys: Sequence[str] = ("series",),
              order: Sequence[str] = ("open_time",)) -> DataFrame:
    """Last ``n`` rows per series. ``row_number() <= n`` is planned with a
    partial WindowGroupLimit before the shuffle, so at most ``n`` rows per
    series leave each task."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
              .drop("_rn"))


def first_rows(df: DataFrame, n: int, keys: Sequence[str] = ("series",),
               order: Sequence[str] = ("open_time",)) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
              .drop("_rn"))


def metrics_kpi(metrics: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Score KPIs in long form: r2, r2_train and 1 - mape/100."""
    return metrics.select(*keys, "run_id", F.expr(
        "stack(3, 'r2_test', r2, 'r2_train', r2_train, 'accuracy', 1 - mape / 100)"
    ).alias("metric", "value")).withColumn("value", F.round("value", 6))


def latest(df: DataFrame, keys: Sequence[str] = ("series",),
           order: Sequence[str] = ("created_at", "run_id")) -> DataFrame:
    """Newest row per series by ``order`` (``max_by`` over a struct: one
    partial row per task and series)."""
    cols = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(
        F.max_by(F.struct(*cols), F.struct(*order)).alias("_row"))
    return packed.select(*keys, "_row.*")


def metrics_panel_text(metrics: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """Latest metrics per series as the panel's text lines."""
    m = latest(metrics, keys)
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Model: "), F.col("model")),
        F.concat(F.lit("RMSE: "), fixed(F.col("rmse"), 2, 4)),
        F.concat(F.lit("MAE: "), fixed(F.col("mae"), 2, 4)),
        F.concat(F.lit("R2 Score: "), fixed(F.col("r2"), 4, 6)),
        F.concat(F.lit("MAPE: "), fixed(F.col("mape"), 4), F.lit("%")),
        F.concat(F.lit("Train Rows: "), F.col("train_rows").cast("string")),
        F.concat(F.lit("Test Rows: "), F.col("test_rows").cast("string")),
    )
    return m.select(*keys, "run_id", text.alias("panel"))


@dataclass
class Dashboard:
    actual_vs_predicted: DataFrame
    rsi: DataFrame
    volume: DataFrame
    metrics: DataFrame


def run_dashboard(features: DataFrame, predictions: DataFrame, metrics: DataFrame,
                  keys: Sequence[str] = ("series",), days: int = RECENT_DAYS) -> Dashboard:
    """The four panels as DataFrames (V9), all filtered to the recent window."""
    bound = recent_bound(features, keys, days)
    f = recent(features, bound, keys)
    p = recent(predictions, bound, keys)
    return Dashboard(
        actual_vs_predicted=actual_vs_predicted(f, p, keys),
        rsi=rsi_zones(f, keys),
        volume=candle_colour(f, keys),
        metrics=metrics_panel_text(metrics, keys),
    )
