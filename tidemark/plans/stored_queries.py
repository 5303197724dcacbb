"""Queries over stored layers, models with a checkable closed form, and
cleaning queries over ``orders`` (ties on most dates, years of span), where
every filter has rows to drop."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import clean as CL
from tidemark.plans import dashboard as D
from tidemark.plans import gold as G
from tidemark.plans import layers as L
from tidemark.plans import oracle as O
from tidemark.plans import registry as R
from tidemark.plans.features import MODEL_INPUTS
from tidemark.plans.registry import query
from tidemark.sources.tables import order_ticks

# ------------------------------------------------------------- two-input model

TWO_INPUTS = ("close", "volume")

_TWO_SQL = O.FEATURES + R._mf() + """,
o2 AS (
  SELECT series, avg(close) AS mc, avg(volume) AS mv, avg(target) AS my,
         var_pop(close) AS cc, var_pop(volume) AS vv, covar_pop(close, volume) AS cv,
         covar_pop(target, close) AS yc, covar_pop(target, volume) AS yv
  FROM mf WHERE split = 'train' GROUP BY series),
sp AS (
  SELECT m.*, my + (yc * vv - yv * cv) / (cc * vv - cv * cv) * (m.close - mc)
                 + (yv * cc - yc * cv) / (cc * vv - cv * cv) * (m.volume - mv) AS prediction
  FROM mf m JOIN o2 ON o2.series = m.series)""" + R._tables_sql("r2", "", "LinearRegression", 2)

_METRIC_COLUMNS = "series, run_id, model, rmse, mae, r2, mape, r2_train, train_rows, test_rows, features, created_at"


def _two_inputs(spark, sf):
    return G.run_ols(R._frame(spark, sf), inputs=TWO_INPUTS, run_id="r2",
                     created_at=F.lit(R.RUN_AT["r2"]).cast("timestamp_ntz"))


@query("ols_two_inputs", R._sql(_TWO_SQL, f"""
SELECT series, open_time, target_time, actual, predicted, error, pct_error, run_id, model,
       TIMESTAMP '{R.RUN_AT["r2"]}' AS created_at FROM preds"""))
def ols_two_inputs(spark, sf):
    """M2-M6: the least-squares path on two inputs, against the closed form."""
    return _two_inputs(spark, sf).predictions


@query("ols_two_inputs_metrics", R._sql(_TWO_SQL, f"SELECT {_METRIC_COLUMNS} FROM metrics"))
def ols_two_inputs_metrics(spark, sf):
    """M7: metrics of the two-input model, one row per series."""
    return _two_inputs(spark, sf).metrics.select(*_METRIC_COLUMNS.split(", "))


@query("ols_residual_check", R._sql(O.FEATURES + R._mf(), f"""
SELECT series, input, true AS orthogonal
FROM (SELECT DISTINCT series FROM mf WHERE split = 'train'),
     (SELECT unnest([{', '.join(f"'{c}'" for c in MODEL_INPUTS)}]) AS input)"""))
def ols_residual_check(spark, sf):
    """M4: training residuals of the 19-input model do not correlate with any
    input (to 6 digits), which only the least-squares fit satisfies."""
    g = R._ols(spark, sf)
    e = g.scored.where("split = 'train'").withColumn("_e", F.col("target") - F.col("prediction"))
    by = e.groupBy("series").agg(*[
        F.try_divide(F.covar_pop("_e", c), F.stddev_pop("_e") * F.stddev_pop(c)).alias(c) for c in MODEL_INPUTS])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("input"), F.col(c).alias("r")) for c in MODEL_INPUTS]))
    # A constant input has no correlation.
    fits = F.abs(F.coalesce("x.r", F.lit(0.0))) < 1e-6
    return by.select("series", pairs.alias("x")).select("series", F.col("x.input").alias("input"),
                                                        fits.alias("orthogonal"))


# --------------------------------------------------------------- stored layers

def _stored(spark, sf):
    """All layers of two runs: silver once, predictions overwritten by the
    second run, metrics of both appended."""
    layers = L.named(spark, uuid.uuid4().hex[:12])
    f = R._features(spark, sf, keep_position=True)
    L.write_silver(f, layers)
    f = spark.table(layers.silver).drop(L.ROW_DATE)
    for run, fraction in (("r1", 0.7), ("r2", 0.8)):
        L.write_gold(R._simple(spark, sf, run, fraction, features=f), layers)
    return layers


@query("stored_latest_metrics", R.ORACLE["latest_metrics"])
def stored_latest_metrics(spark, sf):
    """Newest metrics row per series from the appended table."""
    both = spark.table(_stored(spark, sf).metrics)
    return D.latest(both).select(*[c.strip() for c in R._LATEST_COLS.split(",")])


@query("stored_predictions", R._sql(R._SIMPLE, """
SELECT series, open_time, target_time, actual, predicted, error, pct_error, run_id, model FROM preds"""))
def stored_predictions(spark, sf):
    """M6: the predictions table after the second run has overwritten it."""
    return spark.table(_stored(spark, sf).predictions).drop("created_at", L.ROW_DATE)


@query("stored_recent_rsi", R._sql(R._FEAT, """
SELECT f.series, f.open_time, f.rsi_14,
       CASE WHEN f.rsi_14 >= 70 THEN 'overbought' WHEN f.rsi_14 <= 30 THEN 'oversold'
            WHEN f.rsi_14 IS NOT NULL THEN 'neutral' END AS zone
FROM features f JOIN (SELECT series, max(open_time) - INTERVAL 7 DAY AS since FROM features GROUP BY series) b
  ON b.series = f.series WHERE f.open_time >= b.since"""))
def stored_recent_rsi(spark, sf):
    """RSI zones of the last 7 days, read from the dated silver table."""
    layers = L.named(spark, uuid.uuid4().hex[:12])
    L.write_silver(R._features(spark, sf), layers)
    return D.rsi_zones(L.newest_since(spark.table(layers.silver), 7))


# --------------------------------------------------- orders: filters that bite

_ORDERS = """
ticks AS (
  SELECT 'all' AS series, o_orderdate AS ts, o_orderkey AS tick_id, o_totalprice AS price FROM orders)"""
_FIRST = """,
firsts AS (
  SELECT series, ts, tick_id, price FROM (
    SELECT *, row_number() OVER (PARTITION BY series, ts ORDER BY tick_id) AS rn FROM ticks)
  WHERE rn = 1)"""


def _firsts(spark, sf):
    return CL.dedup_first(order_ticks(spark, sf), ["series", "ts"], ["tick_id"]).select(
        "series", "ts", "tick_id", "price")


@query("order_dedup", R._sql(_ORDERS + _FIRST, "SELECT * FROM firsts"))
def order_dedup(spark, sf):
    """The first order of each date."""
    return _firsts(spark, sf)


@query("order_duplicates", R._sql(_ORDERS, """
SELECT series, count(*) AS total_rows, count(DISTINCT ts) AS distinct_times,
       count(ts) - count(DISTINCT ts) AS duplicate_rows
FROM ticks GROUP BY series"""))
def order_duplicates(spark, sf):
    """A4: orders beyond the first of their date."""
    return order_ticks(spark, sf).groupBy("series").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("ts").alias("distinct_times"),
        (F.count("ts") - F.count_distinct("ts")).alias("duplicate_rows"))


@query("order_recent_30d", R._sql(_ORDERS, """
SELECT t.series, t.ts, t.tick_id, t.price
FROM ticks t JOIN (SELECT series, max(ts) - INTERVAL 30 DAY AS since FROM ticks GROUP BY series) b
  ON b.series = t.series WHERE t.ts >= b.since"""))
def order_recent_30d(spark, sf):
    """Orders within 30 days of the newest, out of years."""
    t = order_ticks(spark, sf)
    return D.recent(t, D.recent_bound(t, time="ts"), time="ts").select("series", "ts", "tick_id", "price")


@query("order_last_168", R._sql(_ORDERS + _FIRST, """
SELECT series, ts, tick_id, price FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS rn FROM firsts)
WHERE rn <= 168"""))
def order_last_168(spark, sf):
    """The last 168 dates' first orders."""
    return D.last_rows(_firsts(spark, sf), 168, order=["ts"])


_WINDOW_COLUMNS = ("returns", "volatility_24", "lag_1", "lag_3", "lag_6", "lag_24")


@query("window_nulls", R._sql(O.WINDOWED, "SELECT series, " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in _WINDOW_COLUMNS) + " FROM win GROUP BY series"))
def window_nulls(spark, sf):
    """A3: NULLs of the window columns before the trim."""
    x = R._untrimmed(spark, sf)
    return x.groupBy("series").agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in _WINDOW_COLUMNS])
