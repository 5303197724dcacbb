"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the given tables, with the DuckDB SQL
that recomputes it (``ORACLE``) where SQL can.

Conventions: the price series are ``events`` split by ``event_type`` (ticks,
or 1-hour candles built from them), ``events`` split by ``user_id`` (many
short series) and ``orders`` as one long series. Every query reads whole
tables; there are no row caps except where the limit is the operator
(tail/head/top-k).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import cents, cents_mean, half_up_div, micros_mean
from tidemark.operators import candles as C
from tidemark.operators import clean as CL
from tidemark.operators import incremental as INC
from tidemark.operators import ml
from tidemark.operators import positions as P
from tidemark.operators.scan import ewm
from tidemark.operators.windows import lag_with_fallback
from tidemark.plans import dashboard as D
from tidemark.plans import gold as G
from tidemark.plans import oracle as O
from tidemark.plans.features import MODEL_INPUTS, build_features, windowed, with_rsi
from tidemark.sources import sinks
from tidemark.sources.tables import load, order_ticks, ticks, ticks_as_candles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


# ---------------------------------------------------------------- building blocks

TICK_ORDER = ("open_time", "tick_id")
CUT = "2024-01-20 00:00:00"          # incremental split point in the test data
REDELIVER_FROM = "2024-01-19 12:00:00"
RUN_AT = {"r1": "2024-02-01 00:00:00", "r2": "2024-02-01 01:00:00"}


# Hourly candles have at most 24 rows per series and day, so day buckets are
# always small enough for numbering; no sizing pass is needed.
CANDLE_BUCKET = "day"


def _candles(spark, sf):
    return C.resample(ticks(spark, sf))


def _features(spark, sf, keep_position=False):
    return build_features(_candles(spark, sf), bucket_unit=CANDLE_BUCKET,
                          keep_position=keep_position)


def _tick_candles(spark, sf, key="event_type"):
    return ticks_as_candles(ticks(spark, sf, key))


def _frame(spark, sf, fraction=ml.TRAIN_FRACTION, features=None):
    """Model frame, written once: scaler, fit, predictions and scores all read it.
    ``features`` (built with ``keep_position=True``) is reused when given."""
    f = features if features is not None else _features(spark, sf, keep_position=True)
    return G.prepare(f, train_fraction=fraction, materialize=True, bucket_unit=CANDLE_BUCKET)


def _simple(spark, sf, run="r2", fraction=ml.TRAIN_FRACTION, features=None):
    return G.run_simple(_frame(spark, sf, fraction, features), run_id=run,
                        created_at=F.to_timestamp(F.lit(RUN_AT[run])))


def _ols(spark, sf):
    return G.run_ols(_frame(spark, sf), run_id="ols",
                     created_at=F.to_timestamp(F.lit(RUN_AT["r2"])))


def _untrimmed(spark, sf):
    return windowed(_candles(spark, sf), ["series"], ["open_time"], bucket_unit=CANDLE_BUCKET)


# ------------------------------------------------------------------------ SQL parts

def _sql(ctes: str, body: str) -> str:
    return O.with_(ctes, body)


_NOTNULL = " AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))"
                        for c in [*MODEL_INPUTS, "target"])


def _mf(fraction: float = 0.8, sfx: str = "") -> str:
    return f""",
tgt{sfx} AS (
  SELECT f.*, lead(close) OVER (PARTITION BY series ORDER BY open_time) AS target,
         lead(open_time) OVER (PARTITION BY series ORDER BY open_time) AS target_time
  FROM features f),
mf_in{sfx} AS (SELECT * FROM tgt{sfx} WHERE {_NOTNULL}),
mf{sfx} AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY open_time) - 1
                      < floor(count(*) OVER (PARTITION BY series) * CAST({fraction} AS DOUBLE))
            THEN 'train' ELSE 'test' END AS split
  FROM mf_in{sfx})"""


def _simple_sql(run: str = "r2", fraction: float = 0.8, sfx: str = "") -> str:
    return _mf(fraction, sfx) + f""",
sm{sfx} AS (
  SELECT series, regr_slope(target, close) AS slope, regr_intercept(target, close) AS intercept,
         count(*) AS train_rows
  FROM mf{sfx} WHERE split = 'train' GROUP BY series),
sp{sfx} AS (
  SELECT m.*, s.intercept + s.slope * m.close AS prediction
  FROM mf{sfx} m JOIN sm{sfx} s ON s.series = m.series)""" + _tables_sql(run, sfx, "SimpleRegression", 1)


def _tables_sql(run: str, sfx: str, model: str, features: int) -> str:
    """Gold tables from scored rows ``sp``."""
    return f""",
preds{sfx} AS (
  SELECT series, open_time, target_time, target AS actual, round(prediction, 2) AS predicted,
         round(target - prediction, 2) AS error,
         round(abs(target - prediction) / target * 100, 4) AS pct_error,
         '{run}' AS run_id, '{model}' AS model
  FROM sp{sfx} WHERE split = 'test'),
sc{sfx} AS (
  SELECT series, split, count(*) AS rows,
         sqrt(avg((target - prediction) * (target - prediction))) AS rmse,
         avg(abs(target - prediction)) AS mae,
         1 - sum((target - prediction) * (target - prediction))
             / (var_pop(target) * count(target)) AS r2,
         avg(abs((target - prediction) / target)) * 100 AS mape
  FROM sp{sfx} GROUP BY series, split),
metrics{sfx} AS (
  SELECT t.series, '{run}' AS run_id, '{model}' AS model,
         round(t.rmse, 4) AS rmse, round(t.mae, 4) AS mae, round(t.r2, 6) AS r2,
         round(t.mape, 4) AS mape, round(r.r2, 6) AS r2_train,
         r.rows AS train_rows, t.rows AS test_rows, CAST({features} AS BIGINT) AS features,
         TIMESTAMP '{RUN_AT[run]}' AS created_at
  FROM sc{sfx} t JOIN sc{sfx} r ON r.series = t.series AND t.split = 'test' AND r.split = 'train')"""


_C = O.CANDLES
_W = O.WINDOWED
_FEAT = O.FEATURES
_SIMPLE = O.FEATURES + _simple_sql()


def _cents_sql(x: str) -> str:
    return f"CAST(round({x} * 100) AS BIGINT)"


def _cents_mean_sql(x: str) -> str:
    s, n = f"sum({_cents_sql(x)})", f"count({x})"
    return f"CASE WHEN {n} > 0 THEN ((2 * {s} + {n}) // (2 * {n})) / 100.0 END"


def _micros_mean_sql(x: str) -> str:
    s, n = f"sum(CAST(round({x} * 1000000) AS BIGINT))", f"count({x})"
    q = f"((2 * abs({s}) + {n}) // (2 * {n}))"
    return f"CASE WHEN {n} > 0 THEN sign({s}) * {q} / 1000000.0 END"


# ------------------------------------------------------------- 2.1 sources / sinks

@query("candles_1h", _sql(_C, "SELECT * FROM candles"))
def candles_1h(spark, sf):
    """1-hour OHLCV candles per event type from ticks."""
    return _candles(spark, sf)


@query("candle_shape", _sql(O.TICKS, """
SELECT series, ts, tick_id,
       round(coalesce(lag(price) OVER w, price), 2) AS open,
       round(greatest(coalesce(lag(price) OVER w, price), price), 2) AS high,
       round(least(coalesce(lag(price) OVER w, price), price), 2) AS low,
       round(price, 2) AS close
FROM ticks WINDOW w AS (PARTITION BY series ORDER BY ts, tick_id)"""))
def candle_shape(spark, sf):
    """S11 shape rule on a price path: open = previous price, high/low bound both."""
    return C.candle_shape(ticks(spark, sf))


@query("growth_index", _sql(_C, """
SELECT series, open_time, close,
       round(100.0 * exp(sum(coalesce(ln(close / lag_close), 0.0)) OVER (
           PARTITION BY series ORDER BY open_time ROWS UNBOUNDED PRECEDING)), 4) AS growth_index
FROM (SELECT *, lag(close) OVER (PARTITION BY series ORDER BY open_time) AS lag_close
      FROM candles)"""))
def growth_index(spark, sf):
    """Compounded growth index (base 100) from log returns."""
    return C.growth_index(_candles(spark, sf))


def _roundtrip_name(spark, name):
    """A fresh table per call: a fixed name would clash with a location left
    in the warehouse by another session, and a later call would overwrite the
    table an earlier (lazy) result still reads."""
    import uuid

    sinks.create_namespaces(spark, ["bronze"])
    return f"bronze.{name}_{uuid.uuid4().hex[:12]}"


@query("sink_overwrite_roundtrip", _sql(_C, "SELECT * FROM candles"))
def sink_overwrite_roundtrip(spark, sf):
    """Overwrite a managed table twice, read it back."""
    name = _roundtrip_name(spark, "candles_overwrite")
    c = _candles(spark, sf)
    sinks.write_table(c.filter(F.col("open_time") < F.lit(CUT).cast("timestamp_ntz")), name,
                      "overwrite")
    sinks.write_table(c, name, "overwrite")
    return spark.table(name)


@query("sink_append_roundtrip", _sql(_C, "SELECT * FROM candles"))
def sink_append_roundtrip(spark, sf):
    """Overwrite with the first part, append the rest (by column name)."""
    name = _roundtrip_name(spark, "candles_append")
    c = _candles(spark, sf)
    cut = F.lit(CUT).cast("timestamp_ntz")
    sinks.write_table(c.filter(F.col("open_time") < cut), name, "overwrite")
    rest = c.filter(F.col("open_time") >= cut)
    sinks.write_table(rest.select(*reversed(rest.columns)), name, "append")
    return spark.table(name)


# ------------------------------------------------------------ 2.2 cleaning, predicates

@query("clean_dedup", _sql(O.TICKS, """
SELECT series, ts, tick_id, price FROM (
  SELECT *, row_number() OVER (PARTITION BY series, ts ORDER BY tick_id) AS rn FROM ticks)
WHERE rn = 1"""))
def clean_dedup(spark, sf):
    """One row per (series, time), lowest id first."""
    return CL.dedup_first(ticks(spark, sf), ["series", "ts"], ["tick_id"])


@query("clean_valid", _sql(O.tick_clean(), "SELECT series, open_time, tick_id, close, volume FROM clean"))
def clean_valid(spark, sf):
    """P4+P5: de-duplicate, then close > 0 and volume >= 0 (NaN rejected)."""
    c = CL.clean_candles(_tick_candles(spark, sf), ["series"], TICK_ORDER)
    return c.select("series", "open_time", "tick_id", "close", "volume")


@query("features", _sql(_FEAT, f"SELECT {O.FEATURE_SELECT}, rsi_14 FROM features"))
def features(spark, sf):
    """The feature table (silver): 20 reference columns per series over
    1-hour candles, RSI seeded after the 24-row trim."""
    return _features(spark, sf)


@query("features_trimmed",_sql(_FEAT, """
SELECT c.series, c.rows_in, coalesce(f.rows_out, 0) AS rows_out,
       c.rows_in - coalesce(f.rows_out, 0) AS rows_trimmed
FROM (SELECT series, count(*) AS rows_in FROM clean GROUP BY series) c
LEFT JOIN (SELECT series, count(*) AS rows_out FROM features GROUP BY series) f
  ON f.series = c.series"""))
def features_trimmed(spark, sf):
    """Rows kept and trimmed by the not-null filters, per series."""
    cin = CL.clean_candles(_candles(spark, sf)).groupBy("series").agg(
        F.count(F.lit(1)).alias("rows_in"))
    out = _features(spark, sf).groupBy("series").agg(F.count(F.lit(1)).alias("rows_out"))
    j = cin.join(out, "series", "left")
    ro = F.coalesce(F.col("rows_out"), F.lit(0).cast("bigint"))
    return j.select("series", "rows_in", ro.alias("rows_out"),
                    (F.col("rows_in") - ro).alias("rows_trimmed"))


@query("ml_dropna", _sql(_FEAT + _mf(), f"""
SELECT series, count(*) AS rows_before,
       count(*) FILTER (WHERE {_NOTNULL}) AS rows_after,
       count(*) FILTER (WHERE NOT ({_NOTNULL})) AS rows_dropped
FROM tgt GROUP BY series"""))
def ml_dropna(spark, sf):
    """Rows before/after dropping rows with a missing model input or target."""
    t = ml.with_target(_features(spark, sf, keep_position=True))
    return CL.dropna_report(t, [*MODEL_INPUTS, "target"], ["series"])


_IMPUTE = ["returns", "volatility_24", "lag_1", "lag_24"]


@query("median_impute", _sql(_W, f"""
SELECT w.series, w.open_time,
       {', '.join(f"round(coalesce(w.{c}, m.{c}), 6) AS {c}" for c in _IMPUTE)}
FROM win w JOIN (SELECT series, {', '.join(f'median({c}) AS {c}' for c in _IMPUTE)}
                 FROM win GROUP BY series) m ON m.series = w.series"""))
def median_impute(spark, sf):
    """Fill missing window values with the exact per-series median."""
    x = _untrimmed(spark, sf).select("series", "open_time", *_IMPUTE)
    filled = CL.median_impute(x, _IMPUTE, ["series"])
    return filled.select("series", "open_time", *[F.round(c, 6).alias(c) for c in _IMPUTE])


_BOUND = """,
bound AS (SELECT series, max(open_time) - INTERVAL 30 DAY AS since FROM features GROUP BY series)"""


@query("recent_30d_features", _sql(_FEAT + _BOUND, """
SELECT f.series, f.open_time, f.close, f.volume, f.rsi_14
FROM features f JOIN bound b ON b.series = f.series WHERE f.open_time >= b.since"""))
def recent_30d_features(spark, sf):
    """Feature rows within 30 days of the newest one."""
    f = _features(spark, sf)
    return D.recent(f, D.recent_bound(f)).select("series", "open_time", "close", "volume",
                                                 "rsi_14")


@query("recent_30d_predictions", _sql(_SIMPLE + _BOUND, """
SELECT p.series, p.open_time, p.actual, p.predicted
FROM preds p JOIN bound b ON b.series = p.series WHERE p.open_time >= b.since"""))
def recent_30d_predictions(spark, sf):
    """Predictions within the bound taken from the feature table."""
    f = _features(spark, sf, keep_position=True)
    g = _simple(spark, sf, features=f)
    return D.recent(g.predictions, D.recent_bound(f)).select("series", "open_time", "actual",
                                                             "predicted")


@query("candle_colour", _sql(_FEAT + _BOUND, """
SELECT f.series, f.open_time, f.open, f.close, f.volume,
       CASE WHEN f.close >= f.open THEN 'green' ELSE 'red' END AS colour
FROM features f JOIN bound b ON b.series = f.series WHERE f.open_time >= b.since"""))
def candle_colour(spark, sf):
    """P10/V7: volume bars coloured by candle direction, recent window."""
    f = _features(spark, sf)
    return D.candle_colour(D.recent(f, D.recent_bound(f)))


@query("rsi_zones", _sql(_FEAT + _BOUND, """
SELECT f.series, f.open_time, f.rsi_14,
       CASE WHEN f.rsi_14 >= 70 THEN 'overbought' WHEN f.rsi_14 <= 30 THEN 'oversold'
            WHEN f.rsi_14 IS NOT NULL THEN 'neutral' END AS zone
FROM features f JOIN bound b ON b.series = f.series WHERE f.open_time >= b.since"""))
def rsi_zones(spark, sf):
    """RSI with overbought/oversold zones, recent window."""
    f = _features(spark, sf)
    return D.rsi_zones(D.recent(f, D.recent_bound(f)))


@query("error_bands", _sql(_SIMPLE, """
SELECT series, open_time, error,
       CASE WHEN error > 0 THEN 'underestimate' WHEN error < 0 THEN 'overestimate'
            WHEN error = 0 THEN 'exact' END AS band
FROM preds"""))
def error_bands(spark, sf):
    """Prediction error with sign bands (labelled by what they mean)."""
    return D.error_bands(_simple(spark, sf).predictions)


# ------------------------------------------------------------------------ 2.3 joins

@query("actual_vs_predicted", _sql(_SIMPLE + _BOUND, """
SELECT f.series, f.open_time, f.close AS actual, p.predicted, p.open_time AS made_at
FROM (SELECT f.* FROM features f JOIN bound b ON b.series = f.series
      WHERE f.open_time >= b.since) f
LEFT JOIN (SELECT p.* FROM preds p JOIN bound b ON b.series = p.series
           WHERE p.open_time >= b.since) p
  ON p.series = f.series AND p.target_time = f.open_time"""))
def actual_vs_predicted(spark, sf):
    """Close overlaid with the prediction made for that hour."""
    f = _features(spark, sf, keep_position=True)
    g = _simple(spark, sf, features=f)
    b = D.recent_bound(f)
    return D.actual_vs_predicted(D.recent(f, b), D.recent(g.predictions, b))


@query("append_new_only", _sql(_C, f"""
SELECT * FROM candles WHERE open_time >= TIMESTAMP '{CUT}'"""))
def append_new_only(spark, sf):
    """A re-delivered batch anti-joined against stored candles."""
    c = _candles(spark, sf)
    stored = c.filter(F.col("open_time") < F.lit(CUT).cast("timestamp_ntz"))
    batch = c.filter(F.col("open_time") >= F.lit(REDELIVER_FROM).cast("timestamp_ntz"))
    return INC.new_only(batch, stored, ["series"], ["open_time"])


# ------------------------------------------------------------------ 2.4 aggregation

@query("profile_raw", _sql(_C, f"""
SELECT series, min(open_time) AS earliest, max(open_time) AS latest, count(*) AS total_rows,
       {_cents_mean_sql('close')} AS avg_price, round(min(close), 2) AS min_price,
       round(max(close), 2) AS max_price, {_cents_mean_sql('volume')} AS avg_volume
FROM candles GROUP BY series"""))
def profile_raw(spark, sf):
    """Raw candle profile per series."""
    c = _candles(spark, sf)
    return c.groupBy("series").agg(
        F.min("open_time").alias("earliest"), F.max("open_time").alias("latest"),
        F.count(F.lit(1)).alias("total_rows"),
        cents_mean(F.sum(cents("close")), F.count("close")).alias("avg_price"),
        F.round(F.min("close"), 2).alias("min_price"),
        F.round(F.max("close"), 2).alias("max_price"),
        cents_mean(F.sum(cents("volume")), F.count("volume")).alias("avg_volume"))


_EV_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query("profile_nulls", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in _EV_COLS) + " FROM events")
def profile_nulls(spark, sf):
    """A3: NULL count of every column in one scan."""
    ev = load(spark, sf, "events")
    return ev.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in _EV_COLS])


@query("profile_duplicates", _sql(O.TICKS, """
SELECT series, count(*) AS total_rows, count(DISTINCT ts) AS distinct_times,
       count(ts) - count(DISTINCT ts) AS duplicate_rows
FROM ticks GROUP BY series"""))
def profile_duplicates(spark, sf):
    """A4: rows with a time minus distinct times per series."""
    t = ticks(spark, sf)
    return t.groupBy("series").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("ts").alias("distinct_times"),
        (F.count("ts") - F.count_distinct("ts")).alias("duplicate_rows"))


@query("profile_price_stats", _sql(_C, f"""
SELECT series, {_cents_mean_sql('close')} AS mean, round(stddev_samp(close), 2) AS stddev,
       round(min(close), 2) AS min, round(max(close), 2) AS max
FROM candles GROUP BY series"""))
def profile_price_stats(spark, sf):
    """A5: mean, sample stddev, min, max of close per series."""
    c = _candles(spark, sf)
    return c.groupBy("series").agg(
        cents_mean(F.sum(cents("close")), F.count("close")).alias("mean"),
        F.round(F.stddev_samp("close"), 2).alias("stddev"),
        F.round(F.min("close"), 2).alias("min"), F.round(F.max("close"), 2).alias("max"))


@query("profile_features", _sql(_FEAT, f"""
SELECT series, min(open_time) AS earliest, max(open_time) AS latest, count(*) AS total_rows,
       {_cents_mean_sql('close')} AS avg_close, {_cents_mean_sql('rsi_14')} AS avg_rsi,
       {_cents_mean_sql('ma_24')} AS avg_ma24, {_micros_mean_sql('returns')} AS avg_return
FROM features GROUP BY series"""))
def profile_features(spark, sf):
    """Feature table profile per series (averages exact on the stored decimals)."""
    f = _features(spark, sf)
    micros = F.round(F.col("returns") * 1_000_000).cast("bigint")
    return f.groupBy("series").agg(
        F.min("open_time").alias("earliest"), F.max("open_time").alias("latest"),
        F.count(F.lit(1)).alias("total_rows"),
        cents_mean(F.sum(cents("close")), F.count("close")).alias("avg_close"),
        cents_mean(F.sum(cents("rsi_14")), F.count("rsi_14")).alias("avg_rsi"),
        cents_mean(F.sum(cents("ma_24")), F.count("ma_24")).alias("avg_ma24"),
        micros_mean(F.sum(micros), F.count("returns")).alias("avg_return"))


_NANCELL = " + ".join(f"CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) THEN 1 ELSE 0 END"
                      for c in [*MODEL_INPUTS, "target"])


@query("profile_nan_total", _sql(_FEAT + _mf(), f"""
SELECT series, CAST(sum({_NANCELL}) AS BIGINT) AS missing_cells,
       count(*) FILTER (WHERE NOT ({_NOTNULL})) AS rows_with_missing
FROM tgt GROUP BY series"""))
def profile_nan_total(spark, sf):
    """Missing (NULL or NaN) cells over the model inputs and target."""
    t = ml.with_target(_features(spark, sf, keep_position=True))
    cols = [*MODEL_INPUTS, "target"]
    cell = sum((F.when(F.col(c).isNull() | F.isnan(F.col(c)), 1).otherwise(0) for c in cols),
               F.lit(0))
    return t.groupBy("series").agg(F.sum(cell).cast("bigint").alias("missing_cells"),
                                   F.count_if(CL.null_mask(cols)).alias("rows_with_missing"))


@query("eval_metrics", _sql(_SIMPLE, """
SELECT series, split, rows, round(rmse, 4) AS rmse, round(mae, 4) AS mae,
       round(r2, 6) AS r2, round(mape, 4) AS mape
FROM sc"""))
def eval_metrics(spark, sf):
    """RMSE, MAE, R2 (1 - SSE/SST) and MAPE per series and split."""
    sc = ml.scores(_simple(spark, sf).scored)
    return sc.select("series", "split", "rows", F.round("rmse", 4).alias("rmse"),
                     F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
                     F.round("mape", 4).alias("mape"))


@query("metrics_kpi", _sql(_SIMPLE, """
SELECT series, run_id, metric, round(value, 6) AS value FROM (
  SELECT series, run_id, 'r2_test' AS metric, r2 AS value FROM metrics
  UNION ALL SELECT series, run_id, 'r2_train', r2_train FROM metrics
  UNION ALL SELECT series, run_id, 'accuracy', 1 - mape / 100 FROM metrics)"""))
def metrics_kpi(spark, sf):
    """R2 test, R2 train and 1 - MAPE/100 in long form."""
    return D.metrics_kpi(_simple(spark, sf).metrics)


# ---------------------------------------------------------------------- 2.5 windows

@query("lag_features", _sql(_W, "SELECT series, open_time, close, lag_1, lag_3, lag_6, lag_24 FROM win"))
def lag_features(spark, sf):
    """Lags 1, 3, 6, 24 over halo blocks."""
    return _untrimmed(spark, sf).select("series", "open_time", "close", "lag_1", "lag_3",
                                        "lag_6", "lag_24")


@query("log_returns", _sql(_W, "SELECT series, open_time, close, returns FROM win"))
def log_returns(spark, sf):
    """round(ln(close / previous close), 6)."""
    return _untrimmed(spark, sf).select("series", "open_time", "close", "returns")


for _n in (7, 24, 168):
    def _ma(spark, sf, _c=f"ma_{_n}"):
        return _untrimmed(spark, sf).select("series", "open_time", "close", _c)
    _ma.__doc__ = f"W4-W6: {_n}-row moving average, exact to the cent."
    query(f"ma_{_n}", _sql(_W, f"SELECT series, open_time, close, ma_{_n} FROM win"))(_ma)


@query("volatility_24", _sql(_W, "SELECT series, open_time, close, volatility_24 FROM win"))
def volatility_24(spark, sf):
    """24-row sample standard deviation of close."""
    return _untrimmed(spark, sf).select("series", "open_time", "close", "volatility_24")


@query("lag_fallback", _sql(_W, """
SELECT series, open_time, close,
       coalesce(lag_24, first_value(close) OVER (PARTITION BY series ORDER BY pos)) AS lag_24_fb
FROM win"""))
def lag_fallback(spark, sf):
    """Lag 24, or the oldest close when the history is shorter."""
    x = P.halo_blocks(P.with_position(CL.clean_candles(_candles(spark, sf)), ["series"],
                                      ["open_time"], with_length=False), ["series"],
                      P.DEFAULT_BLOCK_ROWS, back=24)
    w = P.block_window(["series"])
    first_w = w.rowsBetween(Window.unboundedPreceding, 0)
    x = x.select("*", lag_with_fallback(w, first_w, 24).alias("lag_24_fb"))
    return P.home_rows(x, P.DEFAULT_BLOCK_ROWS).select("series", "open_time", "close",
                                                        "lag_24_fb")


@query("price_delta", _sql(_W, "SELECT series, open_time, close, delta FROM win"))
def price_delta(spark, sf):
    """First difference of close."""
    return _untrimmed(spark, sf).select("series", "open_time", "close",
                                        F.col("_delta").alias("delta"))


_TICK_W = O.windowed_cte(O.tick_clean())


@query("rsi_14", _sql(_TICK_W + O.rsi_cte("win", 0), """
SELECT w.series, w.open_time, w.tick_id, w.close, r.rsi_14
FROM win w LEFT JOIN rsi r ON r.series = w.series AND r.pos = w.pos"""))
def rsi_14(spark, sf):
    """RSI-14 over every tick of each event type (seeded at the second tick)."""
    x = windowed(_tick_candles(spark, sf), ["series"], TICK_ORDER)
    x = with_rsi(x, ["series"], "_delta", 0, P.DEFAULT_BLOCK_ROWS)
    return x.select("series", "open_time", "tick_id", "close", "rsi_14")


EWM_COM = 9.0


@query("ewm_mean", _sql(O.tick_clean() + f""",
ewm_rec AS (
  SELECT series, pos, close AS y FROM posd WHERE pos = 0
  UNION ALL
  SELECT p.series, p.pos, r.y * (1.0 - 1.0 / (1 + {EWM_COM})) + p.close * (1.0 / (1 + {EWM_COM}))
  FROM ewm_rec r JOIN posd p ON p.series = r.series AND p.pos = r.pos + 1
)""", """
SELECT p.series, p.open_time, p.tick_id, p.close, round(e.y, 6) AS ewm
FROM posd p JOIN ewm_rec e ON e.series = p.series AND e.pos = p.pos"""))
def ewm_mean(spark, sf):
    """Exponential mean (com = 9, non-adjusted) of tick prices as a block scan."""
    c = CL.clean_candles(_tick_candles(spark, sf), ["series"], TICK_ORDER)
    x = P.home_rows(P.halo_blocks(P.with_position(c, ["series"], TICK_ORDER, with_length=False),
                                  ["series"], P.DEFAULT_BLOCK_ROWS), P.DEFAULT_BLOCK_ROWS)
    x = ewm(x, ["series"], {"ewm": "close"}, com=EWM_COM, seed_pos=0,
            block_rows=P.DEFAULT_BLOCK_ROWS)
    return x.select("series", "open_time", "tick_id", "close", F.round("ewm", 6).alias("ewm"))


@query("ml_target", _sql(_FEAT + _mf(), "SELECT series, open_time, close, target, target_time FROM tgt"))
def ml_target(spark, sf):
    """Next row's close (and time) as the target."""
    return ml.with_target(_features(spark, sf, keep_position=True)).select("series", "open_time", "close", "target",
                                                       "target_time")


@query("time_split", _sql(_FEAT + _mf(), "SELECT series, open_time, split FROM mf"))
def time_split(spark, sf):
    """First floor(0.8 n) model rows of each series train, the rest test."""
    return _frame(spark, sf).select("series", "open_time", "split")


@query("tail_168", _sql(_FEAT, """
SELECT series, open_time, close, ma_24, rsi_14 FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY open_time DESC) AS rn FROM features)
WHERE rn <= 168"""))
def tail_168(spark, sf):
    """Last 168 feature rows per series."""
    return D.last_rows(_features(spark, sf), 168).select("series", "open_time", "close",
                                                          "ma_24", "rsi_14")


@query("latest_candle", _sql(_C, """
SELECT series, open_time, open, high, low, close, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY open_time DESC) AS rn FROM candles)
WHERE rn = 1"""))
def latest_candle(spark, sf):
    """Newest candle per series."""
    return D.latest(_candles(spark, sf), order=["open_time"])


_LATEST_COLS = "series, run_id, rmse, mae, r2, mape, r2_train, train_rows, test_rows"


@query("latest_metrics", _sql(_FEAT + _simple_sql("r1", 0.7, "_1") + _simple_sql("r2", 0.8, "_2"),
                              f"""
SELECT {_LATEST_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY created_at DESC, run_id DESC) AS rn
  FROM (SELECT * FROM metrics_1 UNION ALL SELECT * FROM metrics_2))
WHERE rn = 1"""))
def latest_metrics(spark, sf):
    """Newest metrics row per series across two runs."""
    f = _features(spark, sf, keep_position=True)
    m1 = _simple(spark, sf, "r1", 0.7, features=f).metrics
    m2 = _simple(spark, sf, "r2", 0.8, features=f).metrics
    both = m1.unionByName(m2)
    return D.latest(both).select(*[c.strip() for c in _LATEST_COLS.split(",")])


# --------------------------------------------------------------- 2.6 sorts and limits

@query("tail_5", _sql(_FEAT, """
SELECT series, open_time, open, high, low, close, volume, rsi_14, ma_24 FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY open_time DESC) AS rn FROM features)
WHERE rn <= 5"""))
def tail_5(spark, sf):
    """T4: ORDER BY open_time DESC LIMIT 5, per series."""
    return D.last_rows(_features(spark, sf), 5).select(
        "series", "open_time", "open", "high", "low", "close", "volume", "rsi_14", "ma_24")


@query("head_tail_3", _sql(_C, """
SELECT series, open_time, close, part FROM (
  SELECT *, 'head' AS part, row_number() OVER (PARTITION BY series ORDER BY open_time) AS rn
  FROM candles) WHERE rn <= 3
UNION ALL
SELECT series, open_time, close, part FROM (
  SELECT *, 'tail' AS part, row_number() OVER (PARTITION BY series ORDER BY open_time DESC) AS rn
  FROM candles) WHERE rn <= 3"""))
def head_tail_3(spark, sf):
    """T5: first and last three candles per series."""
    c = _candles(spark, sf)
    h = D.first_rows(c, 3).select("series", "open_time", "close", F.lit("head").alias("part"))
    t = D.last_rows(c, 3).select("series", "open_time", "close", F.lit("tail").alias("part"))
    return h.unionByName(t)


# ------------------------------------------------------------- 2.8 scalar functions

@query("time_features", _sql(_C, """
SELECT series, open_time, CAST(hour(open_time) AS INTEGER) AS hour,
       CAST(dayofweek(open_time) + 1 AS INTEGER) AS day_of_week,
       CAST(month(open_time) AS INTEGER) AS month
FROM candles"""))
def time_features(spark, sf):
    """Hour, day of week (1 = Sunday), month."""
    from tidemark.functions.columns import time_parts
    c = _candles(spark, sf)
    parts = time_parts("open_time")
    return c.select("series", "open_time", *[v.alias(k) for k, v in parts.items()])


@query("price_range", _sql(_C, "SELECT series, open_time, high, low, round(high - low, 2) AS price_range FROM candles"))
def price_range_q(spark, sf):
    """round(high - low, 2)."""
    from tidemark.functions.columns import price_range
    c = _candles(spark, sf)
    return c.select("series", "open_time", "high", "low", price_range().alias("price_range"))


@query("next_open_time", _sql(_C, """
SELECT series, max(open_time) AS last_open_time,
       max(open_time) + INTERVAL 1 HOUR AS next_open_time
FROM candles GROUP BY series"""))
def next_open_time(spark, sf):
    """time of the next candle after the newest one."""
    c = _candles(spark, sf)
    return c.groupBy("series").agg(F.max("open_time").alias("last_open_time")).select(
        "series", "last_open_time",
        (F.col("last_open_time") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("next_open_time"))


@query("prediction_errors", _sql(_SIMPLE, """
SELECT series, open_time, actual, predicted, error, pct_error FROM preds"""))
def prediction_errors(spark, sf):
    """error and percentage error from the raw prediction."""
    return _simple(spark, sf).predictions.select("series", "open_time", "actual", "predicted",
                                                 "error", "pct_error")


def _fixed_sql(x: str, decimals: int, from_decimals: int | None = None) -> str:
    if from_decimals is not None and from_decimals > decimals:
        step = 10 ** (from_decimals - decimals)
        v = f"CAST(round({x} * {10 ** from_decimals}) AS BIGINT)"
        q = f"((2 * abs({v}) + {step}) // {2 * step})"
        iv = f"(sign({v}) * {q})"
    else:
        iv = f"CAST(round({x} * {10 ** decimals}) AS BIGINT)"
    unit = 10 ** decimals
    return (f"(CASE WHEN {iv} < 0 THEN '-' ELSE '' END || CAST(abs({iv}) // {unit} AS VARCHAR)"
            f" || '.' || lpad(CAST(abs({iv}) % {unit} AS VARCHAR), {decimals}, '0'))")


@query("metrics_panel_text", _sql(_SIMPLE, f"""
SELECT series, run_id,
       'Model: ' || model || chr(10) ||
       'RMSE: ' || {_fixed_sql('rmse', 2, 4)} || chr(10) ||
       'MAE: ' || {_fixed_sql('mae', 2, 4)} || chr(10) ||
       'R2 Score: ' || {_fixed_sql('r2', 4, 6)} || chr(10) ||
       'MAPE: ' || {_fixed_sql('mape', 4)} || '%' || chr(10) ||
       'Train Rows: ' || CAST(train_rows AS VARCHAR) || chr(10) ||
       'Test Rows: ' || CAST(test_rows AS VARCHAR) AS panel
FROM metrics"""))
def metrics_panel_text(spark, sf):
    """Latest metrics as the panel text (exact decimal formatting)."""
    return D.metrics_panel_text(_simple(spark, sf).metrics)


# ------------------------------------------------------------- 2.9 incremental

def _append(spark, sf):
    c = _candles(spark, sf)
    cut = F.lit(CUT).cast("timestamp_ntz")
    stored = c.filter(F.col("open_time") < cut)
    batch = c.filter(F.col("open_time") >= F.lit(REDELIVER_FROM).cast("timestamp_ntz"))
    state = INC.feature_state(stored)
    return INC.append_candles(stored, batch, state)


@query("incremental_features", _sql(_FEAT, f"""
SELECT {O.FEATURE_SELECT}, rsi_14 FROM features WHERE open_time >= TIMESTAMP '{CUT}'"""))
def incremental_features(spark, sf):
    """Features of appended candles from 167 history rows and the
    carried RSI state; equals the full rebuild on those rows."""
    return _append(spark, sf).features


@query("incremental_rsi", _sql(_W + O.rsi_cte("win", 24) + """,
rsi_means AS (SELECT series, pos, g, l FROM rsi_rec)""", """
SELECT w.series, w.pos AS last_pos, w.open_time AS last_time, w.close AS last_close,
       round(m.g, 8) AS avg_gain, round(m.l, 8) AS avg_loss
FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY pos DESC) AS rn FROM win) w
LEFT JOIN rsi_means m ON m.series = w.series AND m.pos = w.pos
WHERE w.rn = 1"""))
def incremental_rsi(spark, sf):
    """I4: RSI state per series after the append (means carried, not re-seeded)."""
    s = _append(spark, sf).state
    return s.select("series", "last_pos", "last_time", "last_close",
                    F.round("avg_gain", 8).alias("avg_gain"),
                    F.round("avg_loss", 8).alias("avg_loss"))


# -------------------------------------------------------------------- 2.10 ML

@query("ml_prepared", _sql(_FEAT + _mf(), f"""
SELECT series, open_time, {', '.join(MODEL_INPUTS)}, target, split FROM mf"""))
def ml_prepared(spark, sf):
    """M1: target, 19 inputs, dropna, time split (before scaling)."""
    return _frame(spark, sf).select("series", "open_time", *MODEL_INPUTS, "target", "split")


@query("standard_scale", _sql(_FEAT + _mf() + """,
st AS (SELECT series, """ + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in MODEL_INPUTS) + """
       FROM mf WHERE split = 'train' GROUP BY series)""", "SELECT m.series, m.open_time, m.split, " + ", ".join(
    f"round((m.{c} - st.m_{c}) / CASE WHEN st.s_{c} = 0 THEN 1.0 ELSE st.s_{c} END, 6) AS {c}"
    for c in MODEL_INPUTS) + " FROM mf m JOIN st ON st.series = m.series"))
def standard_scale(spark, sf):
    """M3: z-scores with the training mean and population std per series."""
    fr = _frame(spark, sf)
    z = ml.standardize(fr, ml.fit_scaler(fr, MODEL_INPUTS), MODEL_INPUTS)
    return z.select("series", "open_time", "split", *[F.round(c, 6).alias(c) for c in MODEL_INPUTS])


@query("linreg_simple", _sql(_SIMPLE, """
SELECT series, round(slope, 8) AS slope, round(intercept, 6) AS intercept, train_rows FROM sm"""))
def linreg_simple(spark, sf):
    """M4 (one input): least squares of next close on close, per series."""
    m = _simple(spark, sf).model
    return m.select("series", F.round("slope", 8).alias("slope"),
                    F.round("intercept", 6).alias("intercept"), "train_rows")


@query("linreg_predict")
def linreg_predict(spark, sf):
    """M2-M5: OLS on the 19 standardised inputs per series; test predictions."""
    g = _ols(spark, sf)
    return g.scored.filter(F.col("split") == "test").select(
        "series", "open_time", F.col("target").alias("actual"),
        F.round("prediction", 2).alias("predicted"))


@query("predictions")
def predictions(spark, sf):
    """M6: gold predictions table of the OLS model."""
    return _ols(spark, sf).predictions


@query("model_metrics")
def model_metrics(spark, sf):
    """M7: gold metrics table of the OLS model, one row per series."""
    return _ols(spark, sf).metrics


# ------------------------------------------------------------- 2.11 serving

@query("chart_full_test", _sql(_SIMPLE, """
SELECT series, open_time, actual, predicted, round(actual - predicted, 2) AS gap FROM preds"""))
def chart_full_test(spark, sf):
    """V1: actual vs predicted over the whole test part, with the gap."""
    return D.full_test_chart(_simple(spark, sf).predictions)


@query("chart_last_7d", _sql(_SIMPLE, """
SELECT series, open_time, actual, predicted FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY open_time DESC) AS rn FROM preds)
WHERE rn <= 168"""))
def chart_last_7d(spark, sf):
    """V2: last 168 prediction rows per series."""
    p = _simple(spark, sf).predictions
    return D.last_rows(p, 168).select("series", "open_time", "actual", "predicted")


@query("dashboard_panels", _sql(_SIMPLE + _BOUND + """,
rf AS (SELECT f.* FROM features f JOIN bound b ON b.series = f.series WHERE f.open_time >= b.since),
rp AS (SELECT p.* FROM preds p JOIN bound b ON b.series = p.series WHERE p.open_time >= b.since),
avp AS (SELECT rf.series FROM rf LEFT JOIN rp
        ON rp.series = rf.series AND rp.target_time = rf.open_time)""", """
SELECT series, count(*) AS rows, 'actual_vs_predicted' AS panel FROM avp GROUP BY series
UNION ALL SELECT series, count(*), 'rsi' FROM rf GROUP BY series
UNION ALL SELECT series, count(*), 'volume' FROM rf GROUP BY series
UNION ALL SELECT series, count(*), 'metrics' FROM metrics GROUP BY series"""))
def dashboard_panels(spark, sf):
    """V9: the four dashboard panels; row count per panel and series."""
    f = _features(spark, sf, keep_position=True)
    g = _simple(spark, sf, features=f)
    d = D.run_dashboard(f, g.predictions, g.metrics)
    parts = [("actual_vs_predicted", d.actual_vs_predicted), ("rsi", d.rsi),
             ("volume", d.volume), ("metrics", d.metrics)]
    out = None
    for name, df in parts:
        c = df.groupBy("series").agg(F.count(F.lit(1)).alias("rows")).withColumn(
            "panel", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out


# ------------------------------------------------------- long and many series

@query("tick_features", _sql(O.features_cte(O.tick_clean()), f"""
SELECT series, tick_id, {O.FEATURE_SELECT.replace('series, ', '')}, rsi_14 FROM features"""))
def tick_features(spark, sf):
    """The feature table over every tick of each event type (long series)."""
    return build_features(_tick_candles(spark, sf), order=TICK_ORDER)


@query("user_features", _sql(O.features_cte(O.tick_clean("user_id")), f"""
SELECT series, tick_id, {O.FEATURE_SELECT.replace('series, ', '')}, rsi_14 FROM features"""))
def user_features(spark, sf):
    """The feature table with one series per user (many short series)."""
    return build_features(_tick_candles(spark, sf, "user_id"), order=TICK_ORDER)


@query("order_features", _sql(O.features_cte(O.order_clean()), f"""
SELECT series, tick_id, {O.FEATURE_SELECT.replace('series, ', '')}, rsi_14 FROM features"""))
def order_features(spark, sf):
    """The feature table over all orders as one series (several halo blocks)."""
    return build_features(ticks_as_candles(order_ticks(spark, sf)), order=TICK_ORDER)


# these modules register their queries themselves
from tidemark.plans import stored_queries as _stored_queries  # noqa: E402,F401
from tidemark.streaming import queries as _streaming_queries  # noqa: E402,F401
from tidemark.plans import scale_queries as _scale_queries  # noqa: E402,F401
