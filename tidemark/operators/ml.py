"""Next-step regression on the feature table, per series, on executors.

The reference pulls the whole table to the driver, scales with the training
mean and population standard deviation, and fits ordinary least squares. The
same model is built here from aggregates:

1. ``model_frame``   target = next close (a lead over halo blocks), rows with
                     a missing input dropped, time-ordered 80/20 split by
                     position (no window over a whole series).
2. ``fit_scaler``    mean and population std of every input on training rows.
3. ``fit_ols``       one grouped aggregate of the centred cross products
                     Z'Z and Z'y (map-side partial sums, so a hot series costs
                     one partial row per task), then a tiny per-series solve
                     with NumPy's least squares in ``applyInPandas`` over one
                     row per series. Rank-deficient inputs (``open`` vs
                     ``lag_1``, ``price_range`` vs ``high - low``) get the
                     minimum-norm solution; predictions are unique anyway.
4. ``predict``       a dot product in Spark SQL after a join on the series.

``fit_mllib`` is the stock ``pyspark.ml`` pipeline for one series, kept as a
cross-check.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import q, sql_cols
from tidemark.operators import positions as P
from tidemark.operators.clean import drop_incomplete

TRAIN_FRACTION = 0.80


def with_target(features: DataFrame, keys: Sequence[str] = ("series",),
                order: Sequence[str] = ("open_time",), close: str = "close",
                block_rows: int = P.DEFAULT_BLOCK_ROWS, bucket_unit: str = "auto") -> DataFrame:
    """Features + ``target`` (next row's close) and ``target_time``: a lead
    over halo blocks with one row of look-ahead."""
    keys, order = list(keys), list(order)
    time = order[0]
    if P.POS in features.columns:
        x = features          # positions kept from the feature plan: no renumbering
    else:
        x = P.with_position(features, keys, order, bucket_unit=bucket_unit, with_length=False)
    x = P.halo_blocks(x, keys, block_rows, back=0, fwd=1)
    w = P.block_window(keys)
    x = x.select("*", F.lead(close, 1).over(w).alias("target"),
                 F.lead(time, 1).over(w).alias("target_time"))
    return P.home_rows(x, block_rows).drop(P.POS, P.BLK)


def time_split(frame: DataFrame, keys: Sequence[str] = ("series",),
               order: Sequence[str] = ("open_time",), train_fraction: float = TRAIN_FRACTION,
               bucket_unit: str = "auto") -> DataFrame:
    """``split`` = train for the first ``floor(n * fraction)`` rows of each
    series by ``order``, test after; positions come from bucket counts, so no
    window spans a series. Never a random split."""
    x = P.with_position(frame, list(keys), list(order), bucket_unit=bucket_unit,
                        with_length=True)
    n_train = F.floor(F.col(P.SLEN) * F.lit(train_fraction))
    return (x.withColumn("split", F.when(F.col(P.POS) < n_train, "train").otherwise("test"))
             .drop(P.POS, P.SLEN))


def model_frame(features: DataFrame, inputs: Sequence[str], keys: Sequence[str] = ("series",),
                order: Sequence[str] = ("open_time",), close: str = "close",
                train_fraction: float = TRAIN_FRACTION,
                block_rows: int = P.DEFAULT_BLOCK_ROWS, bucket_unit: str = "auto") -> DataFrame:
    """Features + ``target``, ``target_time``, ``split`` (M1).

    Rows missing any input or the target are dropped first; the first
    ``floor(n * train_fraction)`` remaining rows of a series are ``train``.
    """
    x = with_target(features, keys, order, close, block_rows, bucket_unit)
    x = drop_incomplete(x, [*inputs, "target"])
    return time_split(x, keys, order, train_fraction, bucket_unit)


def fit_scaler(frame: DataFrame, inputs: Sequence[str], keys: Sequence[str] = ("series",)) -> DataFrame:
    """Per series: training mean and population std of each input."""
    train = frame.filter(F.col("split") == "train")
    aggs = {}
    for c in inputs:
        aggs[f"mean_{c}"] = f"avg({q(c)})"
        aggs[f"std_{c}"] = f"stddev_pop({q(c)})"
    return train.groupBy(*keys).agg(*sql_cols(aggs))


def standardize(frame: DataFrame, scaler: DataFrame, inputs: Sequence[str],
                keys: Sequence[str] = ("series",), suffix: str = "") -> DataFrame:
    """z = (x - mean) / std with the training statistics; a zero std scales
    by 1 (the column is constant on the training rows)."""
    j = frame.join(scaler, list(keys), "left")
    zs = {}
    for c in inputs:
        sd = q(f"std_{c}")
        zs[c + suffix] = (f"({q(c)} - {q(f'mean_{c}')}) / "
                          f"CASE WHEN {sd} = 0 THEN 1.0D ELSE {sd} END")
    keep = [c for c in frame.columns if c not in inputs or suffix]
    return j.select(*keep, *sql_cols(zs))


def _solve(n_inputs: int, keys: Sequence[str]):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        n = float(row["_n"])
        mz = np.array([row[f"_sz{i}"] for i in range(n_inputs)]) / n
        my = row["_sy"] / n
        zz = np.empty((n_inputs, n_inputs))
        for i in range(n_inputs):
            for j in range(i, n_inputs):
                zz[i, j] = zz[j, i] = row[f"_zz{i}_{j}"] - n * mz[i] * mz[j]
        zy = np.array([row[f"_zy{i}"] for i in range(n_inputs)]) - n * mz * my
        beta, *_ = np.linalg.lstsq(zz, zy, rcond=1e-10)
        out = {k: [row[k]] for k in keys}
        out["intercept"] = [float(my - mz @ beta)]
        for i in range(n_inputs):
            out[f"coef_{i}"] = [float(beta[i])]
        out["train_rows"] = [int(n)]
        return pd.DataFrame(out)
    return solve


def fit_ols(z: DataFrame, inputs: Sequence[str], keys: Sequence[str] = ("series",),
            target: str = "target") -> DataFrame:
    """Least-squares coefficients per series from training rows.

    One aggregate of sums and cross products (``k(k+1)/2 + 2k + 2`` numbers per
    series), then a per-series solve over that one-row-per-series table.
    """
    keys = list(keys)
    k = len(inputs)
    train = z.filter(F.col("split") == "train")
    y = q(target)
    aggs = {"_n": "count(1)", "_sy": f"sum({y})"}
    for i, c in enumerate(inputs):
        aggs[f"_sz{i}"] = f"sum({q(c)})"
        aggs[f"_zy{i}"] = f"sum({q(c)} * {y})"
        for j in range(i, k):
            aggs[f"_zz{i}_{j}"] = f"sum({q(c)} * {q(inputs[j])})"
    sums = train.groupBy(*keys).agg(*sql_cols(aggs))
    key_fields = [f for f in sums.schema.fields if f.name in keys]
    schema = T.StructType(key_fields + [T.StructField("intercept", T.DoubleType())]
                          + [T.StructField(f"coef_{i}", T.DoubleType()) for i in range(k)]
                          + [T.StructField("train_rows", T.LongType())])
    return sums.groupBy(*keys).applyInPandas(_solve(k, keys), schema)


def linear_prediction(coef_prefix: str, inputs: Sequence[str]) -> Column:
    """intercept + sum of coef_i * input_i, added left to right."""
    terms = [q("intercept")] + [f"{q(f'{coef_prefix}{i}')} * {q(c)}"
                                for i, c in enumerate(inputs)]
    return F.expr(" + ".join(terms))


def predict(z: DataFrame, model: DataFrame, inputs: Sequence[str],
            keys: Sequence[str] = ("series",), out: str = "prediction") -> DataFrame:
    """Raw (unrounded) prediction per row; the model table has one row per
    series. Rows of a series without a fit stay, with a NULL prediction."""
    j = z.join(model.drop("train_rows"), list(keys), "left")
    return j.select(*z.columns, linear_prediction("coef_", inputs).alias(out))


def fit_simple(frame: DataFrame, x: str = "close", keys: Sequence[str] = ("series",),
               target: str = "target") -> DataFrame:
    """One-input least squares per series (``regr_slope`` / ``regr_intercept``)
    on the training rows: a model SQL can recompute exactly."""
    train = frame.filter(F.col("split") == "train")
    return train.groupBy(*keys).agg(
        F.regr_slope(target, x).alias("slope"),
        F.regr_intercept(target, x).alias("intercept"),
        F.count(F.lit(1)).alias("train_rows"))


def predict_simple(frame: DataFrame, model: DataFrame, x: str = "close",
                   keys: Sequence[str] = ("series",), out: str = "prediction") -> DataFrame:
    j = frame.join(model.drop("train_rows"), list(keys), "left")
    return j.select(*frame.columns, (F.col("intercept") + F.col("slope") * F.col(x)).alias(out))


def scores(pred: DataFrame, keys: Sequence[str] = ("series",), actual: str = "target",
           prediction: str = "prediction") -> DataFrame:
    """Per series and split: rows, RMSE, MAE, R2 = 1 - SSE/SST, MAPE (%).

    SST is ``var_pop * n`` (a stable one-pass aggregate); R2 is not
    ``regr_r2``, which is a squared correlation.
    """
    e = F.col(actual) - F.col(prediction)
    return pred.groupBy(*keys, "split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(actual) * F.count(actual))).alias("r2"),
        (F.avg(F.abs(F.try_divide(e, F.col(actual)))) * 100).alias("mape"),
    )


def metrics_table(sc: DataFrame, run_id: Column, model_name: str, n_features: int,
                  feature_list: Sequence[str], keys: Sequence[str] = ("series",),
                  created_at: Column | None = None) -> DataFrame:
    """One row per series: test scores, training R2, row counts (M7)."""
    test = sc.filter(F.col("split") == "test").alias("t")
    train = sc.filter(F.col("split") == "train").alias("r")
    j = test.join(train, list(keys), "left")
    return j.select(
        *[F.col(f"t.{k}").alias(k) for k in keys],
        run_id.alias("run_id"), F.lit(model_name).alias("model"),
        F.round("t.rmse", 4).alias("rmse"), F.round("t.mae", 4).alias("mae"),
        F.round("t.r2", 6).alias("r2"), F.round("t.mape", 4).alias("mape"),
        F.round("r.r2", 6).alias("r2_train"),
        F.col("r.rows").alias("train_rows"), F.col("t.rows").alias("test_rows"),
        F.lit(n_features).cast("bigint").alias("features"),
        F.array(*[F.lit(c) for c in feature_list]).alias("feature_list"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
    )


def prediction_table(pred: DataFrame, run_id: Column, model_name: str,
                     keys: Sequence[str] = ("series",), created_at: Column | None = None,
                     actual: str = "target", prediction: str = "prediction") -> DataFrame:
    """Test rows as the gold predictions table (M6).

    ``error`` is rounded from the raw prediction, not from the rounded one.
    ``open_time`` is the feature row's time; the target's own time is kept
    as ``target_time``.
    """
    y, p = F.col(actual), F.col(prediction)
    return pred.filter(F.col("split") == "test").select(
        *keys, "open_time", "target_time",
        y.alias("actual"),
        F.round(p, 2).alias("predicted"),
        F.round(y - p, 2).alias("error"),
        F.round(F.try_divide(F.abs(y - p), y) * 100, 4).alias("pct_error"),
        run_id.alias("run_id"), F.lit(model_name).alias("model"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
    )


def fit_mllib(frame: DataFrame, inputs: Sequence[str], target: str = "target"):
    """Stock pipeline for one series: assemble, scale, OLS (no penalty).

    Note ``StandardScaler`` divides by the *sample* std; predictions of an OLS
    with intercept do not depend on the scaling, so they agree with
    :func:`fit_ols` up to the solver's tolerance.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.regression import LinearRegression

    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(inputs), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True),
        LinearRegression(featuresCol="_features", labelCol=target, predictionCol="prediction",
                         regParam=0.0, elasticNetParam=0.0, solver="normal"),
    ])
    return pipe.fit(frame.filter(F.col("split") == "train"))
