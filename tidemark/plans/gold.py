"""Gold layer: model frame -> fit -> predictions and metrics tables.

``run_ols``    the reference's model: 19 standardised inputs, OLS, per series.
``run_simple`` next close on close alone (``regr_slope``/``regr_intercept``):
               the same tables from a model SQL can recompute, used by the
               SQL-checked serving queries.

The model frame is read three or four times (scaler, fit, predictions,
scores). ``materialize`` writes it once under the session's checkpoint folder
so those reads do not re-run the feature plan and the lineage is cut.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import ml
from tidemark.plans.features import MODEL_INPUTS
from tidemark.sources.sinks import stage


@dataclass
class GoldResult:
    frame: DataFrame          # model frame with target and split
    model: DataFrame          # one row of coefficients per series
    scored: DataFrame         # every model row with its raw prediction
    predictions: DataFrame    # gold predictions table (test rows)
    metrics: DataFrame        # gold metrics table (one row per series)


def new_run_id() -> str:
    return uuid.uuid4().hex


def prepare(features: DataFrame, keys: Sequence[str] = ("series",),
            inputs: Sequence[str] = MODEL_INPUTS, materialize: bool = False, **kw) -> DataFrame:
    frame = ml.model_frame(features, inputs, keys, **kw)
    return stage(frame, "model_frame") if materialize else frame


def run_ols(frame: DataFrame, keys: Sequence[str] = ("series",),
            inputs: Sequence[str] = MODEL_INPUTS, run_id: str | None = None,
            created_at: Column | None = None) -> GoldResult:
    keys, inputs = list(keys), list(inputs)
    zcols = [f"{c}_z" for c in inputs]
    scaler = ml.fit_scaler(frame, inputs, keys)
    z = ml.standardize(frame, scaler, inputs, keys, suffix="_z")
    model = ml.fit_ols(z, zcols, keys)
    scored = ml.predict(z, model, zcols, keys).drop(*zcols)
    return _tables(frame, model, scored, keys, run_id, "LinearRegression", inputs, created_at)


def run_simple(frame: DataFrame, keys: Sequence[str] = ("series",), x: str = "close",
               run_id: str | None = None, created_at: Column | None = None) -> GoldResult:
    keys = list(keys)
    model = ml.fit_simple(frame, x, keys)
    scored = ml.predict_simple(frame, model, x, keys)
    return _tables(frame, model, scored, keys, run_id, "SimpleRegression", [x], created_at)


def _tables(frame, model, scored, keys, run_id, name, inputs, created_at) -> GoldResult:
    rid = F.lit(run_id or new_run_id())
    preds = ml.prediction_table(scored, rid, name, keys, created_at)
    metrics = ml.metrics_table(ml.scores(scored, keys), rid, name, len(inputs), inputs,
                               keys, created_at)
    return GoldResult(frame, model, scored, preds, metrics)
