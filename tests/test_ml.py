"""Regression: distributed normal equations vs brute-force least squares."""

import numpy as np
from pyspark.sql import functions as F

from paths import SF0001, SF001
from tidemark.operators import candles as C
from tidemark.operators import ml
from tidemark.plans import gold as G
from tidemark.plans.features import MODEL_INPUTS, build_features
from tidemark.sources.tables import ticks


def _frame(spark, sf):
    return G.prepare(build_features(C.resample(ticks(spark, sf))), materialize=True)


def test_time_split_counts(spark):
    fr = _frame(spark, SF001).groupBy("series").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "train").alias("tr")).collect()
    for r in fr:
        assert r["tr"] == int(r["n"] * 0.8)


def test_ols_matches_numpy_lstsq(spark):
    fr = _frame(spark, SF001)
    g = G.run_ols(fr, run_id="t")
    got = g.scored.select("series", "open_time", "prediction").toPandas()
    pdf = fr.toPandas()
    for s, part in pdf.groupby("series"):
        part = part.sort_values("open_time")
        tr = part[part["split"] == "train"]
        X = tr[MODEL_INPUTS].to_numpy(float)
        mu, sd = X.mean(0), X.std(0)
        sd[sd == 0] = 1
        Z = np.column_stack([np.ones(len(X)), (X - mu) / sd])
        beta, *_ = np.linalg.lstsq(Z, tr["target"].to_numpy(float), rcond=None)
        Za = np.column_stack([np.ones(len(part)), (part[MODEL_INPUTS].to_numpy(float) - mu) / sd])
        want = Za @ beta
        mine = got[got["series"] == s].sort_values("open_time")["prediction"].to_numpy()
        assert np.max(np.abs(mine - want)) < 1e-6 * max(1.0, np.abs(want).max())


def test_mllib_agrees_with_normal_equations(spark):
    """MLlib's normal solver falls back to L-BFGS on the rank-deficient inputs
    (price_range = high - low), so it agrees to its iteration tolerance only."""
    fr = _frame(spark, SF0001).filter(F.col("series") == "click")
    model = ml.fit_mllib(fr, MODEL_INPUTS)
    a = model.transform(fr).select("open_time", "prediction").toPandas().sort_values("open_time")
    b = G.run_ols(fr, run_id="t").scored.select("open_time", "prediction").toPandas() \
        .sort_values("open_time")
    assert np.max(np.abs(a["prediction"].to_numpy() - b["prediction"].to_numpy())) < 5e-4 * \
        max(1.0, np.abs(b["prediction"]).max())


def test_metrics_table_shape(spark):
    g = G.run_ols(_frame(spark, SF0001), run_id="t")
    m = g.metrics
    assert m.columns[:11] == ["series", "run_id", "model", "rmse", "mae", "r2", "mape",
                              "r2_train", "train_rows", "test_rows", "features"]
    rows = m.collect()
    assert len(rows) == 5 and all(r["features"] == 19 for r in rows)
    p = g.predictions
    assert p.count() == sum(r["test_rows"] for r in rows)
