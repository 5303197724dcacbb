"""Least squares from mergeable states.

A state is one row: ``n``, the mean of every column and the co-moments (sums of
products of deviations from the means) of every pair. States of disjoint rows
merge by Chan's rule without reading the rows again, in any order and grouping:

    n = sum n_k,  m = sum n_k m_k / n
    C_ij = sum (C_k,ij + n_k (m_k,i - m_i)(m_k,j - m_j))

Deviations are from means throughout, so long series of large values lose no
digits. A fit is a small solve per merged state; what a retrain reads is the
states, not the history.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import q, sql_cols


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def states(rows: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """keys, n, m_0.., c_0_0..: one state per key, partial states map-side."""
    aggs = {"n": "count(1)"}
    for i, c in enumerate(columns):
        aggs[f"m_{i}"] = f"avg({q(c)})"
    for i, j in _pairs(len(columns)):
        aggs[f"c_{i}_{j}"] = f"covar_pop({q(columns[i])}, {q(columns[j])}) * count(1)"
    return rows.groupBy(*keys).agg(*sql_cols(aggs))


def merged(parts: DataFrame, width: int, keys: Sequence[str]) -> DataFrame:
    """One state per key from any number of states (Chan's rule)."""
    keys = list(keys)
    parts = parts.where("n > 0")
    means = {"_n": "sum(n)"} | {f"_m{i}": f"sum(n * m_{i}) / sum(n)" for i in range(width)}
    key = F.struct(*[F.col(k) for k in keys]).alias("_key")
    whole = parts.groupBy(*keys).agg(*sql_cols(means)).select(key, "_n", *[f"_m{i}" for i in range(width)])
    x = parts.withColumn("_key", key).join(whole, "_key")
    sums = {"n": "max(_n)"} | {f"m_{i}": f"max(_m{i})" for i in range(width)}
    sums |= {f"c_{i}_{j}": f"sum(c_{i}_{j} + n * (m_{i} - _m{i}) * (m_{j} - _m{j}))" for i, j in _pairs(width)}
    return x.groupBy(*keys).agg(*sql_cols(sums))


def _solver(width: int, keys: Sequence[str]):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        c = np.zeros((width, width))
        for i, j in _pairs(width):
            c[i, j] = c[j, i] = r[f"c_{i}_{j}"]
        # Scaled to correlations, so the rank does not depend on units; a
        # constant input has no say.
        scale = np.sqrt(np.diag(c))
        scale[scale == 0] = 1.0
        z = c / np.outer(scale, scale)
        beta, *_ = np.linalg.lstsq(z[:-1, :-1], z[:-1, -1], rcond=1e-10)
        beta = beta * scale[-1] / scale[:-1]
        mean = np.array([r[f"m_{i}"] for i in range(width)])
        out = {k: [r[k]] for k in keys} | {"intercept": [float(mean[-1] - mean[:-1] @ beta)]}
        out |= {f"coef_{i}": [float(b)] for i, b in enumerate(beta)} | {"train_rows": [int(r["n"])]}
        return pd.DataFrame(out)
    return solve


def solved(state: DataFrame, inputs: int, keys: Sequence[str]) -> DataFrame:
    """keys, intercept, coef_0.., train_rows from one state per key over the
    inputs and, last, the target. The table has a row per key."""
    keys = list(keys)
    fields = [f for f in state.schema.fields if f.name in keys]
    schema = T.StructType(fields + [T.StructField("intercept", T.DoubleType())]
                          + [T.StructField(f"coef_{i}", T.DoubleType()) for i in range(inputs)]
                          + [T.StructField("train_rows", T.LongType())])
    return state.groupBy(*keys).applyInPandas(_solver(inputs + 1, keys), schema)
