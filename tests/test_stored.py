"""Stored layers, any ``com`` of the exponential mean, one evaluation of a
batch, and that the cleaning queries over orders have rows to drop."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from paths import SF001
from tidemark import session
from tidemark.operators import incremental, positions as P
from tidemark.operators.scan import ewm
from tidemark.plans import layers as L
from tidemark.plans import registry as R
from tidemark.sources.tables import order_ticks
from test_losses import candles


@pytest.mark.parametrize("com", [0, 0.05, 1, 3, 5])
def test_ewm_of_any_com_matches_pandas(spark, com):
    values = [float((i * 37) % 101) for i in range(3000)]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "series string, _pos long, x double")
    x = P.home_rows(P.halo_blocks(df, ["series"], 1024), 1024)
    got = [r["y"] for r in ewm(x, ["series"], {"y": "x"}, com, 0, 1024).orderBy("_pos").collect()]
    want = pd.Series(values).ewm(com=com, adjust=False).mean().tolist()
    assert got == pytest.approx(want, rel=1e-9)


@pytest.mark.parametrize("name", ["order_dedup", "order_recent_30d", "order_last_168"])
def test_order_queries_drop_rows(spark, name):
    assert 0 < R.QUERIES[name](spark, SF001).count() < order_ticks(spark, SF001).count()


def test_recent_panel_reads_only_its_dates(spark):
    layers = L.named(spark, "pruned")
    spark.sql(f"DROP TABLE IF EXISTS {layers.silver}")
    L.write_silver(R._features(spark, SF001), layers)
    plan = L.newest_since(spark.table(layers.silver), 7)._jdf.queryExecution().executedPlan().toString()
    assert any(f"{L.ROW_DATE}#" in line and ">=" in line
               for line in plan.split("\n") if "PartitionFilters: [isnotnull" in line)


def test_append_evaluates_new_rows_once_and_stored_rows_twice(spark):
    stored, new = candles(spark, range(60)), candles(spark, range(60, 63))
    state = incremental.feature_state(stored)
    reads = {"stored": spark.sparkContext.accumulator(0), "new": spark.sparkContext.accumulator(0)}

    def counted(df, name):
        def run(batches):
            for b in batches:
                reads[name].add(b.num_rows)
                yield b
        return df.mapInArrow(run, df.schema)

    res = incremental.append_candles(counted(stored, "stored"), counted(new, "new"), state)
    assert res.features.count() == 3 and res.late.count() == 0 and res.state.count() == 1
    assert reads["new"].value == 3 and reads["stored"].value <= 2 * 60


class _Context:
    master = "spark://many"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        @staticmethod
        def get(name, default):
            return default


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session())
