"""Catalog statements, sinks, streaming."""

import os
import uuid

from pyspark.sql import functions as F

from paths import SF0001
from tidemark.operators import candles as C
from tidemark.plans.features import build_features
from tidemark.sources import sinks
from tidemark.sources.tables import ticks
from tidemark.streaming import candles as S


def test_namespaces_and_current_schema(spark):
    sinks.create_namespaces(spark)
    names = {r[0] for r in sinks.show_namespaces(spark).collect()}
    assert {"bronze", "silver", "gold"} <= names
    sinks.use_catalog(spark, "spark_catalog")
    cur = sinks.current_namespace(spark).collect()[0]
    assert cur["catalog"] == "spark_catalog" and cur["schema"] == "default"


def test_append_matches_by_name(spark):
    sinks.create_namespaces(spark, ["silver"])
    f = build_features(C.resample(ticks(spark, SF0001)))
    name = f"silver.f_{uuid.uuid4().hex[:8]}"
    first = f.filter(F.col("series") == "click")
    sinks.write_table(first, name, "overwrite")
    rest = f.filter(F.col("series") != "click")
    sinks.write_table(rest.select(*reversed(rest.columns)), name, "append")
    back = spark.table(name)
    assert back.columns == f.columns
    assert back.count() == f.count()
    assert back.exceptAll(f).count() == 0


def test_stream_candles_equal_batch_on_closed_windows(spark):
    loc = S.stream_location(spark, f"t-{uuid.uuid4().hex}")
    S.run_available(S.candle_stream(S.tick_stream(spark, SF0001)), f"{loc}/out", f"{loc}/ck")
    got = spark.read.parquet(f"{loc}/out")
    batch = C.resample(ticks(spark, SF0001))
    wm = ticks(spark, SF0001).agg(F.max("ts")).collect()[0][0]
    import datetime as dt
    closed = batch.filter(F.col("open_time") + F.expr("INTERVAL 1 HOUR")
                          <= F.lit(wm - dt.timedelta(minutes=10)))
    assert got.count() == closed.count() > 0
    assert got.exceptAll(closed).count() == 0


def test_stream_features_equal_batch(spark):
    loc = S.stream_location(spark, f"t-{uuid.uuid4().hex}")
    got = S.run_feature_stream(spark, SF0001, loc)
    batch = build_features(C.resample(ticks(spark, SF0001)))
    cols = [c for c in batch.columns]
    # The stream holds back windows the watermark has not passed.
    import datetime as dt
    wm = ticks(spark, SF0001).agg(F.max("ts")).collect()[0][0] - dt.timedelta(minutes=10)
    closed = batch.filter(F.col("open_time") + F.expr("INTERVAL 1 HOUR") <= F.lit(wm))
    assert got.count() == closed.count() > 0
    assert got.select(*cols).exceptAll(closed).count() == 0
    assert os.path.isdir(os.path.join(loc, "state").replace("file:", ""))


def test_feature_sink_batches_and_replay_equal_batch(spark):
    """Three micro-batches through the sink, one replayed: features equal the
    batch build, and each batch reads only the previous epoch's tail/state."""
    c = C.resample(ticks(spark, SF0001))
    t1 = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    t2 = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    parts = [c.filter(F.col("open_time") < t1),
             c.filter((F.col("open_time") >= t1) & (F.col("open_time") < t2)),
             c.filter(F.col("open_time") >= t2)]
    base = S.stream_location(spark, f"t-{uuid.uuid4().hex}")
    sink = S.FeatureSink(base)
    for epoch, part in enumerate(parts):
        sink(part, epoch)
    sink(parts[1], 1)                                   # replayed batch
    got = spark.read.parquet(f"{base}/features").drop("epoch")
    want = build_features(c)
    assert got.count() == want.count()
    assert got.select(*want.columns).exceptAll(want).count() == 0
    tail = spark.read.parquet(f"{base}/tail").filter(F.col("epoch") == 2)
    assert tail.groupBy("series").count().agg(F.max("count")).first()[0] == 167
