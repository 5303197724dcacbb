"""Structured Streaming: ticks -> closed candles -> incremental features.

``tick_stream``      file source over the ``events`` Parquet files. The stream's
                     ``ts`` is cast to ``timestamp`` (watermarks refuse
                     ``timestamp_ntz``); the session time zone is UTC.
``candle_stream``    event-time watermark + tumbling window; append mode emits a
                     candle once the watermark passes its end, and ticks later
                     than the watermark are dropped by the state store.
``FeatureSink``      ``foreachBatch`` writer: each micro-batch's closed candles
                     go through :func:`tidemark.operators.incremental.append_candles`
                     against what earlier batches stored. Every output is written
                     under ``epoch=<batch id>`` with a dynamic partition overwrite,
                     so a replayed batch rewrites its own files and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tidemark.functions.columns import cents
from tidemark.operators.incremental import append_candles, history_tail
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.sinks import stage

WATERMARK = "10 minutes"
STATE_SCHEMA = T.StructType([
    T.StructField("series", T.StringType()), T.StructField("last_pos", T.LongType()),
    T.StructField("last_time", T.TimestampNTZType()), T.StructField("last_close", T.DoubleType()),
    T.StructField("avg_gain", T.DoubleType()), T.StructField("avg_loss", T.DoubleType()),
])
CANDLE = "1 hour"


def tick_stream(spark: SparkSession, source_dir: str, key: str = "event_type",
                glob: str = "events.parquet", max_files: int | None = None) -> DataFrame:
    schema = spark.read.parquet(f"{source_dir.rstrip('/')}/{glob}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    ev = reader.parquet(source_dir)
    return ev.select(F.col(key).cast("string").alias("series"),
                     F.col("ts").cast("timestamp").alias("ts"),
                     F.col("event_id").alias("tick_id"), F.col("value").alias("price"))


def candle_stream(ticks: DataFrame, freq: str = CANDLE, watermark: str = WATERMARK,
                  keys: Sequence[str] = ("series",), once: bool = False) -> DataFrame:
    """Closed OHLCV candles (same aggregates as the batch ``resample``).

    ``once``: a tick delivered again (same key and ``tick_id``) does not count
    again. Its id is held until the watermark passes its time by the delay;
    copies that come later still are late rows, which are dropped anyway.
    """
    order = F.struct("ts", "tick_id")
    marked = ticks.withWatermark("ts", watermark)
    if once:
        marked = marked.dropDuplicatesWithinWatermark([*keys, "tick_id"])
    agg = (marked
                .groupBy(*keys, F.window("ts", freq))
                .agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"),
                     F.min("price").alias("low"), F.max_by("price", order).alias("close"),
                     F.sum(cents("price")).alias("_vc")))
    return agg.select(*keys, F.col("window.start").cast("timestamp_ntz").alias("open_time"),
                      "open", "high", "low", "close", (F.col("_vc") / 100.0).alias("volume"))


def stream_location(spark: SparkSession, name: str) -> str:
    """A folder for a stream's checkpoint/output under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def run_available(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything available now into ``out_path`` and stop."""
    q = (df.writeStream.format(fmt).outputMode("append")
           .option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start(out_path))
    q.awaitTermination()


class FeatureSink:
    """``foreachBatch`` target that appends each batch's closed candles.

    Under ``base`` it keeps, one ``epoch=`` partition per batch: ``raw`` (the
    appended candles), ``late`` (candles inside the stored history, for
    ``rebuild``), ``features``, ``state`` (per series) and ``tail`` (the
    last 167 candles per series). A batch reads only the previous epoch's
    state and tail, so its cost follows the batch and the number of series,
    not the history.
    """

    def __init__(self, base: str, keys: Sequence[str] = ("series",)):
        self.base = base
        self.keys = list(keys)

    def _path(self, what: str) -> str:
        return f"{self.base.rstrip('/')}/{what}"

    def _read_previous(self, spark: SparkSession, what: str, epoch: int, schema):
        """Rows of the newest epoch before ``epoch`` (empty before the first)."""
        path = self._path(what)
        with_epoch = T.StructType(schema.fields + [T.StructField("epoch", T.LongType())])
        try:
            df = spark.read.schema(with_epoch).parquet(path).filter(F.col("epoch") < epoch)
            last = df.agg(F.max("epoch")).first()[0]
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None                     # nothing written yet
        if last is None:
            return spark.createDataFrame([], schema)
        return df.filter(F.col("epoch") == last).drop("epoch")

    def _write(self, df: DataFrame, what: str, epoch: int) -> None:
        (df.withColumn("epoch", F.lit(epoch).cast("long")).write
           .mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("epoch").parquet(self._path(what)))

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = stage(batch, "stream-batch")    # the stateful aggregate runs once
        if batch.isEmpty():
            return
        tail = self._read_previous(spark, "tail", epoch, batch.schema)
        state = self._read_previous(spark, "state", epoch, STATE_SCHEMA)
        res = append_candles(tail, batch, state, self.keys)
        appended = res.appended.select(*batch.columns)
        self._write(appended, "raw", epoch)
        self._write(res.late.select(*batch.columns), "late", epoch)
        self._write(res.features, "features", epoch)
        self._write(res.state, "state", epoch)
        self._write(history_tail(tail.unionByName(appended), self.keys), "tail", epoch)


def run_feature_stream(spark: SparkSession, source_dir: str, base: str,
                       keys: Sequence[str] = ("series",)) -> DataFrame:
    """Ticks -> closed candles -> features, all available input, then stop.
    Returns the feature rows written by every batch."""
    candles = candle_stream(tick_stream(spark, source_dir), keys=keys)
    sink = FeatureSink(base, keys)
    q = (candles.writeStream.outputMode("append")
                .option("checkpointLocation", f"{base}/_checkpoint")
                .foreachBatch(sink).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/features").drop("epoch")
