"""Queries over the layouts for long and hot series: scans by levels, sampled
range positions, time frames, gaps, mergeable model states, weighted medians,
ordered and bucketed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.columns import cents
from tidemark.operators import candles as C
from tidemark.operators import clean as CL
from tidemark.operators import incremental as INC
from tidemark.operators import ml
from tidemark.operators import timeframes as TF
from tidemark.operators.positions import POS, SLEN
from tidemark.operators.ranges import with_range_position
from tidemark.operators.scan import ewm_gaps as scan_ewm_gaps
from tidemark.plans import late as L
from tidemark.plans import oracle as O
from tidemark.plans import refit as RF
from tidemark.plans import registry as R
from tidemark.plans import stored_queries as SQ
from tidemark.plans.registry import query
from tidemark.sources import sinks
from tidemark.sources.tables import order_ticks, ticks, ticks_as_candles

DAY_SECONDS = 86_400


@query("growth_index_levels", R._sql(SQ._ORDERS, """
SELECT series, ts, tick_id, price,
       round(100.0 * exp(sum(coalesce(ln(price / before), 0.0)) OVER (
           PARTITION BY series ORDER BY ts, tick_id ROWS UNBOUNDED PRECEDING)), 4) AS growth_index
FROM (SELECT *, lag(price) OVER (PARTITION BY series ORDER BY ts, tick_id) AS before FROM ticks)"""))
def growth_index_levels(spark, sf):
    """S12 over one long series: carries by levels, 16-row blocks and fan-out 16."""
    return C.growth_index(order_ticks(spark, sf), ["series"], ("ts", "tick_id"), close="price",
                          block_rows=16, fan=16)


@query("hot_instant_positions", R._sql(SQ._ORDERS, """
SELECT series, date_trunc('year', ts) AS ts, tick_id,
       row_number() OVER (PARTITION BY series ORDER BY date_trunc('year', ts), tick_id) - 1 AS pos,
       count(*) OVER (PARTITION BY series) AS n
FROM ticks"""))
def hot_instant_positions(spark, sf):
    """Positions when a whole year is one instant; sampled ranges
    cut it on the tie-break."""
    t = order_ticks(spark, sf).withColumn("ts", F.date_trunc("year", "ts").cast("timestamp_ntz"))
    x = with_range_position(t, ["series"], ["ts", "tick_id"])
    return x.select("series", "ts", "tick_id", F.col(POS).alias("pos"), F.col(SLEN).alias("n"))


# Runs of NULLs of every length, some longer than a level's fan-out.
_GAP = "(tick_id % 7 < 3 OR (tick_id // 400) % 3 = 1)"


@query("ewm_gaps", R._sql(O.tick_clean() + f""",
gapped AS (SELECT series, pos, open_time, tick_id, CASE WHEN NOT {_GAP} THEN close END AS close FROM posd),
mean AS (
  SELECT series, pos, close AS y, CASE WHEN close IS NULL THEN NULL ELSE 1.0::DOUBLE END AS w FROM gapped WHERE pos = 0
  UNION ALL
  SELECT g.series, g.pos,
         CASE WHEN g.close IS NULL THEN m.y WHEN m.y IS NULL THEN g.close
              ELSE (m.w * 0.9 * m.y + 0.1 * g.close) / (m.w * 0.9 + 0.1) END,
         CASE WHEN g.close IS NOT NULL THEN 1.0 ELSE m.w * 0.9 END
  FROM mean m JOIN gapped g ON g.series = m.series AND g.pos = m.pos + 1
)""", """
SELECT g.series, g.open_time, g.tick_id, g.close, round(m.y, 6) AS ewm
FROM gapped g JOIN mean m ON m.series = g.series AND m.pos = g.pos"""))
def ewm_gaps(spark, sf):
    """Exponential mean (com = 9) over prices with NULLs: the mean stays
    over a gap and its weight decays."""
    c = CL.clean_candles(R._tick_candles(spark, sf), ["series"], R.TICK_ORDER)
    gap = F.expr("tick_id % 7 < 3 OR (tick_id div 400) % 3 = 1")
    c = c.withColumn("close", F.when(~gap, F.col("close")))
    x = with_range_position(c, ["series"], R.TICK_ORDER, with_length=False)
    x = scan_ewm_gaps(x, ["series"], {"ewm": "close"}, com=9)
    return x.select("series", "open_time", "tick_id", "close", F.round("ewm", 6).alias("ewm"))


_SPAN = """PARTITION BY series ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW"""
_CENTS = "CAST(round(price * 100) AS BIGINT)"


@query("ma_24h", R._sql(O.ticks_cte("user_id"), f"""
SELECT series, ts, tick_id, price,
       ((2 * sum({_CENTS}) OVER w + count(price) OVER w) // (2 * count(price) OVER w)) / 100.0 AS ma_24h,
       CASE WHEN count(price) OVER w > 1 THEN round(sqrt(
         (count(price) OVER w * sum({_CENTS} * {_CENTS}) OVER w - sum({_CENTS}) OVER w * sum({_CENTS}) OVER w)
         / (count(price) OVER w * (count(price) OVER w - 1))) / 100.0, 2) END AS volatility_24h
FROM ticks WINDOW w AS ({_SPAN})"""))
def ma_24h(spark, sf):
    """W1/W4/W7 over 24 hours instead of 24 rows, one series per user."""
    return TF.time_features(ticks(spark, sf, "user_id"), ["series"], "ts", "price", DAY_SECONDS,
                            "ma_24h", "volatility_24h")


@query("ma_24h_short_blocks", R._sql(O.ticks_cte(), f"""
SELECT series, ts, tick_id, price,
       ((2 * sum({_CENTS}) OVER w + count(price) OVER w) // (2 * count(price) OVER w)) / 100.0 AS ma_24h
FROM ticks WINDOW w AS ({_SPAN})"""))
def ma_24h_short_blocks(spark, sf):
    """The same over long series, in blocks of 8 hours."""
    x = TF.time_features(ticks(spark, sf), ["series"], "ts", "price", DAY_SECONDS, "ma_24h", "volatility_24h",
                         block_seconds=DAY_SECONDS // 3)
    return x.drop("volatility_24h")


@query("median_ties", R._sql(SQ._ORDERS, """
SELECT month(ts)::INT AS month, median(round(price / 10000)) AS price_step, median(dayofmonth(ts)::DOUBLE) AS day
FROM ticks GROUP BY 1"""))
def median_ties(spark, sf):
    """P8 on repeating values: ranks on counted runs."""
    t = order_ticks(spark, sf).select(F.month("ts").cast("int").alias("month"), F.dayofmonth("ts").cast("double").alias("day"),
                                      F.round(F.col("price") / 10000).alias("price_step"))
    return CL.exact_medians(t, ["price_step", "day"], ["month"], runs=True).select(
        "month", F.col("_med_price_step").alias("price_step"), F.col("_med_day").alias("day"))


@query("ordered_export", R._sql(SQ._ORDERS, """
SELECT row_number() OVER (ORDER BY ts, tick_id) - 1 AS pos, ts, tick_id, price FROM ticks"""))
def ordered_export(spark, sf):
    """A table in global order; each row's place follows from its file and
    its place there."""
    sinks.create_namespaces(spark, ["gold"])
    name = f"gold.ordered_{uuid.uuid4().hex[:12]}"
    sinks.write_ordered(order_ticks(spark, sf).select("ts", "tick_id", "price"), name, ["ts", "tick_id"])
    x = spark.table(name).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    files = x.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    earlier = files.alias("a").join(files.alias("b"), F.col("b._file") < F.col("a._file"), "left").groupBy("a._file").agg(
        F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before"))
    return x.join(earlier, "_file").select((F.col("_before") + F.col("_at")).alias("pos"), "ts", "tick_id", "price")


@query("append_new_only_stored", R.ORACLE["append_new_only"])
def append_new_only_stored(spark, sf):
    """J2 against a stored table that is bucketed by its key: its rows are not
    moved."""
    c = R._candles(spark, sf)
    sinks.create_namespaces(spark, ["bronze"])
    name = f"bronze.bucketed_{uuid.uuid4().hex[:12]}"
    sinks.write_bucketed(c.where(F.col("open_time") < F.lit(R.CUT).cast("timestamp_ntz")), name, ["series", "open_time"], 8)
    batch = c.where(F.col("open_time") >= F.lit(R.REDELIVER_FROM).cast("timestamp_ntz"))
    return INC.new_only(batch, spark.table(name).hint("merge"), ["series"], ["open_time"])


@query("ols_refit_incremental", R._sql(SQ._TWO_SQL, """
SELECT series, open_time, target_time, actual, predicted, error, pct_error, run_id, model FROM preds"""))
def ols_refit_incremental(spark, sf):
    """A model refitted from stored states after an append."""
    frame = R._frame(spark, sf)
    tables = RF.ModelTables.named(spark, uuid.uuid4().hex[:12], block=64)
    cut = F.lit(R.CUT).cast("timestamp_ntz")
    for part in (frame.where(F.col("target_time") < cut), frame.where(F.col("target_time") >= cut)):
        RF.append_rows(part.drop("split"), tables, SQ.TWO_INPUTS)
    model, bounds = RF.refit(spark, tables, SQ.TWO_INPUTS)
    scored = ml.predict(RF.test_rows(spark, tables, bounds), model, SQ.TWO_INPUTS)
    return ml.prediction_table(scored, F.lit("r2"), "LinearRegression").drop("created_at")


@query("late_repair", R.ORACLE["order_features"])
def late_repair(spark, sf):
    """One order in 4,001 arrives after all others; the stored features
    are repaired by replays from these rows until the means meet the stored
    carries."""
    c = ticks_as_candles(order_ticks(spark, sf))
    is_late = F.col("tick_id") % 4001 == 0
    t = L.LateTables.named(spark, uuid.uuid4().hex[:12], order=tuple(R.TICK_ORDER), unit="month")
    L.build_tables(c.where(~is_late), t)
    L.take_up(c.where(is_late), t)
    return spark.table(t.features).drop(L.PART)


@query("profile_incremental", R._sql(O.CANDLES + f""",
raw AS (SELECT * FROM candles UNION ALL
        SELECT * FROM candles WHERE open_time >= TIMESTAMP '{R.REDELIVER_FROM}' AND open_time < TIMESTAMP '{R.CUT}')""", f"""
SELECT series, min(open_time) AS earliest, max(open_time) AS latest, count(*) AS total_rows,
       count(DISTINCT open_time) AS distinct_times, count(open_time) - count(DISTINCT open_time) AS duplicate_rows,
       {R._cents_mean_sql('close')} AS avg_price, round(stddev_samp(close), 2) AS stddev,
       round(min(close), 2) AS min_price, round(max(close), 2) AS max_price, {R._cents_mean_sql('volume')} AS avg_volume,
       {", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in ("open", "high", "low", "close", "volume"))}
FROM raw GROUP BY series"""))
def profile_incremental(spark, sf):
    """A1-A5: the profile from one state per series and date, of which an
    append with re-delivered rows refreshed only its own dates."""
    c = R._candles(spark, sf)
    L.create_namespaces(spark, ["bronze", "gold"])
    at = uuid.uuid4().hex[:12]
    raw, profile = f"bronze.profiled_{at}", f"gold.profile_{at}"
    L.append_profiled(c.where(F.col("open_time") < F.lit(R.CUT).cast("timestamp_ntz")), raw, profile)
    L.append_profiled(c.where(F.col("open_time") >= F.lit(R.REDELIVER_FROM).cast("timestamp_ntz")), raw, profile)
    return L.merged_profile(spark.table(profile))
