"""Stream = batch for the streaming forms (file source, availableNow)."""

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltaflow.operators import dispatch
from voltaflow.plans import control_plan as P
from voltaflow.sources.bridge import consumed_raw, power_readings
from voltaflow.streaming.control_stream import start_control_stream
from voltaflow.streaming.sliding import sliding_window_stats
from voltaflow.streaming.sources import read_topics
from voltaflow.streaming.state import battery_dispatch_stream, dedup_stream


def _land_by_time(df, path, time_col, n=3):
    """Write ``df`` as n time-contiguous file groups (arrival order = time order)."""
    lo, hi = df.select(F.min(time_col), F.max(time_col)).first()
    step = (hi - lo) / n
    for i in range(n):
        a, b = lo + step * i, lo + step * (i + 1)
        part = df.filter((F.col(time_col) >= a) & ((F.col(time_col) < b) if i < n - 1 else F.lit(True)))
        part.coalesce(1).write.mode("append").parquet(f"{path}/part{i}")
    return df.schema


def _drain(sdf, name, mode="append"):
    q = sdf.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def test_sliding_window_stream_equals_batch(spark, tmp):
    raw = consumed_raw(spark, SF_SMALL)
    schema = _land_by_time(raw, tmp + "/in", "timestamp")
    s = read_topics(spark, "parquet", tmp + "/in/*", schema=schema, max_per_trigger=1)
    _drain(sliding_window_stats(s), "sliding_out", mode="complete")
    got = spark.table("sliding_out").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    exp = sliding_window_stats(raw)
    cols = ["window_start", "region", "count"]
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0
    assert exp.select(cols).exceptAll(got.select(cols)).count() == 0


def test_battery_stream_equals_batch(spark, tmp):
    pre = dispatch.power_balance(dispatch.estimate_load(dispatch.with_tariff(P.requests(spark, SF_SMALL))))
    pre = pre.select(*P.DISPATCH_CARRY)
    schema = _land_by_time(pre, tmp + "/in", "ts")
    s = read_topics(spark, "parquet", tmp + "/in/*", schema=schema, max_per_trigger=1)
    q = (battery_dispatch_stream(s).writeStream.format("memory").queryName("bat_out").outputMode("append")
         .option("checkpointLocation", tmp + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.event_id: r.soc_after for r in spark.table("bat_out").collect()}
    exp = {r.event_id: r.soc_after for r in dispatch.battery_dispatch(pre).collect()}
    assert got == exp


def test_control_stream_equals_batch(spark, tmp):
    readings = power_readings(spark, SF_SMALL)
    schema = _land_by_time(readings, tmp + "/in", "ts")
    s = read_topics(spark, "parquet", tmp + "/in/*", schema=schema, max_per_trigger=1)
    q = start_control_stream(s, tmp + "/results", tmp + "/events", tmp + "/ck")
    q.awaitTermination()
    got = spark.read.parquet(tmp + "/results").drop("date")
    exp = P.control_results(spark, SF_SMALL)
    assert got.count() == exp.count()
    cols = ["result_id", "battery_soc", "grid_import", "estimated_cost"]
    assert got.select(cols).exceptAll(exp.select(cols)).count() == 0
    assert spark.read.parquet(tmp + "/events").count() > 0


def test_control_stream_hourly_and_daily_equal_batch(spark, tmp):
    from voltaflow.operators.rollups import daily_summary, hourly_aggregates
    from voltaflow.streaming.control_stream import control_results_stream, hourly_rollup_stream
    readings = power_readings(spark, SF_SMALL)
    schema = _land_by_time(readings, tmp + "/in", "ts")
    s = read_topics(spark, "parquet", tmp + "/in/*", schema=schema, max_per_trigger=1)
    q = start_control_stream(s, tmp + "/results", tmp + "/events", tmp + "/ck", daily_path=tmp + "/daily")
    q.awaitTermination()
    batch = P.control_results(spark, SF_SMALL)
    got_d = spark.read.parquet(tmp + "/daily")
    exp_d = daily_summary(batch)
    assert got_d.count() == exp_d.count()
    j = got_d.join(exp_d, ["location", "date"])
    assert j.count() == exp_d.count()
    assert j.filter(F.abs(got_d.total_cost - exp_d.total_cost) > 1e-6 * F.abs(exp_d.total_cost) + 1e-6).count() == 0

    s2 = read_topics(spark, "parquet", tmp + "/in/*", schema=schema, max_per_trigger=1)
    hq = (hourly_rollup_stream(control_results_stream(s2)).writeStream.format("memory").queryName("hourly_out")
          .outputMode("complete").option("checkpointLocation", tmp + "/ck2").trigger(availableNow=True).start())
    hq.awaitTermination()
    got_h = spark.table("hourly_out").withColumn("hour_timestamp", F.col("hour_timestamp").cast("timestamp_ntz"))
    exp_h = hourly_aggregates(batch)
    cols = ["location", "hour_timestamp", "record_count", "avg_solar_power", "avg_wind_power"]
    assert got_h.select(cols).exceptAll(exp_h.select(cols)).count() == 0
    assert exp_h.select(cols).exceptAll(got_h.select(cols)).count() == 0


def test_solar_envelope_stream_sliding_equals_batch(spark, tmp):
    from voltaflow.plans.solar_queries import _records
    from voltaflow.sources.messages import solar_envelope
    from voltaflow.streaming.solar_stream import parse_solar_stream, start_sliding_console
    rec = _records(spark, SF_SMALL)
    env = solar_envelope(rec, prefix="stream", keep=("timestamp",))
    _land_by_time(env, tmp + "/msgs", "timestamp")
    msgs = read_topics(spark, "parquet", tmp + "/msgs/*", schema="timestamp timestamp_ntz, key string, value string",
                       max_per_trigger=1)
    q = start_sliding_console(msgs.select("key", "value"), sink="memory", query_name="solar_sliding",
                              trigger={"availableNow": True}, checkpoint=tmp + "/ck")
    q.awaitTermination()
    got = (spark.table("solar_sliding").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
           .groupBy("window_start", "region").agg(F.max("count").alias("count")))
    batch_in = parse_solar_stream(env.select("value")).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    exp = sliding_window_stats(batch_in).select("window_start", "region", "count")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_observed_row_count(spark):
    from voltaflow.operators.solar import observed, solar_features
    from voltaflow.sources.bridge import solar_hourly
    df, obs = observed(solar_features(solar_hourly(spark, SF_SMALL)), "features_rows")
    n = df.count()
    assert obs.get["rows"] == n
