"""The streaming sinks: nothing stored is lost, nothing is repeated."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_streaming import _land_by_time
from voltaflow.operators.rollups import daily_summary
from voltaflow.plans import control_plan as P
from voltaflow.sources.bridge import consumed_raw, power_readings
from voltaflow.streaming import control_stream as cs
from voltaflow.streaming.solar_stream import produce_stream, topic_counts_stream
from voltaflow.streaming.sources import read_topic_batch, read_topics, to_topic_value, write_topic
from voltaflow.streaming.state import battery_dispatch_stream


@pytest.fixture(scope="module")
def results(spark):
    return P.control_results(spark, SF_SMALL).cache()


def test_a_failing_read_loses_no_row(spark, tmp, results, monkeypatch):
    cs.merge_results(results, tmp + "/r", 0)
    day = results.where(F.to_date("original_timestamp") == F.lit("2024-01-15").cast("date"))

    def broken(*a):
        raise OSError("store unreachable")
    monkeypatch.setattr(cs, "_stored", broken)
    with pytest.raises(OSError):
        cs.merge_results(day.limit(1), tmp + "/r", 1)
    monkeypatch.undo()
    assert spark.read.parquet(tmp + "/r").count() == results.count()
    cs.merge_results(day.limit(1), tmp + "/r", 1)
    assert spark.read.parquet(tmp + "/r").count() == results.count()


def test_redelivery_in_one_batch_keeps_arrival_order(spark, tmp, results):
    one = results.limit(1)
    later = one.withColumns({"timestamp": F.col("timestamp") + F.expr("INTERVAL 1 HOUR"), "estimated_cost": F.lit(7.0),
                             "solar_power": F.lit(-1.0)})
    cs.merge_results(later.unionByName(one), tmp + "/r", 0)
    got, first = spark.read.parquet(tmp + "/r").first(), one.first()
    assert got.estimated_cost == 7.0 and got.timestamp == first.timestamp + dt.timedelta(hours=1)
    assert got.solar_power == first.solar_power


def test_running_an_epoch_again_changes_nothing(spark, tmp, results):
    half = results.where("hash(result_id) % 2 = 0")
    for _ in range(2):
        cs.merge_results(half, tmp + "/r", 3)
        cs.append_epoch(cs.system_events(half), tmp + "/e", 3)
    assert spark.read.parquet(tmp + "/r").count() == half.count()
    assert spark.read.parquet(tmp + "/e").count() == cs.system_events(half).count()
    cs.append_epoch(cs.system_events(half), tmp + "/e", 4)
    assert spark.read.parquet(tmp + "/e").count() == 2 * cs.system_events(half).count()


def test_daily_table_keeps_untouched_dates(spark, tmp, results):
    cs.merge_results(results, tmp + "/r", 0)
    cs.refresh_daily_table(results, tmp + "/r", tmp + "/d")
    some = results.where(F.to_date("timestamp") == F.lit("2024-01-15").cast("date"))
    assert some.count() > 0
    cs.refresh_daily_table(some, tmp + "/r", tmp + "/d")
    got = spark.read.parquet(tmp + "/d").select("location", "date", F.round("total_cost", 4).alias("c"))
    want = daily_summary(results).select("location", "date", F.round("total_cost", 4).alias("c"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_invalid_readings_go_to_the_dead_letter_folder(spark, tmp):
    readings = power_readings(spark, SF_SMALL)
    schema = _land_by_time(readings, tmp + "/in", "ts", 1)
    s = read_topics(spark, "parquet", tmp + "/in/*", schema=schema)
    q = cs.start_control_stream(s, tmp + "/r", tmp + "/e", tmp + "/ck", rejected_path=tmp + "/bad")
    q.awaitTermination()
    q.rejected.awaitTermination()
    bad = spark.read.parquet(tmp + "/bad")
    assert bad.count() == readings.count() - spark.read.parquet(tmp + "/r").count() > 0
    assert bad.where("size(errors) = 0").count() == 0


def test_battery_goes_on_after_a_restart(spark, tmp, results):
    pre = P.dispatched(spark, SF_SMALL).select(*P.DISPATCH_CARRY, F.col("soc_after").alias("want"))
    _land_by_time(pre, tmp + "/all", "ts", 2)
    schema = pre.schema

    def run():
        s = read_topics(spark, "parquet", tmp + "/in", schema=schema)
        q = (battery_dispatch_stream(s).writeStream.format("parquet").option("path", tmp + "/out")
             .option("checkpointLocation", tmp + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    for part in ("part0", "part1"):  # the second run finds the first run's state
        spark.read.parquet(f"{tmp}/all/{part}").write.mode("append").parquet(tmp + "/in")
        run()
    out = spark.read.parquet(tmp + "/out")
    assert out.count() == pre.count()
    assert out.where("soc_after <> want").count() == 0


def test_topic_sink_bounded_read_and_running_counts(spark, tmp):
    raw = consumed_raw(spark, SF_SMALL).select("topic", "partition", "offset", "region", "solar_generation_mwh")
    raw.write.parquet(tmp + "/in")
    s = read_topics(spark, "parquet", tmp + "/in", schema=raw.schema)
    write_topic(to_topic_value(s, "region"), "json", tmp + "/topic", tmp + "/ck1", {"availableNow": True}).awaitTermination()
    back = read_topic_batch(spark, "json", tmp + "/topic", schema="key string, value string")
    assert back.count() == raw.count() and back.where("key is null or value not like '{%'").count() == 0
    first = read_topic_batch(spark, "parquet", tmp + "/in", schema=raw.schema, limit=7)
    want = raw.orderBy("topic", "partition", "offset").limit(7)
    assert [tuple(r)[:3] for r in first.collect()] == [tuple(r)[:3] for r in want.collect()]
    q = (topic_counts_stream(s).writeStream.format("memory").queryName("topic_counts_now").outputMode("complete")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("topic_counts_now").collect()} == {
        tuple(r) for r in raw.groupBy("topic").count().collect()}


def test_continuous_produce_sends_every_page(spark, tmp):
    pages = spark.createDataFrame([(k, [("R1", "2024-01-01", 3, float(k))]) for k in range(3)],
                                  "page long, data array<struct<region:string, transaction_date:string, "
                                  "transaction_hour:int, solar_generation_mwh:double>>")
    for k in range(3):
        pages.where(f"page = {k}").coalesce(1).write.mode("append").json(tmp + "/pages")
    q = produce_stream(spark, tmp + "/pages", "json", tmp + "/topic", tmp + "/ck", interval="0 seconds")
    q.processAllAvailable()
    q.stop()
    got = spark.read.schema("key string, value string").json(tmp + "/topic")
    assert got.count() == 3 and {r.key for r in got.collect()} == {"stream_R1"}


def test_batch_produce_writes_and_counts(spark, tmp):
    from voltaflow.plans.solar_queries import _records
    from voltaflow.streaming.sources import produce_batch
    rec = _records(spark, SF_SMALL)
    totals = produce_batch(rec, "json", tmp + "/topic")
    n = rec.count()
    assert totals.agg(F.sum("records"), F.sum("success"), F.sum("failed")).first()[:] == (n, n, 0)
    assert read_topic_batch(spark, "json", tmp + "/topic", schema="key string, value string").count() == n


def test_forecast_importances_and_metrics(spark):
    from voltaflow.operators import forecast
    from voltaflow.plans.solar_queries import _features
    frame = forecast.ml_training_frame(_features(spark, SF_SMALL))
    metrics, fitted = forecast.train_forecast(spark, frame)
    imp = dict(forecast.feature_importances(fitted["random_forest"]))
    assert abs(sum(imp.values()) - 1) < 1e-6 and set(imp) == set(forecast.C.FEATURE_COLUMNS)
    base = forecast.split_baseline(frame).first()
    assert base.n_train + base.n_test == frame.count()
    assert all(0 < r.rmse < 2 * base.rmse and r.r2 <= 1 for r in metrics.collect())


def test_stored_tables_can_be_registered(spark, tmp):
    from voltaflow.functions.schemas import TABLES, create_tables
    create_tables(spark, tmp)
    for name in TABLES:
        assert spark.table(name).count() == 0
        spark.sql(f"DROP TABLE {name}")
