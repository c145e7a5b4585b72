"""Stream state: duplicates for ever, event-time battery, the log of micro-batches."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_streaming import _land_by_time
from voltaflow.operators import dispatch
from voltaflow.operators.consumed import LOG_COLUMNS, LOG_KEY, consumed_dedup, consumption_stats
from voltaflow.plans import control_plan as P
from voltaflow.sources.bridge import consumed_raw
from voltaflow.streaming import sources, state

DELIVERED = "topic string, partition int, offset long, timestamp timestamp, arrival long"
NOON = dt.datetime(2024, 1, 1, 12)


def _run(spark, sdf, tmp, name="out"):
    q = (sdf.writeStream.format("parquet").option("path", f"{tmp}/{name}").option("checkpointLocation", f"{tmp}/{name}-ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(sdf.schema).parquet(f"{tmp}/{name}")


def _deliver(spark, tmp, rows, schema=DELIVERED):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(tmp + "/in")


def test_late_first_deliveries_stay_and_late_repeats_go(spark, tmp):
    """Offsets out of order and days apart, over several batches and restarts."""
    batches = [[("a", 0, 5, NOON, 1), ("a", 0, 6, NOON + dt.timedelta(minutes=5), 2), ("b", 1, 5, NOON, 3)],
               [("a", 0, 3, NOON - dt.timedelta(hours=2), 4), ("a", 0, 5, NOON, 5), ("a", 0, 6, NOON + dt.timedelta(days=9), 6)],
               [("a", 0, 4, NOON - dt.timedelta(days=30), 7), ("a", 0, 3, NOON, 8), ("b", 1, 6, NOON, 9), ("b", 1, 6, NOON, 10)],
               [("a", 0, 5, NOON + dt.timedelta(days=400), 11), ("a", None, 1, NOON, 12), ("a", None, 1, NOON, 13), ("a", 0, None, NOON, 14)],
               [("a", 0, None, NOON, 15)]]
    for rows in batches:  # each run is a restart from the checkpoint
        _deliver(spark, tmp, rows)
        s = sources.read_topics(spark, "parquet", tmp + "/in", schema=spark.createDataFrame([], DELIVERED).schema)
        got = _run(spark, state.dedup_stream(s, arrival="arrival"), tmp)
    kept = [r for rows in batches for r in rows]
    first = {}
    for r in kept:
        first.setdefault(r[:3], r[4])
    assert sorted(r.arrival for r in got.collect()) == sorted(first.values())


def test_stream_dedup_equals_batch(spark, tmp):
    raw = consumed_raw(spark, SF_SMALL)
    many = raw.unionByName(raw.where("offset % 3 = 0").withColumn("arrival", F.col("arrival") + 1_000_000))
    shuffled = many.withColumn("_part", F.pmod(F.hash("offset", "arrival"), F.lit(4)))
    want = {tuple(r) for r in consumed_dedup(many).select(*LOG_KEY, *LOG_COLUMNS).collect()}
    for k in range(4):  # by arrival in four files
        lo, hi = many.approxQuantile("arrival", [k / 4, (k + 1) / 4], 0.0)
        part = shuffled.where((F.col("arrival") > lo) & (F.col("arrival") <= hi) if k else F.col("arrival") <= hi)
        part.drop("_part").orderBy(F.rand(3)).coalesce(1).write.mode("append").parquet(f"{tmp}/in/part{k}")
    s = sources.read_topics(spark, "parquet", tmp + "/in/*", schema=many.schema, max_per_trigger=1)
    got = _run(spark, state.dedup_stream(s, arrival="arrival"), tmp)
    assert {tuple(r) for r in got.select(*LOG_KEY, *LOG_COLUMNS).collect()} == want


def test_state_has_the_size_of_the_gaps():
    rnd = random.Random(2)
    offsets = [k for k in range(5000) if k % 1000 != 7]
    rnd.shuffle(offsets)
    a = z = np.empty(0, np.int64)
    seen = set()
    for k in range(0, len(offsets), 400):
        part = np.array(offsets[k:k + 400], np.int64)
        assert not state._covered(a, z, part).any()
        a, z = state._merged(a, z, part)
        seen |= set(part.tolist())
        assert state._covered(a, z, np.arange(-2, 5003)).tolist() == [x in seen for x in range(-2, 5003)]
    assert len(a) == 6
    assert list(zip(a.tolist(), z.tolist()))[:2] == [(0, 7), (8, 1007)]
    a, z = state._merged(a, z, np.array([7, 7, 1007], np.int64))
    assert len(a) == 4


@pytest.fixture()
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(name)


def test_shuffled_arrival_equals_the_batch_fold(spark, tmp, rocksdb):
    pre = dispatch.power_balance(dispatch.estimate_load(dispatch.with_tariff(P.requests(spark, SF_SMALL)))).select(*P.DISPATCH_CARRY)
    want = {r.event_id: r.soc_after for r in dispatch.battery_dispatch(pre).collect()}
    span = pre.agg(F.max("ts")).first()[0]
    # rows arrive up to a day out of order; a last batch moves the watermark on
    shuffled = pre.withColumn("_at", F.col("ts") + F.make_dt_interval(F.lit(0), F.pmod(F.hash("event_id"), F.lit(24))))
    _land_by_time(shuffled, tmp + "/in", "_at", 5)
    end = pre.limit(1).withColumns({"ts": F.lit(span + dt.timedelta(days=9)).cast("timestamp_ntz"), "event_id": F.lit(-1).cast(pre.schema["event_id"].dataType)})
    late = pre.orderBy("ts", "event_id").limit(3)
    for k, df in enumerate((end, late)):
        df.withColumn("_at", F.col("ts")).coalesce(1).write.parquet(f"{tmp}/in/z{k}")
    s = sources.read_topics(spark, "parquet", tmp + "/in/*", schema=shuffled.schema, max_per_trigger=1).drop("_at")
    got = _run(spark, state.battery_event_time_stream(s, delay="25 hours"), tmp).collect()
    assert {r.event_id: r.soc_after for r in got if not r.late} == want
    assert [r.soc_after for r in got if r.late] == [None] * 3
    assert sorted(r.event_id for r in got if r.late) == sorted(r.event_id for r in late.collect())


def test_every_micro_batch_is_logged_once(spark, tmp):
    """More batches than Spark remembers, and batches that are reported again."""
    raw = consumed_raw(spark, SF_SMALL).limit(450)
    raw.repartition(150).write.parquet(tmp + "/in")
    log = sources.ConsumptionLog(spark, tmp + "/log")
    assert sources.consumption_log(spark, tmp + "/log").count() == 0
    spark.streams.addListener(log)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "20")
    try:
        s = sources.read_topics(spark, "parquet", tmp + "/in", schema=raw.schema, max_per_trigger=1)
        q = (s.writeStream.format("noop").option("checkpointLocation", tmp + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        for p in q.recentProgress[-3:]:  # reported again
            log.onQueryProgress(type("E", (), {"progress": p}))
    finally:
        spark.streams.removeListener(log)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(q.recentProgress) <= 20
    rows = sources.consumption_log(spark, tmp + "/log", topic="solar_raw_data")
    files = len([f for f in spark.read.parquet(tmp + "/in").inputFiles()])
    assert rows.count() == files >= 140 and rows.select("batch_id").distinct().count() == files
    total = sources.progress_stats(rows).first()
    seen = consumption_stats(raw, consumed_dedup(raw)).agg(F.sum("messages_seen")).first()[0]
    assert (total.batches, total.messages_consumed) == (files, seen) and total.avg_processing_time_ms > 0
