"""Topics as landed segments: replay, reads from the end, explicit and bounded offsets, restarts."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltaflow.operators.consumed import consumed_dedup
from voltaflow.sources import segments as S
from voltaflow.sources.bridge import consumed_raw
from voltaflow.streaming.state import dedup_stream


@pytest.fixture()
def messages(spark):
    raw = consumed_raw(spark, SF_SMALL)
    return raw.select("topic", "partition", "timestamp", F.col("region").alias("key"), F.col("arrival").cast("string").alias("value"))


def _keys(df):
    return sorted((r.topic, r.partition, r.offset, r.value) for r in df.collect())


def test_offsets_go_on_and_every_message_is_read_once(spark, tmp, messages):
    half = F.pmod(F.hash("value"), F.lit(2)) == 0
    S.land(messages.where(half), tmp + "/t")
    S.land(messages.where(~half), tmp + "/t")
    topics = ",".join(r.topic for r in messages.select("topic").distinct().collect())
    got = S.read_segments(spark, tmp + "/t", topics)
    assert sorted(r.value for r in got.collect()) == sorted(r.value for r in messages.collect())
    per = got.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("a"), F.max("offset").alias("z"),
                                                F.countDistinct("offset").alias("d")).collect()
    assert all((r.a, r.z, r.d) == (0, r.n - 1, r.n) for r in per)
    one = S.read_segments(spark, tmp + "/t", topics.split(",")[0])
    assert one.select("topic").distinct().count() == 1
    times = {r.value: r.timestamp for r in got.collect()}
    want = {r.value: r.timestamp for r in messages.withColumn("timestamp", F.col("timestamp").cast("timestamp")).collect()}
    assert times == want


def test_explicit_and_bounded_offsets(spark, tmp):
    rows = [("a", p, n, f"{p}-{n}") for p in (0, 1) for n in range(100)] + [("b", 0, n, f"b-{n}") for n in range(10)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long, value string").withColumns(
        {"timestamp": F.lit("2024-01-01 00:00:00").cast("timestamp"), "key": F.lit(None).cast("string")})
    for lo in range(0, 100, 25):  # a segment for every 25 offsets
        S.land(df.where(f"offset >= {lo} and offset < {lo + 25}").coalesce(1), tmp + "/t")
    got = S.read_segments(spark, tmp + "/t", "a", json.dumps({"a": {"0": 90, "1": -1}}), json.dumps({"a": {"0": 95}}))
    assert [k[:3] for k in _keys(got)] == [("a", 0, n) for n in range(90, 95)]
    assert S.read_segments(spark, tmp + "/t", "a,b", "latest").count() == 0
    assert S.read_segments(spark, tmp + "/t", "none").count() == 0
    for n in (0, 7, 25, 130, 500):
        first = S.read_segments(spark, tmp + "/t", "a,b", limit=n)
        assert [k[:3] for k in _keys(first)] == sorted(r[:3] for r in rows)[:n]
    found = S.segments(tmp + "/t", ["a", "b"])
    low, high = S.bounds(found, "earliest", "earliest"), S.bounds(found, "latest", "latest")
    files = {r.file for r in S.ranges(found, low, S.first_messages(found, low, high, 30))}
    assert len(files) <= 3 and len(found) == 9  # no file behind the first messages


def test_stream_from_latest_replay_and_restart(spark, tmp, messages):
    topics = ",".join(r.topic for r in messages.select("topic").distinct().collect())
    part = F.pmod(F.hash("value"), F.lit(3))
    S.land(messages.where(part == 0), tmp + "/t")

    def run(name, starting):
        s = S.stream_segments(spark, tmp + "/t", topics, starting, max_per_trigger=40)
        q = s.writeStream.format("parquet").option("path", f"{tmp}/{name}").option("checkpointLocation", f"{tmp}/{name}-ck").start()
        q.processAllAvailable()
        return q
    live, replay = run("live", "latest"), run("replay", "earliest")
    S.land(messages.where(part == 1), tmp + "/t")
    for q in (live, replay):
        q.processAllAvailable()
        q.stop()
    S.land(messages.where(part == 2), tmp + "/t")
    for name, starting in (("live", "latest"), ("replay", "earliest")):  # a restart goes on where it was
        run(name, starting).stop()
    read = lambda name: _keys(spark.read.schema(S.SCHEMA).parquet(f"{tmp}/{name}"))
    every = _keys(S.read_segments(spark, tmp + "/t", topics))
    assert read("replay") == every
    first = {r.value for r in messages.where(part == 0).collect()}
    assert read("live") == [k for k in every if k[3] not in first]


def test_consume_and_dedup_from_the_source(spark, tmp, messages):
    """Re-delivered messages in a landed topic: the stream's log is the batch's."""
    raw = consumed_raw(spark, SF_SMALL)
    body = raw.select("topic", "partition", "offset", "timestamp", F.col("region").alias("key"), F.col("arrival").cast("string").alias("value"))
    S.land(body, tmp + "/t")
    topics = ",".join(r.topic for r in raw.select("topic").distinct().collect())
    s = S.stream_segments(spark, tmp + "/t", topics, "earliest").withColumn("arrival", F.col("value").cast("long"))
    q = (dedup_stream(s, arrival="arrival").writeStream.format("parquet").option("path", tmp + "/out")
         .option("checkpointLocation", tmp + "/ck").start())
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(tmp + "/out").select("topic", "partition", "offset")
    want = consumed_dedup(raw).select("topic", "partition", "offset")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_topics_by_format(spark, tmp, messages):
    from voltaflow.streaming.sources import read_topic_batch, read_topics, write_topic_batch
    where = {"path": tmp + "/t"}
    rows = messages.select("key", "value").limit(60)
    write_topic_batch(rows, "segments", "made", options=where)
    write_topic_batch(rows.limit(5), "segments", "made", options=where | {"partition": 1})
    assert read_topic_batch(spark, "segments", "made", options=where).count() == 65
    first = read_topic_batch(spark, "segments", "made", limit=7, options=where).collect()
    assert [(r.partition, r.offset) for r in first] == [(0, n) for n in range(7)]
    s = read_topics(spark, "segments", "made", options=where)
    q = s.writeStream.format("memory").queryName("made_now").option("checkpointLocation", tmp + "/ck").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("made_now").count() == 65
