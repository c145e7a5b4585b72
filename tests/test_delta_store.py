"""Results as bucketed deliveries: merged on read, nothing lost or repeated by crashes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_streaming import _land_by_time
from voltaflow.operators.alerts import system_events
from voltaflow.operators.rollups import daily_summary, upsert_first_last
from voltaflow.plans import control_plan as P
from voltaflow.sources.bridge import power_readings
from voltaflow.streaming import control_stream as cs
from voltaflow.streaming import delta_store
from voltaflow.streaming.sources import read_topics


@pytest.fixture(scope="module")
def results(spark):
    return P.control_results(spark, SF_SMALL).cache()


def _same(a, b):
    cols = sorted(b.columns)
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0 and b.select(cols).exceptAll(a.select(cols)).count() == 0


def _files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def _deliver(results, path, epochs=5):
    """Deliveries with repeats, and the table they stand for."""
    every = None
    for e in range(epochs):
        part = results.where(f"abs(hash(result_id)) % 3 <= {e % 3}").withColumns(
            {"timestamp": F.col("timestamp") + F.make_dt_interval(F.lit(0), F.lit(e)), "estimated_cost": F.lit(float(e)),
             "solar_power": F.col("solar_power") + e})
        delta_store.append(part, path, e, 4)
        delta_store.commit(results.sparkSession, path, e)
        part = part.withColumn("_e", F.lit(e))
        every = part if every is None else every.unionByName(part)
    return upsert_first_last(every.withColumn("_at", F.col("timestamp")), "result_id", ["_e", "_at"])


def test_read_is_the_upsert_before_and_after_compaction(spark, tmp, results):
    want = _deliver(results, tmp + "/r").checkpoint()
    read = lambda: delta_store.read(spark, tmp + "/r", cs.ddl(results)).drop("date")
    _same(read(), want)
    assert delta_store.compact(spark, tmp + "/r", cs.ddl(results), at_least=3) > 0
    _same(read(), want)
    assert delta_store.compact(spark, tmp + "/r", cs.ddl(results), at_least=2) == 0  # one generation each is left
    later = results.limit(20).withColumns({"estimated_cost": F.lit(99.0), "timestamp": F.col("timestamp") + F.expr("INTERVAL 30 HOURS")})
    delta_store.append(later, tmp + "/r", 5, 4)
    delta_store.commit(spark, tmp + "/r", 5)
    assert read().where("estimated_cost = 99").count() == 20
    rest = read().where("estimated_cost <> 99")
    assert rest.exceptAll(want.select(rest.columns)).count() == 0


def test_compaction_that_crashed_half_way_changes_nothing(spark, tmp, results, monkeypatch):
    want = _deliver(results, tmp + "/r").checkpoint()
    real, done = delta_store._files, []

    def broken(s, path):
        if "/bucket=" in path:
            done.append(path)
            if len(done) > 2:
                raise OSError("gone")
        return real(s, path)
    monkeypatch.setattr(delta_store, "_files", broken)
    with pytest.raises(OSError):
        delta_store.compact(spark, tmp + "/r", cs.ddl(results), at_least=3)
    monkeypatch.undo()
    _same(delta_store.read(spark, tmp + "/r", cs.ddl(results)).drop("date"), want)
    delta_store.compact(spark, tmp + "/r", cs.ddl(results), at_least=2)
    _same(delta_store.read(spark, tmp + "/r", cs.ddl(results)).drop("date"), want)


def test_one_late_row_touches_one_bucket(spark, tmp, results):
    delta_store.append(results, tmp + "/r", 0, 4)
    delta_store.commit(spark, tmp + "/r", 0)
    before = _files(tmp + "/r")
    delta_store.append(results.limit(1), tmp + "/r", 1, 4)
    after = _files(tmp + "/r")
    assert {f: t for f, t in after.items() if f in before} == before
    assert len({os.path.dirname(f) for f in after if f not in before}) == 1
    assert delta_store.read(spark, tmp + "/r", cs.ddl(results)).count() == results.count()  # not committed yet


@pytest.mark.parametrize("broken", ["append_epoch", "commit"])
def test_a_crash_between_the_sinks_leaves_them_consistent(spark, tmp, results, monkeypatch, broken):
    readings = power_readings(spark, SF_SMALL)
    schema = _land_by_time(readings, tmp + "/in", "ts", 2)

    def run():
        s = read_topics(spark, "parquet", tmp + "/in/*", schema=schema, max_per_trigger=1)
        q = cs.start_control_stream(s, tmp + "/r", tmp + "/e", tmp + "/ck", daily_path=tmp + "/d", buckets=4)
        q.awaitTermination()
    where = delta_store if broken == "commit" else cs
    real, calls = getattr(where, broken), []

    def once(*a):
        calls.append(1)
        if len(calls) == 2:  # in the second micro-batch
            raise OSError("crash")
        return real(*a)
    monkeypatch.setattr(where, broken, once)
    with pytest.raises(Exception, match="crash"):
        run()
    assert delta_store.committed(spark, tmp + "/r") == 0
    some = cs.committed_results(spark, tmp + "/r", cs.ddl(results))
    events = cs.committed_events(spark, tmp + "/r", tmp + "/e")
    assert 0 < some.count() < results.count()
    assert events.count() == system_events(some).count()  # both sinks show the same epochs
    run()  # the restart
    assert delta_store.committed(spark, tmp + "/r") == 1
    got = cs.committed_results(spark, tmp + "/r", cs.ddl(results))
    _same(got.select("result_id", "battery_soc", "estimated_cost"), results.select("result_id", "battery_soc", "estimated_cost"))
    assert cs.committed_events(spark, tmp + "/r", tmp + "/e").count() == system_events(results).count()
    days = lambda df: df.select("location", "date", F.round("total_cost", 4).alias("c"))
    _same(days(spark.read.parquet(tmp + "/d")), days(daily_summary(results)))
