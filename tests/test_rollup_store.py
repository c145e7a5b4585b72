"""Rollups from signed partial sums against a recompute over the merged results."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from voltaflow.operators.rollups import daily_summary, hourly_aggregates
from voltaflow.plans import control_plan as P
from voltaflow.streaming import control_stream as cs
from voltaflow.streaming import delta_store, rollup_store


@pytest.fixture(scope="module")
def results(spark):
    return P.control_results(spark, SF_SMALL).cache()


def _close(got, want, keys):
    cols = sorted(c for c in want.columns if c not in keys)
    g = {tuple(r[k] for k in keys): [r[c] for c in cols] for r in got.collect()}
    w = {tuple(r[k] for k in keys): [r[c] for c in cols] for r in want.collect()}
    assert g.keys() == w.keys()
    for k, row in w.items():
        for a, b in zip(g[k], row):
            assert a == b or a == pytest.approx(b, rel=1e-9, abs=1e-6), (k, a, b)


@pytest.mark.parametrize("seed", [1])
def test_upserts_equal_a_recompute(spark, tmp, results, seed):
    """Random re-deliveries: times move between hours and days, scores and costs change, batches repeat."""
    schema = cs.ddl(results)
    for epoch in range(4):
        part = results.where(f"pmod(hash(result_id, {seed}, {epoch}), 3) = 0")
        part = part.withColumns({
            "timestamp": F.col("timestamp") + F.make_dt_interval(F.lit(0), F.pmod(F.hash("result_id", F.lit(epoch)), F.lit(30)) * F.lit(int(epoch > 0))),
            "efficiency_score": F.col("efficiency_score") * F.lit(1 - epoch / 10), "estimated_cost": F.col("estimated_cost") + F.lit(epoch)})
        for _ in range(2 if epoch == 2 else 1):  # one epoch runs twice
            delta_store.append(part, tmp + "/r", epoch, 3)
            rollup_store.append(part, tmp + "/r", tmp + "/s", epoch, schema)
        before = [os.path.join(d, f) for d, _, fs in os.walk(tmp + "/s") for f in fs if f.endswith(".parquet") and f"epoch={epoch}" not in d]
        delta_store.commit(spark, tmp + "/r", epoch)
        now = delta_store.read(spark, tmp + "/r", schema).drop("date")
        if epoch in (0, 3):
            _close(rollup_store.hourly(spark, tmp + "/s", tmp + "/r"), hourly_aggregates(now), ["location", "hour_timestamp"])
            _close(rollup_store.daily(spark, tmp + "/s", tmp + "/r", schema), daily_summary(now), ["location", "date"])
        assert all(map(os.path.exists, before))  # earlier parts stay as they are


def test_uncommitted_parts_do_not_count(spark, tmp, results):
    schema = cs.ddl(results)
    delta_store.append(results, tmp + "/r", 0, 2)
    rollup_store.append(results, tmp + "/r", tmp + "/s", 0, schema)
    assert rollup_store.hourly(spark, tmp + "/s", tmp + "/r").count() == 0
    assert rollup_store.daily(spark, tmp + "/s", tmp + "/r", schema).count() == 0
