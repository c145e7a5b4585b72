"""Ordered scans against window functions, also where a key lies in many partitions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from voltaflow.operators.ordered import ordered_scan
from voltaflow.operators.solar import solar_lag_diff

SCHEMA = "k string, at int, v double, w string, d timestamp"


def expected(df):
    own = Window.partitionBy("k").orderBy("at")
    return (df.withColumn("prev", F.lag("v").over(own)).withColumn("known", F.last("w", ignorenulls=True).over(own))
            .withColumn("prev_d", F.lag("d").over(own)).withColumn("place", (F.row_number().over(own) - 1).cast("long")))


def rows(seed, hot=400):
    import datetime as dt
    rnd = random.Random(seed)
    out = [("hot", n) for n in range(hot)] + [(rnd.choice(["a", "b", None]), 1000 + n) for n in range(120)] + [("a", None), ("z", 5)]
    rnd.shuffle(out)
    return [(k, n, None if rnd.random() < 0.2 else float(n or 0), None if rnd.random() < 0.9 else f"w{n}",
             dt.datetime(2024, 1, 1) + dt.timedelta(hours=n or 0) if rnd.random() < 0.8 else None) for k, n in out]


@pytest.mark.parametrize("parts,zone", [(1, "UTC"), (5, "Asia/Seoul"), (60, "UTC")])
def test_scan_equals_windows(spark, parts, zone):
    was = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone")}
    advisory = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set(advisory, "false")
    try:
        df = spark.createDataFrame(rows(parts), SCHEMA)
        got = ordered_scan(df, ["k"], ["at"], lag={"prev": "v", "prev_d": "d"}, fill={"known": "w"}, position="place")
        cols = ["k", "at", "v", "w", "d", "prev", "known", "prev_d", "place"]
        want = expected(df)
        assert got.select(cols).exceptAll(want.select(cols)).count() == 0 and got.count() == want.count()
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
        spark.conf.unset(advisory)


def test_one_region_is_spread_over_all_tasks(spark):
    import datetime as dt
    df = spark.createDataFrame([("R", dt.date(2020, 1, 1) + dt.timedelta(days=n // 24), n % 24 + 1, float(n)) for n in range(5000)],
                               "region string, transaction_date date, transaction_hour int, solar_generation_mwh double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = solar_lag_diff(df)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 3 * 5000 / len(sizes)
    assert out.where("prev_generation is null").count() == 1 and out.where("generation_diff <> 1").count() == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ordered_scan(df, ["k"], ["at"], lag={"prev": "v"}, fill={"known": "w"}, position="place").count() == 0
