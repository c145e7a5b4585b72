"""Solar operators: two-level lag equals a single window, incl. a skewed region."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from voltaflow.operators import solar
from voltaflow.sources.bridge import solar_hourly


def _plain_lag(df):
    w = Window.partitionBy("region").orderBy("transaction_date", "transaction_hour")
    return df.withColumn("prev_plain", F.lag("solar_generation_mwh").over(w))


def _check(df):
    got = solar.solar_lag_diff(df)
    both = _plain_lag(got)
    bad = both.filter(~F.col("prev_generation").eqNullSafe(F.col("prev_plain"))).count()
    assert bad == 0


def test_two_level_lag_matches_window(spark):
    _check(solar.solar_features(solar_hourly(spark, SF_MID)))


def test_two_level_lag_hot_region_with_gaps(spark):
    rows = []
    base = dt.date(2024, 1, 1)
    for d in range(0, 60, 3):            # gaps between days
        for h in (1, 5, 24):
            rows.append((base + dt.timedelta(days=d), h, "HOT", float(d * 100 + h)))
    rows.append((base + dt.timedelta(days=7), 3, "COLD", 1.0))
    df = spark.createDataFrame(rows, "transaction_date date, transaction_hour int, region string, "
                                     "solar_generation_mwh double")
    _check(solar.solar_features(df))


def test_features_hour_24_is_night(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6), 24, "R", None)],
                               "transaction_date date, transaction_hour int, region string, "
                               "solar_generation_mwh double")
    r = solar.solar_features(df).first()
    assert (r.hour_category, r.is_daylight, r.weekday, r.is_weekend, r.solar_generation_mwh) == ("night", 0, 7, 1, 0.0)


def test_parquet_roundtrip(spark, tmp):
    f = solar.solar_features(solar_hourly(spark, SF_MID))
    solar.write_solar(f, tmp + "/solar")
    back = solar.read_solar(spark, tmp + "/solar")
    assert back.count() == f.count()
    assert back.filter("region = 'R1' AND month = 1").count() == f.filter("region = 'R1' AND month = 1").count()


def test_sums_take_values_as_they_are(spark):
    df = spark.createDataFrame([("R1", 0.004)] * 24 + [("R2", float("nan")), ("R2", 1.0)],
                               "region string, solar_generation_mwh double")
    one = solar.overall_stats(df.where("region = 'R1'")).first()
    assert abs(one.total_generation - 0.096) < 1e-12 and abs(one.avg_generation - 0.004) < 1e-12
    import math
    nan = solar.overall_stats(df.where("region = 'R2'")).first()
    assert math.isnan(nan.total_generation) and math.isnan(nan.avg_generation)


def test_lag_of_null_region_day_and_value(spark):
    from pyspark.sql import Window
    rows = [(None, "2024-01-01", 1, 1.0), (None, "2024-01-01", 2, 2.0), (None, "2024-01-02", 1, 4.0), ("A", None, 1, 5.0),
            ("A", "2024-01-01", 1, None), ("A", "2024-01-02", 1, 9.0), ("A", "2024-01-02", 2, 3.0)]
    df = spark.createDataFrame(rows, "region string, d string, transaction_hour int, solar_generation_mwh double").select(
        "region", F.col("d").cast("date").alias("transaction_date"), "transaction_hour", "solar_generation_mwh")
    w = Window.partitionBy("region").orderBy("transaction_date", "transaction_hour")
    want = df.withColumn("prev_generation", F.lag("solar_generation_mwh").over(w))
    got = solar.solar_lag_diff(df).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_nan_generation_is_filled(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 3, "R", float("nan")), (dt.date(2024, 1, 1), 4, "R", None)],
                               "transaction_date date, transaction_hour int, region string, solar_generation_mwh double")
    assert [r.solar_generation_mwh for r in solar.solar_features(df).collect()] == [0.0, 0.0]


def test_overwrite_replaces_the_table_unless_dynamic(spark, tmp):
    df = spark.createDataFrame([("A", 2024, 1, 1.0), ("B", 2024, 1, 2.0)], "region string, year int, month int, v double")
    solar.write_solar(df, tmp + "/t")
    solar.write_solar(df.where("region = 'A'"), tmp + "/t", dynamic=True)
    assert solar.read_solar(spark, tmp + "/t").count() == 2
    solar.write_solar(df.where("region = 'A'"), tmp + "/t")
    assert solar.read_solar(spark, tmp + "/t").count() == 1


def test_pages_over_several_lines_and_corrupt_pages(spark, tmp_path):
    import json

    import pytest

    from voltaflow.sources import messages
    page = {"page": 3, "data": [{"거래일자": "2024-01-01", "거래시간": 2, "지역": "R1", "태양광 발전량(MWh)": 1.5}]}
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text(json.dumps(page, ensure_ascii=False, indent=2))
    got = messages.read_wire_pages(spark, str(tmp_path / "p"), multi_line=True).collect()
    assert [tuple(r) for r in got] == [(3, "2024-01-01", 2, "R1", 1.5)]
    with pytest.raises(Exception):
        messages.read_wire_pages(spark, str(tmp_path / "p")).collect()
    assert messages.read_wire_pages(spark, str(tmp_path / "p"), on_corrupt="drop").count() == 0
    assert messages.corrupt_pages(spark, str(tmp_path / "p")).count() > 0


def test_broker_millis(spark):
    from voltaflow.sources.messages import event_time_from_millis
    row = spark.sql("select 1704067200123L as ms").select(event_time_from_millis("ms").cast("string").alias("t")).first()
    assert row.t == "2024-01-01 00:00:00.123"


def test_no_sort_aggregate_in_dedup_and_upsert(spark):
    from voltaflow.plans import control_queries, solar_queries
    for q in (solar_queries.q_consumed_dedup, control_queries.q_control_results_upsert):
        assert "SortAggregate" not in q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()


def test_scratch_folders_never_clash(spark):
    from voltaflow.session import scratch_dir
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
    from voltaflow.plans import solar_queries
    a = solar_queries.q_paged_json_source(spark, "/root/testdata/sf0.01")
    solar_queries.q_paged_json_source(spark, "/root/testdata/sf0.001").count()
    assert a.count() == 5410


def test_report_scans_its_source_once(spark):
    from tests.conftest import SF_SMALL
    from voltaflow.operators import solar
    from voltaflow.sources.tables import read_table
    df = read_table(spark, SF_SMALL, "events").selectExpr("'R' || user_id % 10 AS region", "value AS solar_generation_mwh")
    out = solar.report(df, 3)
    assert out._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    got = {(r.section, r["rank"], r.key, r.metric): r.value for r in out.collect()}
    top = solar.top_regions(df, 3).collect()
    assert len(got) == 4 + 2 * 3
    for n, r in enumerate(top, 1):
        assert got["top_regions", n, r.region, "total_generation"] == r.total_generation
    assert got["overall", 0, "all", "total_records"] == df.count()
