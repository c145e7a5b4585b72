"""Deterministic bridge from the ``events`` table to reference-shaped inputs.

Each frame is a pure projection (or one aggregation) of ``events`` so its size
grows with the input and Catalyst prunes the scan to the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.sources.tables import read_table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _k(props):
    return F.get_json_object(props, "$.k").cast("int")


def power_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One power reading per event.

    columns: event_id, ts (timestamp_ntz), location, solar_power, wind_power,
    temperature, wind_speed
    """
    e = events(spark, sf_dir)
    hour = F.hour("ts")
    eid = F.col("event_id")
    solar = (F.when((F.col("event_type") == "error") & (eid % 7 == 0), -F.col("value"))
             .when((hour >= 6) & (hour <= 18), F.col("value") * (eid % 40))
             .when(eid % 9 == 0, F.col("value") * F.lit(0.25))
             .otherwise(F.lit(0.0)))
    k = _k(F.col("props"))
    return e.select(
        eid.alias("event_id"),
        F.col("ts"),
        F.concat(F.lit("MicroGrid-0"), (F.col("user_id") % 4 + 1).cast("string")).alias("location"),
        solar.alias("solar_power"),
        (F.col("value") * (F.col("user_id") % 30)).alias("wind_power"),
        (k * 2 - 90).cast("double").alias("temperature"),
        (k % 25).cast("double").alias("wind_speed"),
    )


def raw_reading_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON messages as a web client would post them.

    By ``event_id % 50``: 1 has no ``wind_power``, 2 no ``timestamp`` (``to_json``
    drops NULL fields), 3 a null ``solar_power``, 4 a text ``wind_power`` and 5 a
    ``timestamp`` that can't be read.
    columns: event_id, value (JSON string)
    """
    r = power_readings(spark, sf_dir)
    eid = F.col("event_id")
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(
        eid.alias("event_id"),
        F.when(eid % 50 == 5, F.lit("garbage")).when(eid % 50 != 2, ts_text).alias("timestamp"),
        F.col("solar_power"),
        F.when(eid % 50 != 1, F.col("wind_power")).alias("wind_power"),
        F.col("location"),
        F.struct(F.col("temperature"), F.col("wind_speed")).alias("weather"),
    )
    text = F.to_json(body)
    text = (F.when(eid % 50 == 3, F.regexp_replace(text, '"solar_power":[^,]*', '"solar_power":null'))
            .when(eid % 50 == 4, F.regexp_replace(text, '"wind_power":[^,]*', '"wind_power":"abc"')).otherwise(text))
    return r.select(eid.alias("event_id"), text.alias("value"))


def solar_hour_expr(ts="ts"):
    return (F.hour(ts) + 1).cast("int")


def solar_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional hourly solar generation (one row per region/date/hour).

    Decimal summation keeps the totals exact and order-independent.
    columns: transaction_date (date), transaction_hour (int), region, solar_generation_mwh
    """
    e = events(spark, sf_dir)
    g = (e.select(F.concat(F.lit("R"), (F.col("user_id") % 10).cast("string")).alias("region"),
                  F.to_date("ts").alias("transaction_date"),
                  solar_hour_expr().alias("transaction_hour"),
                  F.col("value").cast("decimal(12,2)").alias("v"))
         .groupBy("region", "transaction_date", "transaction_hour")
         .agg(F.sum("v").alias("v")))
    mwh = F.when(F.col("transaction_hour") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("v").cast("double"))
    return g.select("transaction_date", "transaction_hour", "region", mwh.alias("solar_generation_mwh"))


def consumed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered solar messages with their broker coordinates (with re-deliveries).

    columns: topic, partition, offset, arrival, timestamp (ntz), key,
    transaction_date (string), transaction_hour, region, solar_generation_mwh
    """
    e = events(spark, sf_dir)
    hour = solar_hour_expr()
    region = F.concat(F.lit("R"), (F.col("user_id") % 10).cast("string"))
    return e.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.expr("event_id div 10").alias("offset"),
        F.col("event_id").alias("arrival"),
        F.col("ts").alias("timestamp"),
        region.alias("key"),
        F.date_format("ts", "yyyy-MM-dd").alias("transaction_date"),
        hour.alias("transaction_hour"),
        region.alias("region"),
        F.when(hour % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("value")).alias("solar_generation_mwh"),
    )
