"""Ingest of raw JSON power readings (single messages and array batches)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaflow.functions import constants as C

READING_DDL = ("event_id bigint, timestamp string, solar_power double, wind_power double, location string, "
               "weather struct<temperature:double, humidity:double, wind_speed:double>")


def _has(keys: Column, field: str) -> Column:
    return F.coalesce(F.array_contains(keys, F.lit(field)), F.lit(False))


def parse_ts(text: Column) -> Column:
    """ISO-8601 text -> wall-clock timestamp (a trailing Z is accepted)."""
    return F.regexp_replace(text, "Z$", "").try_cast("timestamp_ntz")


def ingest_readings(raw: DataFrame, value_col: str = "value", as_of=None) -> DataFrame:
    """Accept a raw reading when solar_power, wind_power and location are present,
    both powers are JSON numbers and the timestamp, if present, can be read.

    ``error`` names the first fault: a missing field (by the JSON keys), a power
    that is null or text (``Not numeric``), or an unreadable time, whose ``ts``
    stays NULL. Only an absent timestamp is set to ``as_of``, and ``received_at`` =
    ``as_of``: a value, a scalar Column, or by default the latest timestamp in the
    input, which costs a second parse; pass it where it is known.
    """
    keys = F.json_object_keys(F.col(value_col))
    p = F.from_json(F.col(value_col), READING_DDL)
    df = raw.select(p.alias("r"), keys.alias("_keys"))
    timed = _has(F.col("_keys"), "timestamp")
    faults = [F.when(~_has(F.col("_keys"), f), F.lit(C.MSG_MISSING.format(f))) for f in C.REQUIRED_INGEST_FIELDS]
    # a power that is there but is null or text has no number in the record
    faults += [F.when(F.col(f"r.{f}").isNull(), F.lit(C.MSG_NOT_NUMERIC.format(f))) for f in ("solar_power", "wind_power")]
    faults.append(F.when(timed & parse_ts(F.col("r.timestamp")).isNull(), F.lit(C.MSG_BAD_TIME)))
    df = df.select(
        F.col("r.event_id").alias("event_id"),
        F.col("r.location").alias("location"),
        F.col("r.solar_power").alias("solar_power"),
        F.col("r.wind_power").alias("wind_power"),
        parse_ts(F.col("r.timestamp")).alias("_ts"), timed.alias("_timed"),
        F.col("r.weather.temperature").alias("temperature"),
        F.col("r.weather.wind_speed").alias("wind_speed"),
        F.coalesce(*faults).alias("error"))
    if as_of is None:
        as_of = df.select(F.max("_ts")).scalar()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of).cast("timestamp_ntz")
    # bind the (sub)query value to a column once, so it is evaluated once
    df = df.withColumn("received_at", as_of)
    return (df.withColumns({"ts": F.when(F.col("_timed"), F.col("_ts")).otherwise(F.col("received_at")),
                            "data_type": F.lit("power_generation"),
                            "accepted": F.col("error").isNull()})
            .drop("_ts", "_timed"))


def batch_bodies(raw: DataFrame, batch_col: str, value_col: str = "value") -> DataFrame:
    """Group raw messages into JSON array bodies (bounded batch size per body)."""
    return (raw.groupBy(batch_col)
            .agg(F.concat(F.lit("["), F.array_join(F.collect_list(value_col), ","), F.lit("]")).alias("body")))


def ingest_batch_counts(bodies: DataFrame, batch_col: str = "batch_id", body_col: str = "body") -> DataFrame:
    """Per body: success / failed / total items; a body that is not a JSON
    array counts as one failed request with total 0."""
    items = F.from_json(F.col(body_col), "array<string>")
    ok = F.aggregate(
        F.transform(items, lambda x: F.forall(F.array(*[F.lit(f) for f in C.REQUIRED_INGEST_FIELDS]),
                                              lambda f: F.coalesce(F.array_contains(F.json_object_keys(x), f),
                                                                   F.lit(False)))),
        F.lit(0), lambda acc, b: acc + F.when(b, 1).otherwise(0))
    total = F.coalesce(F.size(items), F.lit(0))
    return bodies.select(batch_col,
                         F.coalesce(ok, F.lit(0)).cast("long").alias("success"),
                         (total - F.coalesce(ok, F.lit(0))).cast("long").alias("failed"),
                         total.cast("long").alias("total"))
