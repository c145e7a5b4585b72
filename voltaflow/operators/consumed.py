"""Consumed-message log: insert-or-ignore dedup, totals, top regions, run stats."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


LOG_KEY = ("topic", "partition", "offset")
LOG_COLUMNS = ("timestamp", "key", "transaction_date", "transaction_hour", "region", "solar_generation_mwh")


def consumed_dedup(delivered: DataFrame, arrival: str = "arrival") -> DataFrame:
    """First delivery per (topic, partition, offset) wins (INSERT OR IGNORE).

    One exchange on the key; before it, each task keeps the first of its own
    rows per key (window group limit), so a hot key is cut down early.
    ``consumed_at`` is the first arrival's message time (deterministic); equal
    arrivals are told apart by their content.
    """
    columns = [*LOG_KEY, *LOG_COLUMNS]
    first = F.row_number().over(Window.partitionBy(*LOG_KEY).orderBy(arrival, F.xxhash64(*LOG_COLUMNS)))
    return (delivered.withColumn("_nth", first).where(F.col("_nth") == 1).select(*columns)
            .withColumn("consumed_at", F.col("timestamp")))


def consumed_totals(log: DataFrame) -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias("messages"),
                   F.countDistinct("region").alias("regions"),
                   F.avg(F.col("solar_generation_mwh")).alias("avg_generation"),
                   F.max("solar_generation_mwh").alias("max_generation"),
                   F.min("consumed_at").alias("first_consumed"),
                   F.max("consumed_at").alias("last_consumed"))


def top_regions(log: DataFrame, k: int = 5) -> DataFrame:
    return (log.filter(F.col("solar_generation_mwh").isNotNull()).groupBy("region")
            .agg(F.count(F.lit(1)).alias("messages"),
                 F.avg(F.col("solar_generation_mwh")).alias("avg_generation"))
            .orderBy(F.desc("avg_generation"), "region").limit(k))


def consumption_stats(delivered: DataFrame, log: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """One row per topic: messages seen (incl. duplicates), inserted, first/last
    message time and average milliseconds per message seen."""
    seen = delivered.groupBy("topic").agg(F.count(F.lit(1)).alias("messages_seen"),
                                          F.min(time_col).alias("start_time"), F.max(time_col).alias("end_time"))
    ins = log.groupBy("topic").agg(F.count(F.lit(1)).alias("messages_inserted"))
    span_ms = F.timestamp_diff("MICROSECOND", F.col("start_time"), F.col("end_time")) / F.lit(1000.0)
    return (seen.join(ins, "topic", "left")
            .withColumn("messages_inserted", F.coalesce("messages_inserted", F.lit(0)).cast("long"))
            .withColumn("avg_processing_time_ms",
                        F.when(F.col("messages_seen") > 0, span_ms / F.col("messages_seen")).otherwise(F.lit(0.0))))
