"""Monitoring queries over stored results and events (``as_of`` instead of NOW())."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaflow.functions import constants as C


def _as_of(df: DataFrame, time_col: str, as_of) -> Column:
    if as_of is None:
        # scalar subquery: evaluated once, no join, no driver round trip
        return df.select(F.max(time_col)).scalar()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else F.lit(as_of)


def last_hour(df: DataFrame, time_col: str = "timestamp", as_of=None) -> DataFrame:
    return df.filter(F.col(time_col) > _as_of(df, time_col, as_of) - F.expr("INTERVAL 1 HOUR"))


def recent_by_location(results: DataFrame, as_of=None, time_col: str = "timestamp") -> DataFrame:
    return (last_hour(results, time_col, as_of).groupBy("location")
            .agg(F.count(F.lit(1)).alias("count"),
                 F.avg("efficiency_score").alias("avg_efficiency"),
                 F.avg(F.col("estimated_cost")).alias("avg_cost"),
                 F.max(time_col).alias("last_update")))


def recent_event_counts(events: DataFrame, as_of=None, k: int = 10, time_col: str = "timestamp") -> DataFrame:
    """Top-k (event_type, severity) by count in the last hour; ties by name."""
    return (last_hour(events, time_col, as_of).groupBy("event_type", "severity")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "event_type", "severity").limit(k))


def latest_per_location(results: DataFrame, cols=("battery_soc", "efficiency_score", "timestamp"),
                        time_col: str = "timestamp") -> DataFrame:
    """Latest row per location (ties broken by result_id). Each task keeps its
    own latest row per location before the exchange (window group limit), so a
    hot location is cut down early."""
    w = Window.partitionBy("location").orderBy(F.desc(time_col), F.desc("result_id"))
    latest = results.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") == 1)
    return latest.select("location", *cols)


def grid_status(dim: DataFrame, results: DataFrame) -> DataFrame:
    """Every microgrid with its latest SOC and efficiency (NULL when no data).
    Results of unknown grids are dropped first; AQE picks the joins by size."""
    grids = dim.select("location", "name")
    known = results.join(grids.select("location"), "location", "left_semi")
    return grids.join(latest_per_location(known), "location", "left")


def control_overall_stats(results: DataFrame) -> DataFrame:
    return results.agg(F.count(F.lit(1)).alias("total_records"),
                       F.avg(F.col("solar_power")).alias("avg_solar"),
                       F.avg(F.col("wind_power")).alias("avg_wind"),
                       F.avg("efficiency_score").alias("avg_efficiency"),
                       F.sum(F.col("estimated_cost")).alias("total_cost"),
                       F.min("timestamp").alias("first_record"),
                       F.max("timestamp").alias("last_record"))


def control_hour_pattern(results: DataFrame) -> DataFrame:
    return (results.groupBy(F.hour("timestamp").alias("hour"))
            .agg(F.avg(F.col("solar_power")).alias("avg_solar"),
                 F.avg(F.col("wind_power")).alias("avg_wind"),
                 F.avg("efficiency_score").alias("avg_efficiency"))
            .orderBy("hour"))


def topic_counts(tagged: DataFrame) -> DataFrame:
    """Messages per topic from a (topic, ...) frame."""
    return tagged.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def topic_summaries(readings: DataFrame, requests: DataFrame, results: DataFrame) -> DataFrame:
    """One summary row per message per topic (numbers, not formatted text)."""
    from voltaflow.functions import constants as C
    a = readings.select(F.lit(C.TOPIC_READINGS).alias("topic"), F.col("event_id").cast("string").alias("message_id"),
                        "location", F.col("solar_power").alias("value_1"), F.col("wind_power").alias("value_2"))
    b = F.struct(F.lit(C.TOPIC_REQUESTS).alias("topic"), F.col("request_id").alias("message_id"),
                 F.col("location"), F.col("total_power").alias("value_1"), F.col("quality_score").alias("value_2"))
    c = F.struct(F.lit(C.TOPIC_RESULTS).alias("topic"), F.concat(F.lit("ctrl_"), F.col("request_id")).alias("message_id"),
                 F.col("location"), F.col("efficiency_score").alias("value_1"),
                 F.col("estimated_cost").alias("value_2"))
    if "efficiency_score" in requests.columns:
        # one frame carries both the request and its result: one pass, two messages per row
        bc = requests.select(F.explode(F.array(b, c)).alias("m")).select("m.*")
    else:
        bc = (requests.select(b.alias("m")).select("m.*")
              .unionByName(results.select(c.alias("m")).select("m.*")))
    return a.unionByName(bc)
