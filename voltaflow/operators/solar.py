"""Regional solar generation: features, lag/daily windows, statistics, reports, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaflow.functions import constants as C
from voltaflow.operators.ordered import ordered_scan

MWH = "solar_generation_mwh"


def rename_source(df: DataFrame) -> DataFrame:
    """Wire (source-language) field names -> ASCII names."""
    present = {src: dst for src, dst in C.SOLAR_SOURCE_FIELDS if src in df.columns}
    return df.withColumnsRenamed(present) if present else df


def solar_features(df: DataFrame) -> DataFrame:
    """Date parts, weekend/daylight flags, hour bucket, MWh NULL -> 0.

    ``weekday`` is Sunday = 1 .. Saturday = 7; hour runs 1..24 (24 is night).
    A string date that does not parse becomes NULL instead of failing the job.
    """
    df = rename_source(df)
    d = F.col("transaction_date")
    if isinstance(df.schema["transaction_date"].dataType, T.StringType):
        d = d.try_cast("date")
    hour = F.col("transaction_hour")
    cat = F.when(hour < C.HOUR_CATEGORIES[0][0], F.lit(C.HOUR_CATEGORIES[0][1]))
    for bound, name in C.HOUR_CATEGORIES[1:]:
        cat = cat.when(hour < bound, F.lit(name))
    df = df.withColumn("transaction_date", d)
    day = F.col("transaction_date")
    wd = F.dayofweek(day)
    return df.withColumns({
        "year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day), "weekday": wd,
        "quarter": F.quarter(day),
        "is_weekend": F.when(wd.isin(1, 7), 1).otherwise(0),
        "is_daylight": F.when((hour >= C.DAYLIGHT_FROM_HOUR) & (hour <= C.DAYLIGHT_TO_HOUR), 1).otherwise(0),
        "hour_category": cat.otherwise(F.lit(C.HOUR_CATEGORY_ELSE)),
        MWH: F.coalesce(F.nanvl(F.col(MWH), F.lit(0.0)), F.lit(0.0)),
    })


def solar_lag_diff(df: DataFrame, key: str = "region", day: str = "transaction_date",
                   hour: str = "transaction_hour", value: str = MWH) -> DataFrame:
    """``prev_generation`` = value of the previous (day, hour) row of the same
    region, and ``generation_diff`` = value - prev (NULL on the first row).

    An ordered scan: rows are dealt out by ranges of (region, day, hour), so one
    region with a long history is spread over all tasks. Requires unique (region, day,
    hour). A NULL region or day is one like any other (NULLs come first); NULL values
    are passed on.
    """
    out = ordered_scan(df, [key], [day, hour], lag={"prev_generation": value})
    return out.withColumn("generation_diff", F.col(value) - F.col("prev_generation"))


def solar_daily_windows(df: DataFrame, key: str = "region", day: str = "transaction_date",
                        value: str = MWH) -> DataFrame:
    """daily_total / daily_avg / daily_max over the whole (region, day) group."""
    w = Window.partitionBy(key, day)
    v = F.col(value)
    return (df.withColumn("daily_total", F.sum(v).over(w))
            .withColumn("daily_avg", F.avg(v).over(w))
            .withColumn("daily_max", F.max(value).over(w)))


def observed(df: DataFrame, name: str):
    """Row count as a metric of the job that consumes ``df`` (no extra job):
    returns (df, observation); ``observation.get['rows']`` after an action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


# Sums and means below are plain double sums of the values as they are; a NaN value
# makes its group's sum and mean NaN. Only results are rounded, for display.


def _v():
    return F.col(MWH)


def overall_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"), F.avg(_v()).alias("avg_generation"),
                  F.max(MWH).alias("max_generation"), F.stddev_samp(_v()).alias("std_generation"),
                  F.sum(_v()).alias("total_generation"))


def regional_stats(df: DataFrame) -> DataFrame:
    return (df.groupBy("region").agg(F.count(F.lit(1)).alias("count"), F.avg(_v()).alias("avg_generation"),
                                     F.max(MWH).alias("max_generation"),
                                     F.sum(_v()).alias("total_generation"))
            .orderBy(F.desc("avg_generation"), "region"))


def hourly_pattern(df: DataFrame) -> DataFrame:
    return (df.groupBy("transaction_hour").agg(F.avg(_v()).alias("avg_generation"))
            .orderBy("transaction_hour"))


def top_regions(df: DataFrame, k: int = 5) -> DataFrame:
    """Top-k regions by average generation (ties by name): TakeOrderedAndProject."""
    return regional_stats(df).limit(k)


def daily_totals(df: DataFrame) -> DataFrame:
    """The daily table layer: one row per (region, date)."""
    return df.groupBy("region", "transaction_date").agg(
        F.count(F.lit(1)).alias("records"), F.sum(_v()).alias("daily_total"),
        F.avg(_v()).alias("daily_avg"), F.max(MWH).alias("daily_max"))


def report(df: DataFrame, k: int = 5) -> DataFrame:
    """Report as rows (section, rank, key, metric, value) instead of text: both
    sections come from one rollup, so the source is scanned once."""
    stats = df.rollup("region").agg(F.grouping("region").alias("_all"), F.count(F.lit(1)).cast("double").alias("total_records"),
                                    F.avg(_v()).alias("avg_generation"), F.max(MWH).alias("max_generation"),
                                    F.sum(_v()).alias("total_generation"))
    overall = F.col("_all") == 1
    place = F.row_number().over(Window.partitionBy("_all").orderBy(F.desc("avg_generation"), "region"))

    def metrics(*names):
        return F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])

    rows = stats.withColumn("rank", F.when(overall, F.lit(0)).otherwise(place)).where(F.col("rank") <= k)
    return rows.select(F.when(overall, F.lit("overall")).otherwise(F.lit("top_regions")).alias("section"), "rank",
                       F.when(overall, F.lit("all")).otherwise(F.col("region")).alias("key"),
                       F.explode(F.when(overall, metrics("total_records", "avg_generation", "max_generation", "total_generation"))
                                 .otherwise(metrics("avg_generation", "total_generation"))).alias("metric", "value"))


def write_solar(df: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = False) -> None:
    """Parquet partitioned by (region, year, month). Overwriting replaces the
    whole table; with ``dynamic`` only the partitions present in ``df``."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
     .partitionBy("region", "year", "month").parquet(path))


def read_solar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
