"""Hourly and daily rollups, upserts and the microgrid dimension."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltaflow.functions import constants as C
from voltaflow.functions.exprs import hour_floor

# columns an upsert of a control result may change; all others keep first-seen values
RESULT_UPDATABLE = ("timestamp", "efficiency_score", "estimated_cost")


def upsert_first_last(df: DataFrame, key: str | list[str], seq: str | list[str],
                      last_cols=RESULT_UPDATABLE) -> DataFrame:
    """Collapse re-deliveries: ``last_cols`` from the latest delivery (by ``seq``),
    every other column from the first one.

    One exchange and one sort on the key: the first row is kept, and the last
    values come from the same window. Equal sequences are told apart by content.
    """
    keys = [key] if isinstance(key, str) else list(key)
    seqs = [seq] if isinstance(seq, str) else list(seq)
    w = Window.partitionBy(*keys).orderBy(*seqs, F.xxhash64(*[c for c in df.columns if c not in keys]))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = df.withColumn("_nth", F.row_number().over(w)).withColumns(
        {f"_last_{c}": F.last(c).over(whole) for c in last_cols})
    return out.where(F.col("_nth") == 1).select(*[
        (F.col(f"_last_{c}").alias(c) if c in last_cols else F.col(c)) for c in df.columns if c not in seqs])


def hourly_aggregates(results: DataFrame, time_col: str = "timestamp",
                      hours_per_reading: float = C.HOURLY_INTERVAL_H, dedupe: bool = False) -> DataFrame:
    """Per (location, hour): mean powers/efficiency, energy sums (kW x h per
    reading), unscaled cost sum and record count.

    ``dedupe=True`` collapses re-delivered results first as the stored table does
    (``upsert_first_last`` by time); ``False`` matches per-message accumulation.
    """
    if dedupe:
        results = upsert_first_last(results.withColumn("_at", F.col(time_col)), "result_id", "_at")
    h = F.lit(hours_per_reading)

    def energy(c):  # sum(kW) x hours per reading
        return F.sum(F.col(c)) * h

    return (results.groupBy("location", hour_floor(F.col(time_col)).alias("hour_timestamp"))
            .agg(F.avg(F.col("solar_power")).alias("avg_solar_power"),
                 F.avg(F.col("wind_power")).alias("avg_wind_power"),
                 energy("total_power").alias("total_energy_generated"),
                 energy("battery_charge_rate").alias("total_battery_charged"),
                 energy("battery_discharge_rate").alias("total_battery_discharged"),
                 energy("grid_import").alias("total_grid_import"),
                 energy("grid_export").alias("total_grid_export"),
                 F.avg("efficiency_score").alias("avg_efficiency_score"),
                 F.sum(F.col("estimated_cost")).alias("total_cost"),
                 F.count(F.lit(1)).alias("record_count")))


def _day_filter(df: DataFrame, time_col: str, dates) -> DataFrame:
    if dates is None:
        return df
    cond = F.lit(False)
    for d in dates:
        lo = F.lit(str(d)).cast("timestamp_ntz")
        cond = cond | ((F.col(time_col) >= lo) & (F.col(time_col) < lo + F.expr("INTERVAL 1 DAY")))
    return df.filter(cond)


def daily_summary(results: DataFrame, time_col: str = "timestamp", dates=None,
                  hours_per_reading: float = C.DAILY_INTERVAL_H) -> DataFrame:
    """Per (location, date): energy sums, efficiency avg/max/min, cost, peak/min power.

    ``dates`` restricts to given days with half-open ranges on the raw
    timestamp (sargable, pushed to the scan). The three columns the stored
    table declares but never fills are typed NULLs.
    """
    df = _day_filter(results, time_col, dates)
    h = F.lit(hours_per_reading)
    null = F.lit(None).cast("double")

    def energy(c):
        return F.sum(F.col(c)) * h

    return (df.groupBy("location", F.to_date(F.col(time_col)).alias("date"))
            .agg(energy("solar_power").alias("total_solar_energy"),
                 energy("wind_power").alias("total_wind_energy"),
                 energy("total_power").alias("total_energy_generated"),
                 energy("grid_import").alias("total_grid_import"),
                 energy("grid_export").alias("total_grid_export"),
                 F.avg("efficiency_score").alias("avg_efficiency_score"),
                 F.max("efficiency_score").alias("max_efficiency_score"),
                 F.min("efficiency_score").alias("min_efficiency_score"),
                 F.sum(F.col("estimated_cost")).alias("total_cost"),
                 F.max("total_power").alias("peak_power"),
                 F.min("total_power").alias("min_power"))
            .withColumn("total_energy_consumed", null)
            .withColumn("total_revenue", null)
            .withColumn("net_profit", null))


def refresh_daily(summary: DataFrame, results: DataFrame, touched: DataFrame,
                  time_col: str = "timestamp") -> DataFrame:
    """Replace the (location, date) groups listed in ``touched`` by a recompute
    over ``results``; all other summary rows stay as they are.

    Only touched groups are re-aggregated (semi join), untouched rows pass
    through an anti join; with date-partitioned storage this is a dynamic
    partition overwrite of the touched dates.
    """
    keys = touched.select("location", "date").distinct()
    scoped = results.withColumn("_date", F.to_date(F.col(time_col))).join(
        keys.withColumnRenamed("date", "_date"), ["location", "_date"], "left_semi").drop("_date")
    fresh = daily_summary(scoped, time_col)
    kept = summary.join(keys, ["location", "date"], "left_anti")
    return kept.unionByName(fresh)


def microgrid_seed(spark: SparkSession) -> DataFrame:
    d = C.MICROGRID_DEFAULTS
    rows = [(loc, name, cap, d["battery_max_charge"], d["battery_max_discharge"], d["grid_max_import"],
             d["grid_max_export"], d["peak_load"], Decimal(str(lat)), Decimal(str(lon)))
            for loc, name, cap, lat, lon in C.MICROGRID_SEED]
    return spark.createDataFrame(rows, "location string, name string, battery_capacity double, "
                                       "battery_max_charge double, battery_max_discharge double, "
                                       "grid_max_import double, grid_max_export double, peak_load double, "
                                       "latitude decimal(10,8), longitude decimal(11,8)")


def upsert_dim_name(dim: DataFrame, updates: DataFrame) -> DataFrame:
    """Insert new locations (with column defaults); for existing ones update ``name`` only."""
    d = C.MICROGRID_DEFAULTS
    u = updates.select("location", F.col("name").alias("_new_name"))
    merged = dim.join(u, "location", "full_outer")
    return merged.select(
        "location",
        F.coalesce("_new_name", "name").alias("name"),
        F.coalesce("battery_capacity", F.lit(C.BATTERY_CAPACITY_KWH)).alias("battery_capacity"),
        *[F.coalesce(k, F.lit(v)).alias(k) for k, v in d.items()],
        "latitude", "longitude",
    )
