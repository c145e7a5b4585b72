"""Rollups that follow one result at a time: signed partial sums per micro-batch.

A micro-batch adds, for each group it touches, the sums of its results less the sums
of what these results were before (an upsert moves a result's time, score and cost).
Nothing stored is read but the old rows of the batch's own results, and nothing is
rewritten: a table is the sum of its parts. Sums and counts can be taken back;
minima and maxima can't, so groups that lost a row are listed, and only these
are computed again from the results when the table is read.

Parts are partitioned by date and epoch; an epoch that is run again replaces its parts,
and readers take the epochs that count (see ``delta_store``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.functions import constants as C
from voltaflow.functions.exprs import hour_floor
from voltaflow.operators.rollups import daily_summary
from voltaflow.session import path_exists
from voltaflow.streaming import delta_store

SUMS = ("solar_power", "wind_power", "total_power", "battery_charge_rate", "battery_discharge_rate", "grid_import",
        "grid_export", "efficiency_score", "estimated_cost")
EXTREMES = ("efficiency_score", "total_power")
PART = ("location string, hour timestamp_ntz, rows long, lost long, " + ", ".join(f"sum_{c} double" for c in SUMS)
        + ", " + ", ".join(f"{m}_{c} double" for c in EXTREMES for m in ("min", "max")))


def parts(new: DataFrame, old: DataFrame) -> DataFrame:
    """Signed sums per (location, hour) of results that replace ``old`` versions of theirs."""
    both = new.withColumn("_sign", F.lit(1)).unionByName(old.withColumn("_sign", F.lit(-1)), allowMissingColumns=True)
    gained = F.col("_sign") > 0
    return (both.groupBy("location", hour_floor(F.col("timestamp")).alias("hour")).agg(
        F.sum("_sign").cast("long").alias("rows"), F.sum(F.when(gained, 0).otherwise(1)).cast("long").alias("lost"),
        *[F.sum(F.col(c) * F.col("_sign")).alias(f"sum_{c}") for c in SUMS],
        *[f(F.when(gained, F.col(c))).alias(f"{m}_{c}") for c in EXTREMES for m, f in (("min", F.min), ("max", F.max))]))


def append(batch: DataFrame, results_path: str, path: str, epoch: int, schema: str, key: str = "result_id") -> None:
    """Add the parts of an epoch whose deliveries are already in the results' delta store."""
    spark = batch.sparkSession
    days = batch.select(F.to_date("original_timestamp").alias("date")).distinct()
    keys = batch.select(key).distinct()

    def versions(upto: int) -> DataFrame:
        # folders of the batch's dates; in them the rows of its results
        return (delta_store.read(spark, results_path, schema, key, upto=upto).join(days, "date", "left_semi")
                .join(keys, key, "left_semi").drop("date"))
    # a result that did not change gives and takes the same
    own = parts(versions(epoch), versions(epoch - 1))
    (own.withColumns({"date": F.to_date("hour"), "epoch": F.lit(epoch).cast("long")}).repartition("date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "epoch").parquet(path))


def _stored(spark: SparkSession, path: str, upto: int) -> DataFrame:
    ddl = f"{PART}, date date, epoch long"
    if upto < 0 or not path_exists(spark, path):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path).where(F.col("epoch") <= upto)


def hourly(spark: SparkSession, path: str, results_path: str) -> DataFrame:
    """The hourly rollup of the committed epochs: sums alone, no result is read."""
    h = F.lit(C.HOURLY_INTERVAL_H)
    n = F.sum("rows")

    def mean(c):
        return F.try_divide(F.sum(f"sum_{c}"), n)

    def energy(c):
        return F.sum(f"sum_{c}") * h

    return (_stored(spark, path, delta_store.committed(spark, results_path)).groupBy("location", F.col("hour").alias("hour_timestamp"))
            .agg(mean("solar_power").alias("avg_solar_power"), mean("wind_power").alias("avg_wind_power"),
                 energy("total_power").alias("total_energy_generated"),
                 energy("battery_charge_rate").alias("total_battery_charged"),
                 energy("battery_discharge_rate").alias("total_battery_discharged"),
                 energy("grid_import").alias("total_grid_import"), energy("grid_export").alias("total_grid_export"),
                 mean("efficiency_score").alias("avg_efficiency_score"), F.sum("sum_estimated_cost").alias("total_cost"),
                 n.alias("record_count")).where(F.col("record_count") > 0))


def daily(spark: SparkSession, path: str, results_path: str, schema: str) -> DataFrame:
    """The daily summary of the committed epochs. Days of a location that lost a row
    (and with it, perhaps, an extreme) are summed up from the results, all others
    from the parts."""
    h = F.lit(C.DAILY_INTERVAL_H)
    null = F.lit(None).cast("double")

    def energy(c):
        return F.sum(f"sum_{c}") * h

    days = (_stored(spark, path, delta_store.committed(spark, results_path)).groupBy("location", "date")
            .agg(F.sum("rows").alias("_rows"), F.sum("lost").alias("_lost"),
                 energy("solar_power").alias("total_solar_energy"), energy("wind_power").alias("total_wind_energy"),
                 energy("total_power").alias("total_energy_generated"), energy("grid_import").alias("total_grid_import"),
                 energy("grid_export").alias("total_grid_export"),
                 F.try_divide(F.sum("sum_efficiency_score"), F.sum("rows")).alias("avg_efficiency_score"),
                 F.max("max_efficiency_score").alias("max_efficiency_score"), F.min("min_efficiency_score").alias("min_efficiency_score"),
                 F.sum("sum_estimated_cost").alias("total_cost"), F.max("max_total_power").alias("peak_power"),
                 F.min("min_total_power").alias("min_power")).where(F.col("_rows") > 0))
    whole = days.where("_lost = 0").drop("_rows", "_lost").withColumns(
        {c: null for c in ("total_energy_consumed", "total_revenue", "net_profit")})
    again = days.where("_lost > 0").select("location", F.col("date").alias("_day"))
    rows = (delta_store.read(spark, results_path, schema).drop("date").withColumn("_day", F.to_date("timestamp"))
            .join(again, ["location", "_day"], "left_semi").drop("_day"))
    return whole.unionByName(daily_summary(rows))
