"""The control job as one Structured Streaming query.

readings (topic or files) -> validate/features -> stateful battery ->
grid/metrics -> foreachBatch fan-out: results upserted by date partition,
alert events appended. Checkpointed; restart resumes offsets and SOC state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaflow.operators.alerts import system_events
from voltaflow.operators.control import control_metrics, flatten_results, grid_interaction
from voltaflow.operators.dispatch import tariff_load_balance
from voltaflow.functions import constants as C
from voltaflow.operators.quality import rejected_readings
from voltaflow.operators.rollups import daily_summary, upsert_first_last
from voltaflow.plans.control_plan import DISPATCH_CARRY, requests_from_readings
from voltaflow.session import checkpoint_root, path_exists
from voltaflow.streaming import delta_store, rollup_store
from voltaflow.streaming.state import battery_dispatch_stream


def control_results_stream(readings: DataFrame, scope: str = "location") -> DataFrame:
    req = requests_from_readings(readings)
    df = tariff_load_balance(req).select(*DISPATCH_CARRY)
    df = battery_dispatch_stream(df, scope=scope)
    return flatten_results(control_metrics(grid_interaction(df)))


def _stored(spark, path: str, like: DataFrame) -> DataFrame:
    """The stored table, with the schema it is written with; empty before the
    first write. Any error while reading it is raised, never taken for absence."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def merge_results(batch: DataFrame, results_path: str, seq: int) -> None:
    """Upsert a micro-batch into the results table, partitioned by the date of
    ``original_timestamp`` (a re-delivery cannot move it), rewriting only the
    touched dates. Deliveries are ordered by (epoch, time), so two of one result
    in a micro-batch keep their order. The merged frame is materialised with
    ``checkpoint()`` before its source is overwritten. Running an epoch again
    gives the same table."""
    spark = batch.sparkSession
    batch = batch.withColumn("date", F.to_date("original_timestamp"))
    old = _stored(spark, results_path, batch).join(batch.select("date").distinct(), "date", "left_semi")
    both = old.withColumn("_seq", F.lit(-1)).unionByName(batch.withColumn("_seq", F.lit(seq)))
    merged = upsert_first_last(both.withColumn("_at", F.col("timestamp")), "result_id", ["_seq", "_at"])
    checkpoint_root(spark)
    (merged.checkpoint().write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(results_path))


def hourly_rollup_stream(results: DataFrame, delay: str = C.WATERMARK_DELAY) -> DataFrame:
    """Continuous hourly rollup: tumbling 1-hour event-time windows per grid,
    bounded by a watermark (emit with outputMode 'update' or 'append')."""
    ts = F.col("timestamp").cast("timestamp")
    h = F.lit(C.HOURLY_INTERVAL_H)

    def energy(c):
        return F.sum(F.col(c)) * h

    return (results.withColumn("timestamp", ts).withWatermark("timestamp", delay)
            .groupBy("location", F.window("timestamp", "1 hour").alias("w"))
            .agg(F.avg(F.col("solar_power")).alias("avg_solar_power"),
                 F.avg(F.col("wind_power")).alias("avg_wind_power"),
                 energy("total_power").alias("total_energy_generated"),
                 energy("battery_charge_rate").alias("total_battery_charged"),
                 energy("battery_discharge_rate").alias("total_battery_discharged"),
                 energy("grid_import").alias("total_grid_import"),
                 energy("grid_export").alias("total_grid_export"),
                 F.avg("efficiency_score").alias("avg_efficiency_score"),
                 F.sum(F.col("estimated_cost")).alias("total_cost"),
                 F.count(F.lit(1)).alias("record_count"))
            .select("location", F.col("w.start").alias("hour_timestamp"), *[
                c for c in ("avg_solar_power", "avg_wind_power", "total_energy_generated", "total_battery_charged",
                            "total_battery_discharged", "total_grid_import", "total_grid_export",
                            "avg_efficiency_score", "total_cost", "record_count")]))


def refresh_daily_table(batch: DataFrame, results_path: str, daily_path: str) -> None:
    """Periodic daily rollup: recompute the dates touched by a micro-batch from
    the stored results and overwrite only those date partitions. Results are
    stored by the date of ``original_timestamp``, so that filter prunes the scan;
    the day before is read as well, for results that were stamped later."""
    results_like = batch.withColumn("date", F.to_date("original_timestamp"))
    days = batch.select(F.to_date("timestamp").alias("day")).distinct()
    results = _around(_stored(batch.sparkSession, results_path, results_like), batch).join(
        days, F.to_date("timestamp") == F.col("day"), "left_semi")
    _write_days(results, daily_path)


def _around(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored results of the dates a batch touches and of the days before these."""
    days = batch.select(F.to_date("timestamp").alias("day")).distinct()
    origin = batch.select(F.to_date("original_timestamp").alias("date")).distinct().unionByName(
        days.select(F.col("day").alias("date"))).unionByName(days.select(F.date_sub("day", 1).alias("date"))).distinct()
    return stored.join(origin, "date", "left_semi").drop("date")


def _write_days(results: DataFrame, daily_path: str) -> None:
    checkpoint_root(results.sparkSession)
    (daily_summary(results).checkpoint().write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(daily_path))


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def committed_results(spark, results_path: str, schema: str) -> DataFrame:
    """The results of a control job with buckets, one row per result."""
    return delta_store.read(spark, results_path, schema).drop("date")


def committed_events(spark, results_path: str, events_path: str) -> DataFrame:
    """Its events, of the epochs that count."""
    return spark.read.parquet(events_path).where(F.col("epoch") <= delta_store.committed(spark, results_path))


def append_epoch(df: DataFrame, path: str, epoch: int) -> None:
    """Append a micro-batch as the partition of its epoch; running the epoch
    again replaces that partition instead of repeating its rows."""
    (df.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("epoch").parquet(path))


def start_control_stream(readings: DataFrame, results_path: str, events_path: str, checkpoint: str,
                         scope: str = "location", trigger: dict | None = None, daily_path: str | None = None,
                         rejected_path: str | None = None, buckets: int | None = None,
                         rollup_path: str | None = None):
    """The control job. With ``buckets`` the results are a ``delta_store`` of that
    many buckets a date: an epoch adds its deliveries and rewrites nothing, and it
    counts, in all sinks, once its number is written last (``committed_results``,
    ``committed_events``); ``rollup_path`` then keeps hourly and daily rollups as
    signed partial sums (``rollup_store``). Without buckets, touched dates of a plain
    table are rewritten. Bound micro-batches at the source (``maxOffsetsPerTrigger``
    or ``maxFilesPerTrigger``): the battery state reads one battery's rows of a
    micro-batch at once. ``rejected_path`` starts a second query that keeps
    invalid readings with their errors; it is returned as ``.rejected``."""
    results = control_results_stream(readings, scope)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        try:
            if buckets:
                delta_store.append(batch, results_path, int(epoch_id), buckets)
                append_epoch(system_events(batch), events_path, int(epoch_id))
                if daily_path:
                    days = batch.select(F.to_date("timestamp").alias("day")).distinct()
                    stored = _around(delta_store.read(batch.sparkSession, results_path, ddl(batch), upto=int(epoch_id)), batch)
                    _write_days(stored.join(days, F.to_date("timestamp") == F.col("day"), "left_semi"), daily_path)
                if rollup_path:
                    rollup_store.append(batch, results_path, rollup_path, int(epoch_id), ddl(batch))
                delta_store.commit(batch.sparkSession, results_path, int(epoch_id))
                return
            merge_results(batch, results_path, int(epoch_id))
            append_epoch(system_events(batch), events_path, int(epoch_id))
            if daily_path:
                refresh_daily_table(batch, results_path, daily_path)
        finally:
            batch.unpersist()

    when = trigger or {"availableNow": True}
    w = results.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    query = w.trigger(**when).start()
    query.rejected = None
    if rejected_path:
        query.rejected = (rejected_readings(readings).writeStream.format("parquet").option("path", rejected_path)
                          .option("checkpointLocation", f"{checkpoint.rstrip('/')}-rejected").trigger(**when).start())
    return query
