"""Table and message schemas (DDL strings) of the stored tables and logs."""

CONTROL_RESULTS_DDL = (
    "result_id string, request_id string, location string, timestamp timestamp_ntz, "
    "original_timestamp timestamp_ntz, solar_power double, wind_power double, total_power double, "
    "battery_charge_rate double, battery_discharge_rate double, battery_soc double, grid_import double, "
    "grid_export double, load_shedding double, renewable_curtailment double, estimated_cost double, "
    "efficiency_score double, renewable_utilization double, grid_dependency double, electricity_price double, "
    "quality_score double")

HOURLY_AGGREGATES_DDL = (
    "location string, hour_timestamp timestamp_ntz, avg_solar_power double, avg_wind_power double, "
    "total_energy_generated double, total_battery_charged double, total_battery_discharged double, "
    "total_grid_import double, total_grid_export double, avg_efficiency_score double, total_cost double, "
    "record_count bigint")

DAILY_SUMMARY_DDL = (
    "location string, date date, total_solar_energy double, total_wind_energy double, "
    "total_energy_generated double, total_grid_import double, total_grid_export double, "
    "avg_efficiency_score double, max_efficiency_score double, min_efficiency_score double, total_cost double, "
    "peak_power double, min_power double, total_energy_consumed double, total_revenue double, net_profit double")

SYSTEM_EVENTS_DDL = (
    "event_type string, severity string, location string, description string, metric_value double, "
    "event_data string, timestamp timestamp_ntz, result_id string")

MICROGRIDS_DDL = (
    "location string, name string, battery_capacity double, battery_max_charge double, "
    "battery_max_discharge double, grid_max_import double, grid_max_export double, peak_load double, "
    "latitude decimal(10,8), longitude decimal(11,8)")

CONSUMED_MESSAGES_DDL = (
    "topic string, partition int, offset bigint, timestamp timestamp_ntz, key string, transaction_date string, "
    "transaction_hour int, region string, solar_generation_mwh double, consumed_at timestamp_ntz")

CONSUMPTION_STATS_DDL = (
    "topic string, messages_seen bigint, start_time timestamp_ntz, end_time timestamp_ntz, "
    "messages_inserted bigint, avg_processing_time_ms double")

POWER_READING_DDL = ("event_id bigint, ts timestamp_ntz, location string, solar_power double, wind_power double, "
                     "temperature double, wind_speed double")

TABLES = {
    "control_results": CONTROL_RESULTS_DDL,
    "hourly_aggregates": HOURLY_AGGREGATES_DDL,
    "daily_summary": DAILY_SUMMARY_DDL,
    "system_events": SYSTEM_EVENTS_DDL,
    "microgrids": MICROGRIDS_DDL,
    "consumed_messages": CONSUMED_MESSAGES_DDL,
    "consumption_stats": CONSUMPTION_STATS_DDL,
}


def create_tables(spark, location_root: str) -> None:
    """Optional: register the tables as Parquet tables under ``location_root``."""
    for name, ddl in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet "
                  f"LOCATION '{location_root.rstrip('/')}/{name}'")
