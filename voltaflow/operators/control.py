"""Grid interaction, demand response, metrics and the control result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaflow.functions import constants as C

# JSON text keeps full microsecond timestamps (the default format stops at millis)
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

RESULT_COLUMNS = (
    "result_id", "request_id", "location", "timestamp", "original_timestamp",
    "solar_power", "wind_power", "total_power",
    "battery_charge_rate", "battery_discharge_rate", "battery_soc",
    "grid_import", "grid_export", "load_shedding", "renewable_curtailment",
    "estimated_cost", "efficiency_score", "renewable_utilization",
    "grid_dependency", "electricity_price", "quality_score",
)


def grid_interaction(df: DataFrame) -> DataFrame:
    """Grid import/export after the battery, then load shedding and curtailment.

    net > 0 exports only when price > 80 (otherwise the surplus is left
    unallocated, kept in ``unallocated_surplus``); net <= 0 imports |net|.
    Import above 2000 kW sheds min(import - 2000, 0.2 * load); export above
    3000 kW is curtailed to 3000.
    """
    # one projection of nested expressions (one analysis pass instead of five);
    # repeated subexpressions are shared by codegen's subexpression elimination
    net = F.col("power_balance") - F.col("battery_charge_rate") + F.col("battery_discharge_rate")
    price = F.col("electricity_price")
    imp0 = F.when(net > 0, F.lit(0.0)).otherwise(F.abs(net))
    exp0 = F.when((net > 0) & (price > C.EXPORT_PRICE_ABOVE), net).otherwise(F.lit(0.0))
    shed = F.when(imp0 > C.SHED_IMPORT_ABOVE,
                  F.least(imp0 - F.lit(C.SHED_IMPORT_ABOVE),
                          F.col("estimated_load") * F.lit(C.SHED_LOAD_FRACTION))).otherwise(F.lit(0.0))
    over = exp0 > C.EXPORT_LIMIT_KW
    return df.withColumns({
        "load_shedding": shed,
        "renewable_curtailment": F.when(over, exp0 - F.lit(C.EXPORT_LIMIT_KW)).otherwise(F.lit(0.0)),
        "grid_export": F.when(over, F.lit(C.EXPORT_LIMIT_KW)).otherwise(exp0),
        "unallocated_surplus": F.when((net > 0) & (price <= C.EXPORT_PRICE_ABOVE), net).otherwise(F.lit(0.0)),
        "grid_import": imp0 - shed,
    })


def control_metrics(df: DataFrame) -> DataFrame:
    """Cost, efficiency score, renewable utilisation and grid dependency."""
    price = F.col("electricity_price")
    total = F.col("total_power")
    cost = F.col("grid_import") * price - F.col("grid_export") * price * F.lit(C.EXPORT_PRICE_FACTOR)
    eff = ((total - F.col("renewable_curtailment")) / F.greatest(total, F.lit(1.0))) * \
        (F.lit(1.0) - F.col("load_shedding") / F.greatest(F.col("estimated_load"), F.lit(1.0)))
    util = F.lit(1.0) - F.col("renewable_curtailment") / F.greatest(total, F.lit(1.0))
    dep = F.col("grid_import") / F.greatest(F.col("grid_import") + total, F.lit(1.0))
    return df.withColumns({"estimated_cost": cost, "efficiency_score": eff,
                           "renewable_utilization": util, "grid_dependency": dep})


def flatten_results(df: DataFrame, time_col: str = "ts", keep: tuple[str, ...] = ()) -> DataFrame:
    """The 21-column stored control result (SOC as a percentage), plus ``keep``."""
    return df.select(
        F.concat(F.lit("ctrl_"), F.col("request_id")).alias("result_id"),
        "request_id", "location",
        F.col(time_col).alias("timestamp"),
        F.col("original_timestamp"),
        "solar_power", "wind_power", "total_power",
        "battery_charge_rate", "battery_discharge_rate",
        (F.col("soc_after") * F.lit(100.0)).alias("battery_soc"),
        "grid_import", "grid_export", "load_shedding", "renewable_curtailment",
        "estimated_cost", "efficiency_score", "renewable_utilization", "grid_dependency",
        "electricity_price", "quality_score", *keep,
    )


def result_struct_cols() -> list:
    """Column expressions of the nested control-result message."""
    return [
        F.col("result_id"), F.col("request_id"), F.col("timestamp"), F.col("location"),
        F.struct(F.col("solar_power").alias("solar"), F.col("wind_power").alias("wind"),
                 F.col("total_power").alias("total")).alias("power_data"),
        F.struct(
            F.struct(F.col("battery_charge_rate").alias("charge_rate"),
                     F.col("battery_discharge_rate").alias("discharge_rate"),
                     F.col("battery_soc").alias("current_soc"),
                     F.lit(C.BATTERY_CAPACITY_KWH).alias("capacity")).alias("battery"),
            F.struct(F.col("grid_import").alias("import"), F.col("grid_export").alias("export")).alias("grid"),
            F.struct("load_shedding", "renewable_curtailment").alias("demand_response"),
        ).alias("control_strategy"),
        F.struct("estimated_cost", "efficiency_score", "renewable_utilization", "grid_dependency").alias("metrics"),
        F.struct("electricity_price", "quality_score").alias("optimization_params"),
        F.col("original_timestamp"),
    ]


def result_struct(results: DataFrame) -> DataFrame:
    """Nested control-result message from the flat result frame."""
    return results.select(*result_struct_cols())


def result_json(results: DataFrame) -> DataFrame:
    """(result_id, value) with the nested result encoded as JSON text."""
    return results.select("result_id", F.to_json(F.struct(*result_struct_cols()), JSON_OPTIONS).alias("value"))


def parse_result_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode JSON control results back to the flat 21 columns."""
    schema = ("result_id string, request_id string, timestamp string, location string, "
              "power_data struct<solar:double,wind:double,total:double>, "
              "control_strategy struct<battery:struct<charge_rate:double,discharge_rate:double,"
              "current_soc:double,capacity:double>,grid:struct<import:double,export:double>,"
              "demand_response:struct<load_shedding:double,renewable_curtailment:double>>, "
              "metrics struct<estimated_cost:double,efficiency_score:double,renewable_utilization:double,"
              "grid_dependency:double>, optimization_params struct<electricity_price:double,quality_score:double>, "
              "original_timestamp string")
    r = F.from_json(F.col(value_col), schema)
    ts = lambda c: F.regexp_replace(c, "Z$", "").try_cast("timestamp_ntz")
    return df.select(r.alias("r")).select(
        "r.result_id", "r.request_id", "r.location",
        ts(F.col("r.timestamp")).alias("timestamp"),
        ts(F.col("r.original_timestamp")).alias("original_timestamp"),
        F.col("r.power_data.solar").alias("solar_power"),
        F.col("r.power_data.wind").alias("wind_power"),
        F.col("r.power_data.total").alias("total_power"),
        F.col("r.control_strategy.battery.charge_rate").alias("battery_charge_rate"),
        F.col("r.control_strategy.battery.discharge_rate").alias("battery_discharge_rate"),
        F.col("r.control_strategy.battery.current_soc").alias("battery_soc"),
        F.col("r.control_strategy.grid.import").alias("grid_import"),
        F.col("r.control_strategy.grid.export").alias("grid_export"),
        F.col("r.control_strategy.demand_response.load_shedding").alias("load_shedding"),
        F.col("r.control_strategy.demand_response.renewable_curtailment").alias("renewable_curtailment"),
        F.col("r.metrics.estimated_cost").alias("estimated_cost"),
        F.col("r.metrics.efficiency_score").alias("efficiency_score"),
        F.col("r.metrics.renewable_utilization").alias("renewable_utilization"),
        F.col("r.metrics.grid_dependency").alias("grid_dependency"),
        F.col("r.optimization_params.electricity_price").alias("electricity_price"),
        F.col("r.optimization_params.quality_score").alias("quality_score"),
    )
