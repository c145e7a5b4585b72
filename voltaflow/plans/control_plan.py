"""The control plan: readings -> requests -> dispatch -> results.

One shuffle (the ranges of battery and time, which are materialised); everything
else is narrow and fuses into whole-stage codegen around the Arrow fold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltaflow.operators.control import control_metrics, flatten_results, grid_interaction
from voltaflow.operators.dispatch import battery_dispatch, tariff_load_balance
from voltaflow.operators.features import normalize_readings, optimization_requests
from voltaflow.operators.quality import detect_anomalies, valid_predicate
from voltaflow.sources.bridge import power_readings


# columns carried through the battery fold (everything the result needs)
DISPATCH_CARRY = ("event_id", "ts", "location", "request_id", "original_timestamp", "solar_power", "wind_power",
                  "total_power", "quality_score", "electricity_price", "estimated_load", "power_balance")


def requests_from_readings(readings: DataFrame) -> DataFrame:
    """validate -> keep valid -> anomalies -> normalise -> request columns."""
    valid = readings.filter(valid_predicate())
    return optimization_requests(normalize_readings(detect_anomalies(valid)))


def dispatch_requests(requests: DataFrame, scope: str = "location", profile_df: DataFrame | None = None,
                      initial_state: DataFrame | None = None, **dispatch_opts) -> DataFrame:
    """tariff -> load -> balance -> battery fold -> grid -> metrics (wide frame)."""
    df = tariff_load_balance(requests, profile_df)
    # the Python fold is opaque to column pruning: ship only what later steps read
    df = df.select(*DISPATCH_CARRY)
    df = battery_dispatch(df, scope=scope, initial_state=initial_state, **dispatch_opts)
    return control_metrics(grid_interaction(df))


def control_results_from_readings(readings: DataFrame, scope: str = "location") -> DataFrame:
    return flatten_results(dispatch_requests(requests_from_readings(readings), scope=scope))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_from_readings(power_readings(spark, sf_dir))


def dispatched(spark: SparkSession, sf_dir: str, scope: str = "location", **dispatch_opts) -> DataFrame:
    return dispatch_requests(requests(spark, sf_dir), scope=scope, **dispatch_opts)


def control_results(spark: SparkSession, sf_dir: str, scope: str = "location") -> DataFrame:
    return flatten_results(dispatched(spark, sf_dir, scope))
