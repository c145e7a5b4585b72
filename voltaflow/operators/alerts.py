"""Alert rules E1-E6 exploded to 0..n event rows per control result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaflow.functions import constants as C
from voltaflow.operators.control import JSON_OPTIONS, result_struct_cols


def _rule(cond, event_type, severity, value, fmt):
    return F.when(cond, F.struct(F.lit(event_type).alias("event_type"), F.lit(severity).alias("severity"),
                                 value.alias("metric_value"),
                                 F.format_string(fmt, value).alias("description")))


def system_events(results: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per triggered rule: event_type, severity, location, description,
    metric_value, event_data (JSON of the full result), timestamp, result_id.

    LOW_BATTERY and BATTERY_FULL are exclusive (else-if).
    Descriptions use Java formatting, whose half-up rounding can differ
    from other engines in the last digit; ``metric_value`` is exact.
    """
    eff, dep = F.col("efficiency_score"), F.col("grid_dependency")
    shed, curt, soc = F.col("load_shedding"), F.col("renewable_curtailment"), F.col("battery_soc")
    rules = F.filter(F.array(
        _rule(eff < C.LOW_EFFICIENCY_BELOW, "LOW_EFFICIENCY", "WARNING", eff, "Low efficiency score: %.2f"),
        _rule(dep > C.HIGH_DEPENDENCY_ABOVE, "HIGH_GRID_DEPENDENCY", "INFO", dep, "High grid dependency: %.2f"),
        _rule(shed > 0, "LOAD_SHEDDING", "WARNING", shed, "Load shedding activated: %.1f kW"),
        _rule(curt > 0, "RENEWABLE_CURTAILMENT", "INFO", curt, "Renewable curtailment: %.1f kW"),
        _rule(soc < C.LOW_BATTERY_PCT_BELOW, "LOW_BATTERY", "WARNING", soc, "Low battery SOC: %.1f%%"),
        _rule(~(soc < C.LOW_BATTERY_PCT_BELOW) & (soc > C.FULL_BATTERY_PCT_ABOVE), "BATTERY_FULL", "INFO", soc,
              "Battery nearly full: %.1f%%"),
    ), lambda x: x.isNotNull())
    base = results
    cols = [F.col("result_id"), F.col("location"), F.col("timestamp")]
    if with_payload:
        base = results.withColumn("event_data", F.to_json(F.struct(*result_struct_cols()), JSON_OPTIONS))
        cols.append(F.col("event_data"))
    return (base.select(*cols, F.explode(rules).alias("e"))
            .select("e.event_type", "e.severity", "location", "e.description", "e.metric_value",
                    *(["event_data"] if with_payload else []), "timestamp", "result_id"))
