"""Independent DuckDB SQL for the control half (used as the correctness oracle).

The battery fold is a recursive CTE over ``row_number`` per battery, written
from the rules, not from the Spark code path.
"""

from __future__ import annotations

D = "::DOUBLE"


def _num(x) -> str:
    return f"{float(x)!r}{D}"


READINGS = f"""
readings AS (
  SELECT event_id, ts,
    'MicroGrid-0' || CAST(user_id % 4 + 1 AS VARCHAR) AS location,
    CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN -value
         WHEN hour(ts) >= 6 AND hour(ts) <= 18 THEN value * CAST(event_id % 40 AS DOUBLE)
         WHEN event_id % 9 = 0 THEN value * {_num(0.25)}
         ELSE {_num(0)} END AS solar_power,
    value * CAST(user_id % 30 AS DOUBLE) AS wind_power,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 - 90 AS DOUBLE) AS temperature,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 25 AS DOUBLE) AS wind_speed
  FROM events)"""

CHECKED = """
checked AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN solar_power IS NULL THEN 'Missing required field: solar_power' END,
      CASE WHEN wind_power IS NULL THEN 'Missing required field: wind_power' END,
      CASE WHEN location IS NULL THEN 'Missing required field: location' END,
      CASE WHEN ts IS NULL THEN 'Missing required field: timestamp' END,
      CASE WHEN solar_power IS NOT NULL AND NOT isfinite(solar_power) THEN 'Solar power is not a finite number' END,
      CASE WHEN isfinite(solar_power) AND solar_power < 0 THEN 'Solar power cannot be negative' END,
      CASE WHEN isfinite(solar_power) AND solar_power > 10000 THEN 'Solar power exceeds maximum capacity' END,
      CASE WHEN wind_power IS NOT NULL AND NOT isfinite(wind_power) THEN 'Wind power is not a finite number' END,
      CASE WHEN isfinite(wind_power) AND wind_power < 0 THEN 'Wind power cannot be negative' END,
      CASE WHEN isfinite(wind_power) AND wind_power > 10000 THEN 'Wind power exceeds maximum capacity' END
    ) AS errors_text,
    CAST(hour(ts) AS INTEGER) AS hour,
    CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week
  FROM readings),
checked2 AS (
  SELECT *, errors_text = '' AS is_valid,
    CAST(CASE WHEN errors_text = '' THEN 0 ELSE length(errors_text) - length(replace(errors_text, ';', '')) + 1 END
         AS INTEGER) AS n_errors
  FROM checked)"""

REQ = f"""
req AS (
  SELECT event_id, ts, location, solar_power, wind_power, temperature, wind_speed, hour, day_of_week,
    day_of_week >= 5 AS is_weekend,
    solar_power + wind_power AS total_power,
    CASE WHEN temperature IS NULL THEN {_num(1)}
         ELSE greatest({_num(0.5)}, {_num(1)} - {_num(0.005)} * abs(temperature - {_num(25)})) END AS solar_efficiency,
    CASE WHEN wind_speed IS NULL THEN {_num(1)}
         WHEN wind_speed < 3 THEN {_num(0)}
         WHEN wind_speed < 15 THEN least({_num(1)}, wind_speed / {_num(15)})
         ELSE greatest({_num(0.3)}, {_num(1)} - (wind_speed - {_num(15)}) * {_num(0.1)}) END AS wind_efficiency,
    ((hour >= 20 OR hour <= 5) AND solar_power > 10) AS a_night,
    (wind_speed IS NOT NULL AND wind_speed < 3 AND wind_power > 100) AS a_wind,
    location || '_' || CAST(event_id AS VARCHAR) AS request_id
  FROM checked2 WHERE is_valid),
req2 AS (
  SELECT *, CAST(CAST(a_night AS INTEGER) + CAST(a_wind AS INTEGER) AS INTEGER) AS n_anomalies,
    {_num(1)} - CAST(CAST(a_night AS INTEGER) + CAST(a_wind AS INTEGER) AS DOUBLE) * {_num(0.1)} AS quality_score,
    CASE WHEN (hour >= 9 AND hour <= 11) OR (hour >= 17 AND hour <= 21) THEN {_num(150)}
         WHEN (hour >= 7 AND hour <= 9) OR (hour >= 11 AND hour <= 17) THEN {_num(100)}
         ELSE {_num(60)} END AS electricity_price,
    CASE location
      WHEN 'MicroGrid-01' THEN CASE WHEN hour >= 9 AND hour <= 18 THEN {_num(2000)} ELSE {_num(800)} END
      WHEN 'MicroGrid-02' THEN {_num(3000)}
      WHEN 'MicroGrid-03' THEN CASE WHEN (hour >= 7 AND hour <= 9) OR (hour >= 18 AND hour <= 22) THEN {_num(1500)}
                                    WHEN hour >= 10 AND hour <= 17 THEN {_num(600)} ELSE {_num(400)} END
      ELSE {_num(1000)} END AS base_load,
    CASE WHEN is_weekend AND contains(location, 'MicroGrid-01') THEN {_num(0.3)}
         WHEN is_weekend AND contains(location, 'MicroGrid-02') THEN {_num(0.5)}
         WHEN is_weekend AND contains(location, 'MicroGrid-03') THEN {_num(1.2)}
         ELSE {_num(1)} END AS weekend_factor
  FROM req),
req3 AS (
  SELECT *, greatest({_num(0)}, base_load * weekend_factor) AS estimated_load FROM req2),
prep AS (
  SELECT *, total_power - estimated_load AS power_balance,
    {{bkey}} AS bkey,
    row_number() OVER (PARTITION BY {{bkey}} ORDER BY ts, event_id) AS rn
  FROM req3)"""

_CHARGE = (f"CASE WHEN s.power_balance > 0 AND f.soc < 0.9 AND s.electricity_price < 100 "
           f"THEN least(s.power_balance, {_num(1000)}, {_num(5000)} * ({_num(1)} - f.soc)) ELSE {_num(0)} END")
_DIS = (f"CASE WHEN s.power_balance <= 0 AND f.soc > 0.2 AND (s.electricity_price > 100 OR abs(s.power_balance) > 500) "
        f"THEN least(abs(s.power_balance), {_num(1000)}, {_num(5000)} * f.soc) ELSE {_num(0)} END")

FOLD = f"""
fold(bkey, rn, soc, charge, dis) AS (
  SELECT DISTINCT bkey, CAST(0 AS BIGINT), {_num(0.5)}, {_num(0)}, {_num(0)} FROM prep
  UNION ALL
  SELECT s.bkey, s.rn,
    f.soc + ({_CHARGE} * {_num(0.95)}) / {_num(5000)} - ({_DIS}) / ({_num(5000)} * {_num(0.95)}),
    {_CHARGE}, {_DIS}
  FROM fold f JOIN prep s ON s.bkey = f.bkey AND s.rn = f.rn + 1)"""

DISP = f"""
disp AS (
  SELECT p.*, f.charge AS battery_charge_rate, f.dis AS battery_discharge_rate, f.soc AS soc_after,
    p.power_balance - f.charge + f.dis AS net
  FROM prep p JOIN fold f ON p.bkey = f.bkey AND p.rn = f.rn),
grid AS (
  SELECT *,
    CASE WHEN net > 0 THEN {_num(0)} ELSE abs(net) END AS imp0,
    CASE WHEN net > 0 AND electricity_price > 80 THEN net ELSE {_num(0)} END AS exp0,
    CASE WHEN net > 0 AND electricity_price <= 80 THEN net ELSE {_num(0)} END AS unallocated_surplus
  FROM disp),
grid2 AS (
  SELECT *,
    CASE WHEN imp0 > 2000 THEN least(imp0 - {_num(2000)}, estimated_load * {_num(0.2)}) ELSE {_num(0)} END AS load_shedding,
    CASE WHEN exp0 > 3000 THEN exp0 - {_num(3000)} ELSE {_num(0)} END AS renewable_curtailment,
    CASE WHEN exp0 > 3000 THEN {_num(3000)} ELSE exp0 END AS grid_export
  FROM grid),
wide AS (
  SELECT *, imp0 - load_shedding AS grid_import FROM grid2),
wide2 AS (
  SELECT *,
    grid_import * electricity_price - grid_export * electricity_price * {_num(0.9)} AS estimated_cost,
    ((total_power - renewable_curtailment) / greatest(total_power, {_num(1)}))
      * ({_num(1)} - load_shedding / greatest(estimated_load, {_num(1)})) AS efficiency_score,
    {_num(1)} - renewable_curtailment / greatest(total_power, {_num(1)}) AS renewable_utilization,
    grid_import / greatest(grid_import + total_power, {_num(1)}) AS grid_dependency
  FROM wide),
results AS (
  SELECT 'ctrl_' || request_id AS result_id, request_id, location, ts AS "timestamp", ts AS original_timestamp,
    solar_power, wind_power, total_power, battery_charge_rate, battery_discharge_rate,
    soc_after * {_num(100)} AS battery_soc, grid_import, grid_export, load_shedding, renewable_curtailment,
    estimated_cost, efficiency_score, renewable_utilization, grid_dependency, electricity_price, quality_score,
    event_id
  FROM wide2),
sys_events AS (
  SELECT result_id, location, "timestamp", e.event_type, e.severity, e.metric_value FROM results,
  LATERAL (
    SELECT 'LOW_EFFICIENCY' AS event_type, 'WARNING' AS severity, efficiency_score AS metric_value WHERE efficiency_score < 0.5
    UNION ALL SELECT 'HIGH_GRID_DEPENDENCY', 'INFO', grid_dependency WHERE grid_dependency > 0.7
    UNION ALL SELECT 'LOAD_SHEDDING', 'WARNING', load_shedding WHERE load_shedding > 0
    UNION ALL SELECT 'RENEWABLE_CURTAILMENT', 'INFO', renewable_curtailment WHERE renewable_curtailment > 0
    UNION ALL SELECT 'LOW_BATTERY', 'WARNING', battery_soc WHERE battery_soc < 20
    UNION ALL SELECT 'BATTERY_FULL', 'INFO', battery_soc WHERE NOT (battery_soc < 20) AND battery_soc > 95
  ) e)"""

RESULT_COLS = ("result_id, request_id, location, \"timestamp\", original_timestamp, solar_power, wind_power, "
               "total_power, battery_charge_rate, battery_discharge_rate, battery_soc, grid_import, grid_export, "
               "load_shedding, renewable_curtailment, estimated_cost, efficiency_score, renewable_utilization, "
               "grid_dependency, electricity_price, quality_score")


def prefix(scope: str = "location", extra: str = "") -> str:
    bkey = "location" if scope == "location" else "'engine'"
    body = ",".join([READINGS, CHECKED, REQ.replace("{bkey}", bkey), FOLD, DISP])
    if extra:
        body += "," + extra
    return "WITH RECURSIVE" + body + "\n"
