"""Boundary tables for every rule (hour, power, speed, temperature, SOC, price...)."""

import math

import pytest
from pyspark.sql import functions as F

from voltaflow.functions.exprs import solar_efficiency, tariff_price, wind_efficiency
from voltaflow.operators import alerts, control, dispatch, quality

READING = ("event_id long, ts timestamp_ntz, location string, solar_power double, wind_power double, "
           "temperature double, wind_speed double")


def _readings(spark, rows):
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    out = []
    for i, (hour, solar, wind, temp, speed) in enumerate(rows):
        out.append((i, base.replace(hour=hour), "MicroGrid-01", solar, wind, temp, speed))
    return spark.createDataFrame(out, READING)


def test_validation_bounds(spark):
    vals = [-0.01, 0.0, 10000.0, 10000.01, float("nan"), None]
    df = _readings(spark, [(12, v, 1.0, 20.0, 5.0) for v in vals])
    got = {r.event_id: (r.is_valid, list(r.errors)) for r in quality.validate_readings(df).collect()}
    assert got[0] == (False, ["Solar power cannot be negative"])
    assert got[1] == (True, [])
    assert got[2] == (True, [])
    assert got[3] == (False, ["Solar power exceeds maximum capacity"])
    assert got[4] == (False, ["Solar power is not a finite number"])
    assert got[5] == (False, ["Missing required field: solar_power"])
    # the boolean filter used by the plan agrees with the error list
    flags = {r.event_id: r.ok for r in df.select("event_id", quality.valid_predicate().alias("ok")).collect()}
    assert all(bool(flags[k]) == got[k][0] for k in got)


def test_anomaly_bounds(spark):
    rows = [(5, 10.01, 0.0, 20.0, 5.0), (6, 10.01, 0.0, 20.0, 5.0), (19, 10.01, 0.0, 20.0, 5.0),
            (20, 10.01, 0.0, 20.0, 5.0), (20, 10.0, 0.0, 20.0, 5.0),
            (12, 0.0, 100.01, 20.0, 2.99), (12, 0.0, 100.01, 20.0, 3.0), (12, 0.0, 100.0, 20.0, 2.99),
            (12, 0.0, 100.01, 20.0, None)]
    got = [(r.n_anomalies, [a.type for a in r.anomalies])
           for r in quality.detect_anomalies(_readings(spark, rows)).orderBy("event_id").collect()]
    assert got == [(1, ["solar_night_generation"]), (0, []), (0, []), (1, ["solar_night_generation"]), (0, []),
                   (1, ["wind_power_mismatch"]), (0, []), (0, []), (0, [])]


@pytest.mark.parametrize("temp,expected", [(-80.0, 0.5), (25.0, 1.0), (125.0, 0.5), (-75.0, 0.5), (35.0, 0.95),
                                           (None, 1.0)])
def test_solar_efficiency(spark, temp, expected):
    v = spark.createDataFrame([(temp,)], "t double").select(solar_efficiency(F.col("t"))).first()[0]
    assert math.isclose(v, expected)


@pytest.mark.parametrize("speed,expected", [(2.99, 0.0), (3.0, 0.2), (14.99, 14.99 / 15), (15.0, 1.0),
                                            (22.0, 0.3), (30.0, 0.3), (16.0, 0.9), (None, 1.0)])
def test_wind_efficiency(spark, speed, expected):
    v = spark.createDataFrame([(speed,)], "s double").select(wind_efficiency(F.col("s"))).first()[0]
    assert math.isclose(v, expected, rel_tol=1e-12)


def test_tariff_all_hours(spark):
    expected = {h: (150.0 if (9 <= h <= 11 or 17 <= h <= 21) else 100.0 if (7 <= h <= 9 or 11 <= h <= 17) else 60.0)
                for h in range(24)}
    got = {r.hour: r.electricity_price for r in dispatch.tariff_dim(spark).collect()}
    assert got == expected
    assert got[9] == 150.0 and got[11] == 150.0 and got[17] == 150.0 and got[8] == 100.0 and got[22] == 60.0
    v = spark.range(1).select(tariff_price(F.lit(12))).first()[0]
    assert v == 100.0


def test_load_estimate(spark):
    rows = [("MicroGrid-01", 9, False), ("MicroGrid-01", 19, True), ("MicroGrid-02", 3, True),
            ("MicroGrid-03", 8, True), ("MicroGrid-03", 12, False), ("MicroGrid-03", 23, False),
            ("MicroGrid-04", 12, True), ("InvalidGrid", 12, False)]
    df = spark.createDataFrame(rows, "location string, hour int, is_weekend boolean")
    got = [r.estimated_load for r in dispatch.estimate_load(df).collect()]
    assert got == [2000.0, 800.0 * 0.3, 3000.0 * 0.5, 1500.0 * 1.2, 600.0, 400.0, 1000.0, 1000.0]


def _grid(spark, rows):
    schema = ("power_balance double, battery_charge_rate double, battery_discharge_rate double, "
              "electricity_price double, estimated_load double, total_power double")
    return control.control_metrics(control.grid_interaction(spark.createDataFrame(rows, schema))).collect()


def test_grid_shedding_and_curtailment(spark):
    r = _grid(spark, [(-2000.0, 0.0, 0.0, 150.0, 3000.0, 1000.0),     # import exactly 2000: no shed
                      (-2000.01, 0.0, 0.0, 150.0, 3000.0, 999.99),    # shed 0.01
                      (-5000.0, 0.0, 0.0, 150.0, 1000.0, 0.0),        # shed capped at 0.2*load
                      (3000.0, 0.0, 0.0, 100.0, 1000.0, 4000.0),      # export exactly 3000
                      (3000.01, 0.0, 0.0, 100.0, 1000.0, 4000.01),    # curtail 0.01
                      (500.0, 0.0, 0.0, 60.0, 1000.0, 1500.0),        # price 60: surplus unallocated
                      (0.0, 0.0, 0.0, 60.0, 1000.0, 1000.0)])         # net 0 -> import 0
    assert (r[0].grid_import, r[0].load_shedding) == (2000.0, 0.0)
    assert math.isclose(r[1].load_shedding, 0.01, abs_tol=1e-9) and math.isclose(r[1].grid_import, 2000.0)
    assert (r[2].load_shedding, r[2].grid_import) == (200.0, 4800.0)
    assert (r[3].grid_export, r[3].renewable_curtailment) == (3000.0, 0.0)
    assert r[4].grid_export == 3000.0 and math.isclose(r[4].renewable_curtailment, 0.01, abs_tol=1e-9)
    assert (r[5].grid_export, r[5].grid_import, r[5].unallocated_surplus) == (0.0, 0.0, 500.0)
    assert (r[6].grid_import, r[6].grid_export) == (0.0, 0.0)
    # cost / efficiency definitions
    assert r[2].estimated_cost == 4800.0 * 150.0
    assert math.isclose(r[2].efficiency_score, (0.0 / 1.0) * (1 - 200.0 / 1000.0))
    assert math.isclose(r[4].renewable_utilization, 1 - r[4].renewable_curtailment / 4000.01)


def test_energy_balance_invariant(spark):
    from tests.conftest import SF_SMALL
    from voltaflow.plans import control_plan as P
    df = P.dispatched(spark, SF_SMALL)
    bad = df.filter(
        (F.col("battery_charge_rate") * F.col("battery_discharge_rate") != 0)
        | (F.abs((F.col("total_power") - F.col("estimated_load") - F.col("battery_charge_rate")
                  + F.col("battery_discharge_rate"))
                 - (F.col("grid_export") + F.col("renewable_curtailment") + F.col("unallocated_surplus")
                    - F.col("grid_import") - F.col("load_shedding"))) > 1e-6)).count()
    assert bad == 0


def test_alert_bounds(spark):
    schema = ("result_id string, location string, timestamp timestamp_ntz, efficiency_score double, "
              "grid_dependency double, load_shedding double, renewable_curtailment double, battery_soc double")
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows = [("a", "g", t, 0.4999, 0.7, 0.0, 0.0, 19.99), ("b", "g", t, 0.5, 0.7001, 0.0, 0.0, 20.0),
            ("c", "g", t, 0.9, 0.1, 1.0, 1.0, 95.0), ("d", "g", t, 0.9, 0.1, 0.0, 0.0, 95.01)]
    ev = alerts.system_events(spark.createDataFrame(rows, schema), with_payload=False).collect()
    got = sorted((e.result_id, e.event_type, e.severity) for e in ev)
    assert got == [("a", "LOW_BATTERY", "WARNING"), ("a", "LOW_EFFICIENCY", "WARNING"),
                   ("b", "HIGH_GRID_DEPENDENCY", "INFO"), ("c", "LOAD_SHEDDING", "WARNING"),
                   ("c", "RENEWABLE_CURTAILMENT", "INFO"), ("d", "BATTERY_FULL", "INFO")]
