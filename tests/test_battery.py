"""Battery dispatch vs an independent pure-Python fold; scopes; resume from state."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from voltaflow.operators import dispatch
from voltaflow.plans import control_plan as P


def reference_fold(rows, initial_soc=0.5, caps=None):
    """Written from the rules: one SOC per key, rows in (ts, id) order."""
    soc = {}
    out = {}
    for key, _ts, eid, bal, price in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        s = soc.get(key, initial_soc)
        c = d = 0.0
        cap, most_c, most_d = (caps or {}).get(key, (5000, 1000, 1000))
        if bal > 0:
            if s < 0.9 and price < 100:
                c = min(bal, most_c, cap * (1 - s))
                s += (c * 0.95) / cap
        elif s > 0.2 and (price > 100 or abs(bal) > 500):
            d = min(abs(bal), most_d, cap * s)
            s -= d / (cap * 0.95)
        soc[key] = s
        out[eid] = (c, d, s)
    return out


def _pre(spark, sf=SF_SMALL):
    req = P.requests(spark, sf)
    return dispatch.power_balance(dispatch.estimate_load(dispatch.with_tariff(req))).select(*P.DISPATCH_CARRY)


@pytest.mark.parametrize("scope", ["location", "engine"])
def test_fold_matches_reference(spark, scope):
    pre = _pre(spark)
    rows = [((r.location if scope == "location" else "engine"), r.ts, r.event_id, r.power_balance,
             r.electricity_price) for r in pre.collect()]
    expected = reference_fold(rows)
    got = {r.event_id: (r.battery_charge_rate, r.battery_discharge_rate, r.soc_after)
           for r in dispatch.battery_dispatch(pre, scope=scope).collect()}
    assert got == expected  # bit-for-bit


def test_resume_from_state_equals_full_run(spark):
    pre = _pre(spark)
    import datetime as dt
    cut = dt.datetime(2024, 1, 15)
    full = dispatch.battery_dispatch(pre)
    first = dispatch.battery_dispatch(pre.filter(F.col("ts") <= cut))
    state = dispatch.battery_state(first)
    second = dispatch.battery_dispatch(pre.filter(F.col("ts") > cut), initial_state=state)
    a = {r.event_id: r.soc_after for r in full.filter(F.col("ts") > cut).collect()}
    b = {r.event_id: r.soc_after for r in second.collect()}
    assert a == b and len(a) > 0


def test_soc_may_go_below_zero_unclamped(spark):
    # discharging 5000*soc ignores the efficiency loss: soc goes slightly negative
    df = _rows(spark, [("a", 0, k, -2000.0, 150.0) for k in range(4)])
    got = [r.soc_after for r in dispatch.battery_dispatch(df, initial_soc=0.25).orderBy("event_id").collect()]
    assert got[0] == 0.25 - 1000.0 / 4750.0
    low = [r.soc_after for r in dispatch.battery_dispatch(df, initial_soc=0.2001).orderBy("event_id").collect()]
    assert low[0] < 0


def _rows(spark, rows):
    """(key, minute, id, balance, price); a null minute is a null time."""
    df = spark.createDataFrame(rows, "location string, minute int, event_id long, power_balance double, "
                                     "electricity_price double")
    return df.withColumn("ts", F.expr("timestamp_ntz'2024-01-15 00:00:00' + make_dt_interval(0, 0, minute, 0)")).drop("minute")


def _result(df):
    return {r.event_id: (r.battery_charge_rate, r.battery_discharge_rate, r.soc_after) for r in df.collect()}


@pytest.mark.parametrize("scope,rows", [("engine", 300), ("location", 100), ("location", 5000)])
def test_ranges_are_bit_exact(spark, scope, rows):
    pre = _pre(spark)
    stats = {}
    a = _result(dispatch.battery_dispatch(pre, scope=scope, method="serial"))
    b = _result(dispatch.battery_dispatch(pre, scope=scope, chunk_rows=rows, stats=stats, exact=True))
    assert a == b
    assert stats["method"] == "ranged"
    if scope == "engine":
        assert stats["partitions"] > 1 and stats["continued"] == stats["partitions"] - 1 and stats["rounds"] >= 1


def test_rows_with_null_key_or_time_stay(spark):
    rows = [(k, m, n, b, 60.0 if n % 2 else 150.0) for n, (k, m, b) in enumerate(
        (k, m, b) for k in ("a", None, "b") for m in (None, None, 3, 1, 2, 9) for b in (900.0, -700.0, 40.0))]
    df = _rows(spark, rows)
    serial = _result(dispatch.battery_dispatch(df, method="serial"))
    default = _result(dispatch.battery_dispatch(df, exact=True))
    tiny = _result(dispatch.battery_dispatch(df, chunk_rows=4, exact=True))
    assert len(serial) == len(rows) and serial == default == tiny


def test_one_battery_on_one_day_is_cut_into_many_ranges(spark):
    rows = [("a", m, m, 3000.0 * (-1) ** (m // 7), 60.0 if m % 3 else 150.0) for m in range(967)]
    df, stats = _rows(spark, rows), {}
    ranged = _result(dispatch.battery_dispatch(df, chunk_rows=50, stats=stats, exact=True))
    assert 15 <= stats["partitions"] <= 25
    assert ranged == _result(dispatch.battery_dispatch(df, method="serial"))


def _close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], abs=1e-9, rel=1e-9), k


#: Passes over the ranges before the last fold: ends of runs, maps, comparison, refinement.
PASSES = 3 + dispatch.REFINE


@pytest.mark.parametrize("ranges", [10, 39, 400])
def test_passes_do_not_grow_with_the_ranges(spark, ranges):
    """Small alternating steps never saturate, so guessed starts never merge with the true ones."""
    rows = [("a", m, m, 1.0 if m % 2 else -1.0, 60.0 if m % 2 else 150.0) for m in range(4000)]
    df, stats = _rows(spark, rows), {}
    ranged = _result(dispatch.battery_dispatch(df, chunk_rows=4000 // ranges, initial_soc=0.37, stats=stats))
    assert stats["partitions"] >= 0.9 * ranges and stats["rounds"] <= PASSES
    _close(ranged, _result(dispatch.battery_dispatch(df, method="serial", initial_soc=0.37)))


@pytest.mark.parametrize("rows", [2500, 500, 250])
def test_passes_on_given_readings(spark, rows):
    pre, stats = _pre(spark, SF_MID), {}
    ranged = _result(dispatch.battery_dispatch(pre, scope="engine", chunk_rows=rows, stats=stats))
    assert stats["rounds"] <= PASSES
    serial = _result(dispatch.battery_dispatch(pre, scope="engine", method="serial"))
    _close(ranged, serial)
    assert rows < 2500 or ranged == serial  # long ranges saturate, which leaves no rounding


def test_batteries_that_never_saturate_resolve_range_by_range(spark):
    # small alternating steps: guessed starts never merge with the true ones
    rows = [(k, m, n, 1.0 if m % 2 else -1.0, 60.0 if m % 2 else 150.0)
            for n, (k, m) in enumerate((k, m) for k in ("a", "b") for m in range(120))]
    df, stats = _rows(spark, rows), {}
    serial = _result(dispatch.battery_dispatch(df, method="serial", initial_soc=0.37))
    _close(_result(dispatch.battery_dispatch(df, chunk_rows=20, initial_soc=0.37, stats=stats)), serial)
    assert 1 < stats["rounds"] <= PASSES
    assert _result(dispatch.battery_dispatch(df, chunk_rows=20, initial_soc=0.37, exact=True)) == serial
    state = dispatch.battery_state(dispatch.battery_dispatch(df.where("event_id < 60 or event_id between 120 and 180"), exact=True))
    rest = df.where("event_id between 60 and 119 or event_id > 180")
    whole = _result(dispatch.battery_dispatch(df, exact=True))
    assert _result(dispatch.battery_dispatch(rest, initial_state=state, chunk_rows=15, exact=True)) == {
        k: v for k, v in whole.items() if 60 <= k < 120 or k > 180}


def test_start_outside_the_maps_and_nan_rows(spark):
    nan = float("nan")
    rows = [("a", m, m, 400.0 * (-1) ** (m // 3), 60.0 if m % 3 else 150.0) for m in range(200)]
    for soc in (3.0, -2.0, nan):
        ranged = _result(dispatch.battery_dispatch(_rows(spark, rows), chunk_rows=20, initial_soc=soc, exact=True))
        serial = _result(dispatch.battery_dispatch(_rows(spark, rows), method="serial", initial_soc=soc))
        assert str(ranged) == str(serial) if soc != soc else ranged == serial
    odd = [(k, m, n, nan if n == 130 else b, p) for k, m, n, b, p in rows]
    assert str(sorted(_result(dispatch.battery_dispatch(_rows(spark, odd), chunk_rows=20, exact=True)).items())) == str(
        sorted(_result(dispatch.battery_dispatch(_rows(spark, odd), method="serial")).items()))


def test_load_noise_has_the_sigma_of_its_band(spark):
    mean = {(r.location, r.hour): r.base_load for r in dispatch.load_profile_dim(spark).collect()}
    draws = {}
    for seed in range(60):
        for r in dispatch.load_profile_dim(spark, seed).collect():
            draws.setdefault((r.location, r.hour), []).append(r.base_load - mean[r.location, r.hour])
    sd = {k: (sum(x * x for x in v) / len(v)) ** 0.5 for k, v in draws.items()}
    for key, want in {("MicroGrid-03", 20): 100, ("MicroGrid-03", 12): 50, ("MicroGrid-03", 2): 30, ("MicroGrid-01", 12): 100,
                      ("MicroGrid-01", 2): 50, ("MicroGrid-02", 5): 200, ("MicroGrid-03", 8): 100}.items():
        assert 0.6 * want < sd[key] < 1.5 * want, key
    again = {(r.location, r.hour): r.base_load for r in dispatch.load_profile_dim(spark.newSession(), 3).repartition(5).collect()}
    assert again == {k: mean[k] + v[3] for k, v in draws.items()} or all(
        abs(again[k] - mean[k] - v[3]) < 1e-9 for k, v in draws.items())


@pytest.mark.parametrize("options", [{"method": "serial"}, {"exact": True}, {"chunk_rows": 40, "exact": True}])
def test_parameters_per_battery(spark, options):
    pre = _pre(spark)
    caps = {"MicroGrid-01": (5000.0, 1000.0, 1000.0), "MicroGrid-02": (8000.0, 400.0, 700.0), "MicroGrid-03": (3000.0, 90.0, 50.0)}
    params = spark.createDataFrame([(k, *v) for k, v in caps.items()] + [("MicroGrid-04", None, None, None)],
                                   "battery_key string, battery_capacity double, battery_max_charge double, battery_max_discharge double")
    rows = [(r.location, r.ts, r.event_id, r.power_balance, r.electricity_price) for r in pre.collect()]
    assert _result(dispatch.battery_dispatch(pre, params=params, **options)) == reference_fold(rows, caps=caps)


def test_recent_queries_fold_once_and_the_dimension_never(spark):
    from voltaflow.plans import control_queries as Q

    def folds(q):
        return q(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    assert folds(Q.q_recent_by_location) == folds(Q.q_recent_event_counts) == folds(Q.q_grid_status) == 1
    assert folds(Q.q_microgrid_dim_upsert) == 0
