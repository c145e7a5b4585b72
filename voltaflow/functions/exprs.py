"""Column expressions for the control model (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voltaflow.functions import constants as C


def _d(x: float) -> str:
    """A DOUBLE literal in Spark SQL (a bare 0.3 would be DECIMAL)."""
    return f"{float(x)!r}D"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _bands_sql(h: str, bands) -> str:
    return " OR ".join(f"({h} >= {lo} AND {h} <= {hi})" for lo, hi in bands)


def tariff_price_sql(hour: str) -> str:
    h = _q(hour)
    return (f"CASE WHEN {_bands_sql(h, C.PEAK_BANDS)} THEN {_d(C.PEAK_PRICE)} "
            f"WHEN {_bands_sql(h, C.MID_BANDS)} THEN {_d(C.MID_PRICE)} ELSE {_d(C.OFF_PEAK_PRICE)} END")


def load_profile_mean_sql(location: str, hour: str) -> str:
    loc, h = _q(location), _q(hour)
    arms = []
    for name, bands in C.LOAD_PROFILE_BANDS.items():
        inner = " ".join(f"WHEN {h} >= {lo} AND {h} <= {hi} THEN {_d(kw)}" for (lo, hi), kw in bands)
        value = (f"CASE {inner} ELSE {_d(C.LOAD_PROFILE_ELSE[name])} END" if inner
                 else _d(C.LOAD_PROFILE_ELSE[name]))
        arms.append(f"WHEN {loc} = '{name}' THEN {value}")
    return "CASE " + " ".join(arms) + " END"


def weekend_factor_sql(location: str, is_weekend: str) -> str:
    loc, w = _q(location), _q(is_weekend)
    arms = " ".join(f"WHEN {w} AND contains({loc}, '{name}') THEN {_d(f)}" for name, f in C.WEEKEND_FACTORS)
    return f"CASE {arms} ELSE {_d(1.0)} END"


def solar_efficiency_sql(temperature: str) -> str:
    t = _q(temperature)
    return (f"CASE WHEN {t} IS NULL THEN {_d(1.0)} ELSE greatest({_d(C.SOLAR_EFF_FLOOR)}, "
            f"{_d(1.0)} - {_d(C.SOLAR_LOSS_PER_C)} * abs({t} - {_d(C.SOLAR_REF_TEMP_C)})) END")


def wind_efficiency_sql(speed: str) -> str:
    v = _q(speed)
    return (f"CASE WHEN {v} IS NULL THEN {_d(1.0)} WHEN {v} < {_d(C.WIND_CUT_IN)} THEN {_d(0.0)} "
            f"WHEN {v} < {_d(C.WIND_RATED)} THEN least({_d(1.0)}, {v} / {_d(C.WIND_RATED)}) "
            f"ELSE greatest({_d(C.WIND_EFF_FLOOR)}, {_d(1.0)} - ({v} - {_d(C.WIND_RATED)}) * {_d(C.WIND_DECAY_PER_MS)}) END")


def _in_bands(hour: Column, bands) -> Column:
    cond = F.lit(False)
    for lo, hi in bands:
        cond = cond | ((hour >= lo) & (hour <= hi))
    return cond


def tariff_price(hour) -> Column:
    """Electricity price for an hour of day; the first matching band wins.
    A column name builds one SQL expression (one JVM call)."""
    if isinstance(hour, str):
        return F.expr(tariff_price_sql(hour))
    return (F.when(_in_bands(hour, C.PEAK_BANDS), F.lit(C.PEAK_PRICE))
            .when(_in_bands(hour, C.MID_BANDS), F.lit(C.MID_PRICE))
            .otherwise(F.lit(C.OFF_PEAK_PRICE)))


def load_profile_mean(location, hour) -> Column:
    """Mean load (kW) for a known grid and hour; NULL for an unknown grid."""
    if isinstance(location, str) and isinstance(hour, str):
        return F.expr(load_profile_mean_sql(location, hour))
    expr = None
    for loc, bands in C.LOAD_PROFILE_BANDS.items():
        inner = None
        for (lo, hi), kw in bands:
            cond = (hour >= lo) & (hour <= hi)
            inner = F.when(cond, F.lit(kw)) if inner is None else inner.when(cond, F.lit(kw))
        else_kw = F.lit(C.LOAD_PROFILE_ELSE[loc])
        value = else_kw if inner is None else inner.otherwise(else_kw)
        expr = F.when(location == loc, value) if expr is None else expr.when(location == loc, value)
    return expr


def weekend_factor(location, is_weekend) -> Column:
    """Weekend multiplier chosen by substring test, in rule order."""
    if isinstance(location, str) and isinstance(is_weekend, str):
        return F.expr(weekend_factor_sql(location, is_weekend))
    expr = None
    for loc, factor in C.WEEKEND_FACTORS:
        cond = is_weekend & location.contains(loc)
        expr = F.when(cond, F.lit(factor)) if expr is None else expr.when(cond, F.lit(factor))
    return expr.otherwise(F.lit(1.0))


def solar_efficiency(temperature) -> Column:
    """max(0.5, 1 - 0.005*|t - 25|); 1.0 when the temperature is unknown."""
    if isinstance(temperature, str):
        return F.expr(solar_efficiency_sql(temperature))
    eff = F.greatest(F.lit(C.SOLAR_EFF_FLOOR),
                     F.lit(1.0) - F.lit(C.SOLAR_LOSS_PER_C) * F.abs(temperature - F.lit(C.SOLAR_REF_TEMP_C)))
    return F.when(temperature.isNull(), F.lit(1.0)).otherwise(eff)


def wind_efficiency(speed) -> Column:
    """Piecewise wind-turbine efficiency; 1.0 when the wind speed is unknown."""
    if isinstance(speed, str):
        return F.expr(wind_efficiency_sql(speed))
    return (F.when(speed.isNull(), F.lit(1.0))
            .when(speed < C.WIND_CUT_IN, F.lit(0.0))
            .when(speed < C.WIND_RATED, F.least(F.lit(1.0), speed / F.lit(C.WIND_RATED)))
            .otherwise(F.greatest(F.lit(C.WIND_EFF_FLOOR),
                                  F.lit(1.0) - (speed - F.lit(C.WIND_RATED)) * F.lit(C.WIND_DECAY_PER_MS))))


def is_finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def hour_floor(ts: Column) -> Column:
    """Wall-clock hour start of a TIMESTAMP_NTZ, independent of the session time zone."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))
