"""Data-quality operators: validation, accept/reject split, anomaly rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaflow.functions import constants as C
from voltaflow.functions.exprs import is_finite

ANOMALY_TYPE = "array<struct<type:string,message:string>>"


def _compact(items: list[Column]) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def validate_readings(df: DataFrame, max_kw: float = C.MAX_POWER_KW,
                      ts_col: str = "ts") -> DataFrame:
    """Add ``errors array<string>`` and ``is_valid``.

    Required: solar_power, wind_power, location, timestamp. Each power must be
    finite and inside [0, max_kw] (bounds valid). A NaN or infinite power is
    rejected instead of passing both range checks.
    """
    checks: list[Column] = []
    required = (("solar_power", "solar_power"), ("wind_power", "wind_power"),
                ("location", "location"), ("timestamp", ts_col))
    for name, col in required:
        checks.append(F.when(F.col(col).isNull(), F.lit(C.MSG_MISSING.format(name))))
    for col, neg, over, label in (("solar_power", C.MSG_SOLAR_NEGATIVE, C.MSG_SOLAR_OVER, "Solar"),
                                  ("wind_power", C.MSG_WIND_NEGATIVE, C.MSG_WIND_OVER, "Wind")):
        c = F.col(col)
        fin = is_finite(c)
        checks.append(F.when(c.isNotNull() & ~fin, F.lit(f"{label} power is not a finite number")))
        checks.append(F.when(fin & (c < 0), F.lit(neg)))
        checks.append(F.when(fin & (c > max_kw), F.lit(over)))
    errors = _compact(checks)
    return df.withColumn("errors", errors).withColumn("is_valid", F.size("errors") == 0)


def valid_predicate(max_kw: float = C.MAX_POWER_KW, ts_col: str = "ts") -> Column:
    """Boolean form of ``validate_readings`` (no error array): cheap to push
    into the scan-side filter."""
    ok = F.lit(True)
    for col in ("solar_power", "wind_power", "location", ts_col):
        ok = ok & F.col(col).isNotNull()
    for col in ("solar_power", "wind_power"):
        c = F.col(col)
        ok = ok & is_finite(c) & (c >= 0) & (c <= max_kw)
    return ok


def rejected_readings(df: DataFrame) -> DataFrame:
    return validate_readings(df).filter(~F.col("is_valid"))


def detect_anomalies(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Add ``anomalies array<struct<type,message>>`` and ``n_anomalies``.

    Night solar: (hour >= 20 or hour <= 5) and solar > 10 kW.
    Wind mismatch: wind speed known, < 3 m/s, and wind power > 100 kW.
    Both are skipped when the timestamp is unknown.
    """
    hour = F.hour(ts_col)
    solar = F.coalesce(F.col("solar_power"), F.lit(0.0))
    wind = F.coalesce(F.col("wind_power"), F.lit(0.0))
    has_ts = F.col(ts_col).isNotNull()
    night = has_ts & ((hour >= C.NIGHT_FROM_HOUR) | (hour <= C.NIGHT_TO_HOUR)) & (solar > C.NIGHT_SOLAR_KW)
    speed = F.col("wind_speed")
    mismatch = has_ts & speed.isNotNull() & (speed < C.LOW_WIND_SPEED) & (wind > C.HIGH_WIND_POWER_KW)
    night_msg = F.format_string("Solar generation at night: %skW at hour %d", F.col("solar_power").cast("string"), hour)
    wind_msg = F.format_string("High wind power (%skW) with low wind speed (%sm/s)",
                               wind.cast("string"), speed.cast("string"))
    items = _compact([
        F.when(night, F.struct(F.lit(C.ANOMALY_NIGHT).alias("type"), night_msg.alias("message"))),
        F.when(mismatch, F.struct(F.lit(C.ANOMALY_WIND).alias("type"), wind_msg.alias("message"))),
    ])
    n = night.cast("int") + mismatch.cast("int")
    return df.withColumns({"anomalies": items, "n_anomalies": n})


def anomaly_counts(df: DataFrame) -> DataFrame:
    """Long form: one row per anomaly type with its count (partial aggregation)."""
    return (df.select(F.explode("anomalies").alias("a"))
            .groupBy(F.col("a.type").alias("anomaly_type"))
            .agg(F.count(F.lit(1)).alias("n")))


def quality_score(n_anomalies: Column) -> Column:
    return F.lit(1.0) - n_anomalies * F.lit(C.QUALITY_PENALTY)
