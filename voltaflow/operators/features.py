"""Normalisation, efficiencies, temporal features and the optimisation request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaflow.functions.exprs import solar_efficiency, wind_efficiency
from voltaflow.operators.quality import quality_score


def normalize_readings(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Powers as double, total, efficiencies and wall-clock temporal features.

    ``day_of_week`` is Monday = 0; weekend is day_of_week >= 5. Unknown
    timestamps give hour 0, day 0, not weekend.
    """
    solar = F.col("solar_power").cast("double")
    wind = F.col("wind_power").cast("double")
    ts = F.col(ts_col)
    dow = F.coalesce(F.weekday(ts), F.lit(0))
    # one projection (few analysis passes; see the note on withColumn chains in the Spark docs)
    return df.withColumns({
        "solar_power": solar,
        "wind_power": wind,
        "total_power": solar + wind,
        "solar_efficiency": solar_efficiency("temperature"),
        "wind_efficiency": wind_efficiency("wind_speed"),
        "hour": F.coalesce(F.hour(ts), F.lit(0)),
        "day_of_week": dow,
        "is_weekend": dow >= 5,
    })


def optimization_requests(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Flat optimisation request: deterministic id and quality score.

    Expects the output of ``detect_anomalies`` + ``normalize_readings``.
    ``request_id`` = location || '_' || event_id (the source id, not a clock).
    """
    return df.withColumns({
        "request_id": F.concat_ws("_", F.col("location"), F.col("event_id").cast("string")),
        "quality_score": quality_score(F.col("n_anomalies")),
        "original_timestamp": F.col(ts_col),
    })
