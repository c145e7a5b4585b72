"""Sliding-window statistics, the same operator for batch and streaming frames."""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaflow.functions import constants as C


def sliding_window_stats(df: DataFrame, time_col: str = "timestamp", key: str = "region",
                         value: str = "solar_generation_mwh", size: str = C.SLIDING_WINDOW,
                         slide: str = C.SLIDING_SLIDE, delay: str | None = C.WATERMARK_DELAY) -> DataFrame:
    """avg / max / count of ``value`` per (sliding window, key).

    On a stream the event time must be a TIMESTAMP (NTZ is refused by the
    watermark), so it is cast first and bounded by a watermark; state older
    than ``delay`` is dropped. Each row lands in size/slide windows; the
    partial aggregation combines them map-side before the shuffle on
    (window, key).
    """
    ts = F.col(time_col)
    if df.isStreaming:
        df = df.withColumn(time_col, ts.cast("timestamp"))
        if delay:
            df = df.withWatermark(time_col, delay)
    panes = Fraction(pd.Timedelta(size).value, pd.Timedelta(slide).value)
    if not df.isStreaming and panes.denominator == 1:
        return _by_panes(df, time_col, key, value, slide, int(panes))
    agg = (df.groupBy(F.window(F.col(time_col), size, slide).alias("w"), F.col(key))
           .agg(F.avg(F.col(value)).alias("avg_generation"), F.max(value).alias("max_generation"),
                F.count(F.lit(1)).alias("count")))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key,
                      "avg_generation", "max_generation", "count")


def _by_panes(df: DataFrame, time_col: str, key: str, value: str, slide: str, panes: int) -> DataFrame:
    """Batch form: one partial result per (slide, key), and only these few rows
    are copied into the windows they belong to."""
    step = F.expr(f"INTERVAL '{pd.Timedelta(slide).total_seconds()}' SECOND")
    pane = (df.groupBy(F.window(F.col(time_col), slide).alias("p"), F.col(key))
            .agg(F.sum(value).alias("s"), F.count(value).alias("n"), F.max(value).alias("m"), F.count(F.lit(1)).alias("rows"))
            .select(F.col("p.start").alias("at"), key, "s", "n", "m", "rows"))
    spread = pane.withColumn("window_start", F.explode(F.array(*[F.col("at") - step * k for k in range(panes)])))
    return (spread.groupBy("window_start", key)
            .agg(F.try_divide(F.sum("s"), F.sum("n")).alias("avg_generation"), F.max("m").alias("max_generation"),
                 F.sum("rows").alias("count"))
            .select("window_start", (F.col("window_start") + step * panes).alias("window_end"), key,
                    "avg_generation", "max_generation", "count"))
