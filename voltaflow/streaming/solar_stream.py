"""Solar message streams: produce pages continuously, parse envelopes, windowed
statistics to a console/memory sink, and running topic counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.functions import constants as C
from voltaflow.sources.messages import ENVELOPE_DDL, solar_envelope
from voltaflow.streaming.sliding import sliding_window_stats
from voltaflow.streaming.sources import read_topics, write_topic

PAGE_RECORD_DDL = "region string, transaction_date string, transaction_hour int, solar_generation_mwh double"


def produce_stream(spark: SparkSession, pages_dir: str, fmt: str, target: str, checkpoint: str,
                   interval: str = "60 seconds", prefix: str = "stream"):
    """Continuous produce: one landed page per trigger, enveloped and keyed."""
    pages = read_topics(spark, "json", pages_dir, schema=f"page bigint, data array<struct<{PAGE_RECORD_DDL}>>",
                        max_per_trigger=1)
    recs = pages.select(F.explode("data").alias("r")).select("r.*").withColumn("timestamp", F.current_timestamp())
    return write_topic(solar_envelope(recs, prefix=prefix), fmt, target, checkpoint,
                       trigger={"processingTime": interval})


def parse_solar_stream(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """Envelope JSON -> (timestamp TIMESTAMP, region, MWh ...); the envelope
    time is kept (and cast) so a watermark can use it."""
    e = F.from_json(F.col(value_col).cast("string"), ENVELOPE_DDL)
    rec = [F.col(f"e.record.`{src}`").alias(ascii_) for src, ascii_ in C.SOLAR_SOURCE_FIELDS]
    return (messages.select(e.alias("e"))
            .select(F.regexp_replace("e.timestamp", "Z$", "").try_cast("timestamp").alias("timestamp"), *rec))


def start_sliding_console(messages: DataFrame, sink: str = "console", query_name: str | None = None,
                          trigger: dict | None = None, checkpoint: str | None = None):
    """Sliding 5/1-minute window stats per region, update mode, 30 s trigger."""
    stats = sliding_window_stats(parse_solar_stream(messages))
    w = stats.writeStream.outputMode("update").format(sink)
    if query_name:
        w = w.queryName(query_name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": C.STREAM_TRIGGER})).start()


def topic_counts_stream(tagged: DataFrame) -> DataFrame:
    """Running message counts per topic (update mode)."""
    return tagged.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))
