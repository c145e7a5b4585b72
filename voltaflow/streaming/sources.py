"""Topic/file sources and sinks for streams (Kafka when its connector is on
the classpath; file formats for tests and landed data)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from voltaflow.session import path_exists
from voltaflow.sources import segments
from voltaflow.sources.messages import produce_totals, solar_envelope


def read_topics(spark: SparkSession, fmt: str, source: str, schema=None, starting: str = "earliest",
                max_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """Streaming read of a comma list of topics (``fmt='kafka'``) or of a folder.

    Kafka: ``subscribe`` = source, ``startingOffsets`` = starting (earliest =
    replay from the beginning with a fresh checkpoint), ``maxOffsetsPerTrigger``
    bounds a micro-batch; the frame has the usual key/value/topic/partition/
    offset/timestamp columns. Files: ``maxFilesPerTrigger`` bounds a batch.
    ``fmt='segments'``: landed topics with offsets below ``options['path']`` (see
    ``sources.segments``), with the same starting offsets and bound as Kafka.
    """
    if fmt == "segments":
        return segments.stream_segments(spark, options["path"], source, starting, max_per_trigger)
    r = spark.readStream.format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "kafka":
        r = r.option("subscribe", source).option("startingOffsets", starting)
        if max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        return r.load()
    if max_per_trigger:
        r = r.option("maxFilesPerTrigger", max_per_trigger)
    if schema is not None:
        r = r.schema(schema)
    return r.load(source)


def to_topic_value(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """(key, value) JSON text columns expected by a topic sink."""
    cols = [c for c in df.columns if c != key_col]
    out = [F.to_json(F.struct(*cols)).alias("value")]
    if key_col:
        out.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*out)


def write_topic(df: DataFrame, fmt: str, target: str, checkpoint: str, trigger: dict | None = None,
                options: dict | None = None):
    """Streaming sink of (key, value) rows: a Kafka topic (``fmt='kafka'``,
    ``target`` = topic) or a folder of the given file format."""
    w = df.writeStream.format(fmt).option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt == "kafka":
        w = w.option("topic", target)
    else:
        w = w.option("path", target)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_topic_batch(df: DataFrame, fmt: str, target: str, mode: str = "append", options: dict | None = None) -> None:
    """Batch sink of (key, value) rows: a Kafka topic, a folder, or landed segments
    (``fmt='segments'``: one partition of ``target`` below ``options['path']``, stamped now)."""
    if fmt == "segments":
        return segments.land(df.withColumns({"topic": F.lit(target), "partition": F.lit(int(options.get("partition", 0))),
                                             "timestamp": F.current_timestamp()}), options["path"])
    w = df.write.format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if fmt == "kafka":
        w.option("topic", target).save()
    else:
        w.mode(mode).save(target)


def produce_batch(records: DataFrame, fmt: str, target: str, prefix: str = "batch", page_col: str = "page",
                  options: dict | None = None) -> DataFrame:
    """Envelope and key the records, write those that can be encoded, and return
    the totals per page. Run again, it produces the records again."""
    envelopes = solar_envelope(records, prefix=prefix, keep=(page_col,))
    write_topic_batch(envelopes.where("value is not null").select("key", "value"), fmt, target, options=options)
    return produce_totals(envelopes, page_col)


def read_topic_batch(spark: SparkSession, fmt: str, source: str, schema=None, limit: int | None = None,
                     order=("topic", "partition", "offset"), options: dict | None = None) -> DataFrame:
    """Bounded (batch) read of topics or a folder, e.g. to replay from the
    beginning; ``limit`` keeps the first n messages by (topic, partition,
    offset) (top-k through TakeOrderedAndProject, not a driver loop)."""
    if fmt == "segments":  # stops at the offsets of the first n messages instead of ordering the topic
        return segments.read_segments(spark, options["path"], source, limit=limit)
    r = spark.read.format(fmt)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "kafka":
        df = r.option("subscribe", source).option("startingOffsets", "earliest").load()
    else:
        df = (r.schema(schema) if schema is not None else r).load(source)
    return df.orderBy(*order).limit(limit) if limit else df


class ConsumptionLog(StreamingQueryListener):
    """Writes one row for each micro-batch of the session's streams to a shared folder.

    Spark itself remembers the last batches only. A batch is a file named by query
    and batch, so a batch that is reported or run again replaces its row. Idle
    triggers, which run no batch, are left out. Add it with
    ``spark.streams.addListener`` and read the rows with ``consumption_log``.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self._spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        spent = p.get("durationMs") or {}
        if "addBatch" not in spent:
            return
        row = {"query": p["id"], "name": p.get("name"), "batch_id": int(p["batchId"]), "start_time": p["timestamp"],
               "messages_consumed": int(p.get("numInputRows") or 0), "duration_ms": float(spent.get("triggerExecution") or 0)}
        jvm = self._spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{row['query']}-{row['batch_id']:012d}.json")
        store = target.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        out = store.create(target, True)
        try:
            out.write(bytearray((json.dumps(row) + "\n").encode()))
        finally:
            out.close()


LOG_DDL = "query string, name string, batch_id bigint, start_time string, messages_consumed bigint, duration_ms double"


def consumption_log(spark: SparkSession, path: str, topic: str | None = None) -> DataFrame:
    """The log's rows, one per micro-batch, with milliseconds per message; empty before the first batch."""
    rows = spark.read.schema(LOG_DDL).json(path) if path_exists(spark, path) else spark.createDataFrame([], LOG_DDL)
    n, ms = F.col("messages_consumed"), F.col("duration_ms")
    name = F.lit(topic) if topic else F.coalesce("name", F.lit("stream"))
    return rows.select(name.alias("topic"), "query", "batch_id", F.col("start_time").try_cast("timestamp").alias("start_time"),
                       "messages_consumed", "duration_ms", F.when(n > 0, ms / n).otherwise(0.0).alias("avg_processing_time_ms"))


def progress_stats(log: DataFrame) -> DataFrame:
    """One row per topic over all its micro-batches: batches, messages, first start,
    time spent and mean milliseconds per message (the streaming form of the
    consumption-stats table)."""
    n, ms = F.sum("messages_consumed"), F.sum("duration_ms")
    return log.groupBy("topic").agg(F.count(F.lit(1)).alias("batches"), n.alias("messages_consumed"), F.min("start_time").alias("start_time"),
                                    ms.alias("duration_ms"), F.when(n > 0, ms / n).otherwise(0.0).alias("avg_processing_time_ms"))
