"""Topics landed as segments: a data source with offsets, for batch and streams.

Layout: ``topic=<name>/partition=<n>/*.parquet`` with ``offset``, ``timestamp``, ``key``
and ``value``. Each file's range of offsets comes from its Parquet footer. A read is a set
of offset ranges, one input partition for each file that overlaps its range, so
replays, reads from the end, and bounded reads touch no file beyond their offsets.
Register it with ``spark.dataSource.register(SegmentSource)``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from voltaflow.operators.ordered import ordered_scan
from voltaflow.session import path_exists

SCHEMA = "topic string, partition int, offset long, timestamp timestamp, key string, value string"
COLUMNS = ("offset", "timestamp", "key", "value")


def _store(path: str):
    """File system and path of a URI, or of a local path."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass
class Segment:
    topic: str
    partition: int
    first: int
    end: int  # behind the last offset
    file: str


@dataclass
class Range(InputPartition):
    """Offsets [start, end) of one file."""
    topic: str
    partition: int
    start: int
    end: int
    file: str


def segments(path: str, topics: list[str], known: dict[str, Segment] | None = None) -> list[Segment]:
    """The topics' segments in the order of (topic, partition, offset); footers of
    files in ``known`` are not read again."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    known = {} if known is None else known
    store, root = _store(path)
    found = []
    for topic in topics:
        files = store.get_file_info(fs.FileSelector(f"{root}/topic={topic}", recursive=True, allow_not_found=True))
        for info in files:
            name = info.path.rpartition("/")[2]
            if info.type != fs.FileType.File or not name.endswith(".parquet") or name[0] in "._":
                continue
            if info.path not in known:
                with store.open_input_file(info.path) as f:
                    meta = pq.ParquetFile(f).metadata
                    at = meta.schema.to_arrow_schema().names.index("offset")
                    stats = [s for k in range(meta.num_row_groups) if (s := meta.row_group(k).column(at).statistics) and s.has_min_max]
                if not stats:  # no rows
                    continue
                partition = int(info.path.rpartition("/")[0].rpartition("partition=")[2])
                known[info.path] = Segment(topic, partition, min(s.min for s in stats), max(s.max for s in stats) + 1, info.path)
            found.append(known[info.path])
    return sorted(found, key=lambda s: (s.topic, s.partition, s.first, s.file))


def _place(s: Segment) -> str:
    return f"{s.topic}/{s.partition}"


def bounds(found: list[Segment], which: str | None, default: str) -> dict[str, int]:
    """Offsets by ``topic/partition``: ``earliest``, ``latest`` or JSON of the
    form ``{"topic": {"0": 5}}`` (-2 is the earliest, -1 the latest; a partition that
    isn't named has the default)."""
    low, high = {}, {}
    for s in found:
        p = _place(s)
        low[p], high[p] = min(low.get(p, s.first), s.first), max(high.get(p, 0), s.end)
    which = which or default
    if which in ("earliest", "latest"):
        return low if which == "earliest" else high
    out = dict(low if default == "earliest" else high)
    for topic, own in json.loads(which).items():
        for partition, at in own.items():
            p = f"{topic}/{partition}"
            out[p] = {-2: low.get(p, 0), -1: high.get(p, 0)}.get(int(at), int(at))
    return out


def ranges(found: list[Segment], start: dict[str, int], end: dict[str, int]) -> list[Range]:
    out = []
    for s in found:
        a, z = max(start.get(_place(s), 0), s.first), min(end.get(_place(s), 0), s.end)
        if a < z:
            out.append(Range(s.topic, s.partition, a, z, s.file))
    return out


def first_messages(found: list[Segment], start: dict[str, int], end: dict[str, int], n: int) -> dict[str, int]:
    """End offsets within which the first ``n`` messages by (topic, partition, offset)
    lie: whole partitions, then one cut where offsets without gaps would make ``n``;
    gaps make a partition longer than counted, so the cut takes its files to the end."""
    import pyarrow.parquet as pq
    out, left = {}, n
    for s in found:
        p = _place(s)
        if left <= 0:
            break
        out[p] = min(end.get(p, 0), max(out.get(p, 0), s.end))
        store, file = _store(s.file)
        with store.open_input_file(file) as f:
            rows = pq.ParquetFile(f).metadata.num_rows
        whole = start.get(p, 0) <= s.first and s.end <= end.get(p, 0)
        left -= rows if whole else 0
    return out


def _rows(partition: Range) -> Iterator:
    """Arrow batches of a range, read in row groups."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    store, file = _store(partition.file)
    with store.open_input_file(file) as f:
        for b in pq.ParquetFile(f).iter_batches(batch_size=8192, columns=list(COLUMNS)):
            b = b.filter(pc.and_(pc.greater_equal(b["offset"], partition.start), pc.less(b["offset"], partition.end)))
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.topic] * b.num_rows), pa.array([partition.partition] * b.num_rows, pa.int32()), b["offset"],
                     b["timestamp"].cast(pa.timestamp("us", "UTC")), b["key"], b["value"]],
                    names=["topic", "partition", *COLUMNS])


class SegmentSource(DataSource):
    """Options: ``path``, ``subscribe`` (comma list of topics), ``startingOffsets``
    (``earliest`` in batch, ``latest`` in a stream, unless given), ``endingOffsets``
    (batch), ``firstMessages`` (batch: no file behind the first n messages is read) and
    ``maxOffsetsPerTrigger`` (stream, for each topic partition)."""

    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)


def _topics(options) -> list[str]:
    return [t.strip() for t in options["subscribe"].split(",") if t.strip()]


class _BatchReader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        found = segments(self.options["path"], _topics(self.options))
        start = bounds(found, self.options.get("startingOffsets"), "earliest")
        end = bounds(found, self.options.get("endingOffsets"), "latest")
        if "firstMessages" in self.options:
            end = first_messages(found, start, end, int(self.options["firstMessages"]))
        return ranges(found, start, end) or [Range("", 0, 0, 0, "")]

    def read(self, partition):
        return _rows(partition) if partition.file else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.options, self.known, self.sent = options, {}, None

    def _segments(self) -> list[Segment]:
        return segments(self.options["path"], _topics(self.options), self.known)

    def initialOffset(self) -> dict:
        self.sent = bounds(self._segments(), self.options.get("startingOffsets"), "latest")
        return self.sent

    def latestOffset(self) -> dict:
        found = self._segments()
        low, high = bounds(found, "earliest", "earliest"), bounds(found, "latest", "latest")
        most = self.options.get("maxOffsetsPerTrigger")
        if most is not None and self.sent is not None:
            # a partition that is new since the start is read from its begin
            high = {p: min(z, max(self.sent.get(p, low[p]), low[p]) + int(most)) for p, z in high.items()}
        self.sent = dict(self.sent or {}) | high
        return self.sent

    def partitions(self, start: dict, end: dict):
        self.sent = dict(end)  # after a restart the offsets come from the checkpoint
        return ranges(self._segments(), start, end)

    def read(self, partition):
        return _rows(partition)

    def commit(self, end: dict) -> None:
        pass


def land(messages: DataFrame, path: str) -> None:
    """Append ``messages`` (topic, partition, timestamp, key, value) as segments. Without an
    ``offset`` they go on behind the stored ones, by time, key and value; the numbers come
    from an ordered scan, so a large topic partition is not one task."""
    spark = messages.sparkSession
    if "offset" not in messages.columns:
        numbered = ordered_scan(messages, ["topic", "partition"], ["timestamp", "key", "value"], position="_n")
        stored = (spark.read.schema(SCHEMA).parquet(path).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("_from"))
                  if path_exists(spark, path) else spark.createDataFrame([], "topic string, partition int, _from long"))
        messages = (numbered.join(F.broadcast(stored), ["topic", "partition"], "left")  # a row for each topic partition
                    .withColumn("offset", F.coalesce("_from", F.lit(0)) + F.col("_n")))
    (messages.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("long").alias("offset"),
                     F.col("timestamp").cast("timestamp").alias("timestamp"), F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"))
     .repartitionByRange("topic", "partition", "offset").sortWithinPartitions("topic", "partition", "offset")
     .write.mode("append").option("maxRecordsPerFile", 1_000_000).partitionBy("topic", "partition").parquet(path))


def read_segments(spark: SparkSession, path: str, topics: str, starting: str = "earliest", ending: str = "latest",
                  limit: int | None = None) -> DataFrame:
    """Bounded read between offsets; ``limit`` gives the first n messages by (topic,
    partition, offset), and only the segments that hold them are read."""
    spark.dataSource.register(SegmentSource)
    r = (spark.read.format("segments").option("path", path).option("subscribe", topics)
         .option("startingOffsets", starting).option("endingOffsets", ending))
    if limit is None:
        return r.load()
    return r.option("firstMessages", limit).load().orderBy("topic", "partition", "offset").limit(limit)


def stream_segments(spark: SparkSession, path: str, topics: str, starting: str = "latest",
                    max_per_trigger: int | None = None) -> DataFrame:
    """Streaming read; a restart goes on from the checkpointed offsets."""
    spark.dataSource.register(SegmentSource)
    r = (spark.readStream.format("segments").option("path", path).option("subscribe", topics).option("startingOffsets", starting))
    return (r.option("maxOffsetsPerTrigger", max_per_trigger) if max_per_trigger else r).load()
