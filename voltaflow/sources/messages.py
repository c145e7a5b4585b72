"""Message encodings: solar envelope, control message, envelope unwrap, JSON
round trip and the landed-page JSON source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.functions import constants as C
from voltaflow.operators.control import JSON_OPTIONS

WIRE = dict(C.SOLAR_SOURCE_FIELDS)            # source name -> ascii
ASCII_TO_WIRE = {v: k for k, v in WIRE.items()}

# struct<...> of the wire record and the envelope around it
RECORD_TYPE = "struct<" + ",".join(f"`{src}`:{t}" for (src, _), t in
                                   zip(C.SOLAR_SOURCE_FIELDS, ("string", "int", "string", "double"))) + ">"
ENVELOPE_DDL = f"timestamp string, data_source string, record {RECORD_TYPE}"


def wire_record(df: DataFrame) -> "F.Column":
    """struct of the four solar fields under their wire names."""
    return F.struct(*[F.col(ascii_).alias(src) for src, ascii_ in C.SOLAR_SOURCE_FIELDS])


def solar_envelope(df: DataFrame, prefix: str | None = None, time_col: str = "timestamp",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, value) pairs ready for a topic sink.

    value = {timestamp, data_source, record{...}}; key = prefix_region or
    region, with 'unknown' for a missing region. Records whose envelope
    cannot be encoded count as failed in ``produce_totals``.
    """
    region = F.coalesce(F.col("region"), F.lit(C.UNKNOWN_KEY))
    key = F.concat_ws("_", F.lit(prefix), region) if prefix else region
    env = F.struct(F.date_format(F.col(time_col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                   F.lit(C.ENVELOPE_DATA_SOURCE).alias("data_source"),
                   wire_record(df).alias("record"))
    return df.select(*keep, key.alias("key"), F.to_json(env, JSON_OPTIONS).alias("value"))


def parse_envelope(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode envelope JSON to ascii columns (inverse of ``solar_envelope``)."""
    e = F.from_json(F.col(value_col), ENVELOPE_DDL)
    return df.select("*", e.alias("_e")).select(
        *[c for c in df.columns if c != value_col],
        F.col("_e.timestamp").alias("envelope_timestamp"), F.col("_e.data_source").alias("data_source"),
        *[F.col(f"_e.record.`{src}`").alias(ascii_) for src, ascii_ in C.SOLAR_SOURCE_FIELDS])


def produce_totals(envelopes: DataFrame, page_col: str = "page") -> DataFrame:
    """Per page: records, success (encoded), failed."""
    ok = F.col("value").isNotNull()
    return envelopes.groupBy(page_col).agg(F.count(F.lit(1)).alias("records"),
                                          F.count_if(ok).alias("success"),
                                          F.count_if(~ok).alias("failed"))


def control_message(df: DataFrame, message_type: str, payload_cols: list[str],
                    time_col: str = "timestamp") -> DataFrame:
    """(key='control', value={message_type, timestamp, payload{...}})."""
    msg = F.struct(F.lit(message_type).alias("message_type"),
                   F.date_format(F.col(time_col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
                   F.struct(*payload_cols).alias("payload"))
    return df.select(F.lit(C.CONTROL_KEY).alias("key"), F.to_json(msg, JSON_OPTIONS).alias("value"))


def unwrap_envelope(df: DataFrame, value_col: str = "value") -> DataFrame:
    """record = value.record when the message is an envelope, else the value itself."""
    env = F.from_json(F.col(value_col), f"record {RECORD_TYPE}")
    bare = F.from_json(F.col(value_col), RECORD_TYPE)
    rec = F.when(env["record"].isNotNull(), env["record"]).otherwise(bare)
    return df.select("*", rec.alias("_r")).select(
        *[c for c in df.columns if c != value_col],
        *[F.col(f"_r.`{src}`").alias(ascii_) for src, ascii_ in C.SOLAR_SOURCE_FIELDS])


def json_roundtrip(df: DataFrame) -> DataFrame:
    """Encode every row as JSON text and decode it back with the same schema."""
    enc = df.select(F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("v"))
    return enc.select(F.from_json("v", df.schema, JSON_OPTIONS).alias("r")).select("r.*")


def land_pages(records: DataFrame, path: str, page_col: str = "page", order_col: str = "arrival") -> None:
    """Write records as page documents {page, data:[...]} (one JSON document per page).

    A page holds a bounded number of records (the producer's page size), so
    collecting one page into an array is bounded.
    """
    rec_cols = [c for c in records.columns if c not in (page_col,)]
    pages = (records.groupBy(page_col)
             .agg(F.sort_array(F.collect_list(F.struct(order_col, *[c for c in rec_cols if c != order_col])))
                  .alias("data")))
    pages.write.mode("overwrite").json(path)


def read_pages(spark: SparkSession, path: str, record_ddl: str, multi_line: bool = False,
               on_corrupt: str = "raise") -> DataFrame:
    """Read landed pages and flatten ``data``; an empty folder yields an empty
    frame with the schema. ``multi_line`` reads files that hold one page document
    over several lines, as the API delivers them; without it each line is a page.
    A malformed page is an error, or with ``on_corrupt='drop'`` yields no rows
    (``corrupt_pages`` shows them)."""
    schema = f"page bigint, data array<struct<{record_ddl}>>"
    pages = (spark.read.schema(schema).option("mode", "FAILFAST" if on_corrupt == "raise" else "PERMISSIVE")
             .option("multiLine", multi_line).json(path))
    return pages.select("page", F.explode("data").alias("r")).select("page", "r.*")


def corrupt_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The text of pages that can't be read."""
    text = spark.read.text(path, wholetext=multi_line)
    page = F.from_json("value", "page bigint, data array<string>, _corrupt_record string", {"mode": "PERMISSIVE"})
    return text.where(page["_corrupt_record"].isNotNull()).select(F.col("value").alias("page"))


def read_wire_pages(spark: SparkSession, path: str, multi_line: bool = False, on_corrupt: str = "raise") -> DataFrame:
    """``read_pages`` of records with the wire's field names, renamed to ours."""
    ddl = RECORD_TYPE.removeprefix("struct<").removesuffix(">").replace("`:", "` ")
    return read_pages(spark, path, ddl, multi_line, on_corrupt).withColumnsRenamed(WIRE)


def event_time_from_millis(millis) -> "F.Column":
    """Broker timestamp (milliseconds since the epoch) as TIMESTAMP."""
    return F.timestamp_millis(millis)
