"""Registered queries of the solar / messaging half and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltaflow.operators import consumed, forecast, solar
from voltaflow.plans import control_plan as P
from voltaflow.plans import oracle_control as OC
from voltaflow.plans.control_queries import rnd, sround
from voltaflow.session import scratch_dir
from voltaflow.sources import bridge, ingest, messages, pages
from voltaflow.streaming.sliding import sliding_window_stats

FEATURE_COLS = ("transaction_date", "transaction_hour", "region", "solar_generation_mwh", "year", "month", "day",
                "weekday", "quarter", "is_weekend", "is_daylight", "hour_category")


def _features(spark, sf):
    return solar.solar_features(bridge.solar_hourly(spark, sf))


def _log(spark, sf):
    return consumed.consumed_dedup(bridge.consumed_raw(spark, sf))


def _page(df):
    return (F.unix_date("transaction_date").cast("long") * 24 + F.col("transaction_hour") - 1).alias("page")


def _produced_at(df):
    return (F.col("transaction_date").cast("timestamp_ntz")
            + F.make_dt_interval(hours=F.col("transaction_hour") - 1)).alias("timestamp")


def _records(spark, sf):
    """Solar API records as produced: wire date text, page = hour slot."""
    h = bridge.solar_hourly(spark, sf)
    return h.select(_page(h), _produced_at(h), F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date"),
                    "transaction_hour", "region", "solar_generation_mwh")


# --------------------------------------------------------------------------- queries

def q_solar_features(spark, sf):
    return _features(spark, sf).select(*FEATURE_COLS)


def q_solar_wire_names(spark, sf):
    """The features of records that still have the wire's field names."""
    wire = bridge.solar_hourly(spark, sf).withColumnsRenamed({ours: theirs for theirs, ours in solar.C.SOLAR_SOURCE_FIELDS})
    return solar.solar_features(wire).select(*FEATURE_COLS)


def q_broker_times(spark, sf):
    """Event times from the broker's milliseconds."""
    raw = bridge.consumed_raw(spark, sf)
    millis = F.unix_millis(F.col("timestamp").cast("timestamp"))
    return raw.select("topic", "partition", "offset", "arrival",
                      messages.event_time_from_millis(millis).cast("timestamp_ntz").alias("event_time"))


def q_solar_lag_diff(spark, sf):
    return solar.solar_lag_diff(_features(spark, sf)).select(
        "region", "transaction_date", "transaction_hour", "solar_generation_mwh", "prev_generation",
        "generation_diff")


def q_solar_daily_windows(spark, sf):
    w = solar.solar_daily_windows(_features(spark, sf))
    return rnd(w.select("region", "transaction_date", "transaction_hour", "solar_generation_mwh", "daily_total",
                        "daily_avg", "daily_max"), ("daily_total", "daily_avg"))


def q_solar_daily_totals(spark, sf):
    return rnd(solar.daily_totals(_features(spark, sf)), ("daily_total", "daily_avg"))


def q_solar_overall_stats(spark, sf):
    return rnd(solar.overall_stats(_features(spark, sf)), ("avg_generation", "std_generation", "total_generation"))


def q_solar_regional_stats(spark, sf):
    return rnd(solar.regional_stats(_features(spark, sf)), ("avg_generation", "total_generation"))


def q_solar_hourly_pattern(spark, sf):
    return rnd(solar.hourly_pattern(_features(spark, sf)), ("avg_generation",))


def q_solar_top_regions(spark, sf):
    return rnd(solar.top_regions(_features(spark, sf), 5), ("avg_generation", "total_generation"))


def q_solar_report(spark, sf):
    return rnd(solar.report(_features(spark, sf), 5), ("value",))


def q_solar_parquet_roundtrip(spark, sf):
    path = scratch_dir(spark, "solar_features.parquet")
    solar.write_solar(_features(spark, sf).select(*FEATURE_COLS), path)
    return solar.read_solar(spark, path).select(*FEATURE_COLS)


def q_solar_envelope(spark, sf):
    env = messages.solar_envelope(_records(spark, sf), prefix="batch")
    return messages.parse_envelope(env)


def q_produce_totals(spark, sf):
    rec = _records(spark, sf)
    env = messages.solar_envelope(rec, prefix="batch", keep=("page",))
    return messages.produce_totals(env)


def q_control_message(spark, sf):
    rec = _records(spark, sf)
    day = (rec.groupBy(F.col("transaction_date").alias("date"))
           .agg(F.max("timestamp").alias("timestamp"), F.count(F.lit(1)).alias("records"),
                F.countDistinct("region").alias("regions"),
                F.sum("solar_generation_mwh").alias("total_mwh")))
    day = rnd(day, ("total_mwh",))
    msg = messages.control_message(day, "daily_batch_complete", ["date", "records", "regions", "total_mwh"])
    p = F.from_json("value", "message_type string, timestamp string, "
                             "payload struct<date:string, records:bigint, regions:bigint, total_mwh:double>")
    return msg.select("key", p.alias("m")).select("key", "m.message_type", "m.timestamp", "m.payload.*")


def q_json_roundtrip(spark, sf):
    req = P.requests(spark, sf).select("request_id", "location", "ts", "total_power", "solar_efficiency",
                                       "wind_efficiency", "hour", "day_of_week", "is_weekend", "quality_score")
    return messages.json_roundtrip(req)


def q_unwrap_envelope(spark, sf):
    raw = bridge.consumed_raw(spark, sf)
    rec = messages.wire_record(raw)
    env = F.struct(F.lit("x").alias("timestamp"), F.lit("solar_api").alias("data_source"), rec.alias("record"))
    value = F.when(F.col("arrival") % 3 == 0, F.to_json(rec)).otherwise(F.to_json(env))
    wrapped = raw.select("topic", "partition", "offset", "arrival", value.alias("value"))
    return messages.unwrap_envelope(wrapped)


def q_paged_json_source(spark, sf):
    """Pages with the wire's field names, landed, read back and renamed."""
    path = scratch_dir(spark, "landed_pages")
    wire = messages.wire_record(_records(spark, sf))
    messages.land_pages(_records(spark, sf).select("page", "region", wire.alias("r")).select("page", "r.*"), path,
                        order_col=messages.ASCII_TO_WIRE["region"])
    return messages.read_wire_pages(spark, path)


def q_numbered_pages(spark, sf):
    """The same records, as numbered pages read by ranges of numbers."""
    path = scratch_dir(spark, "numbered_pages")
    records = _records(spark, sf).select("page", "region", "transaction_date", "transaction_hour", "solar_generation_mwh")
    items = F.sort_array(F.collect_list(F.struct("region", "transaction_date", "transaction_hour", "solar_generation_mwh")))
    made = records.groupBy("page").agg(items.alias("data"))
    pages.land_numbered(made.select("page", F.to_json(F.struct("page", "data")).alias("body")), path)
    ends = records.agg(F.min("page").alias("a"), F.max("page").alias("z")).first()
    if ends.a is None:
        return records
    read = pages.read_numbered(spark, path, ends.a, ends.z)
    return pages.page_records(read, "region string, transaction_date string, transaction_hour int, solar_generation_mwh double")[0]


def q_consumed_dedup(spark, sf):
    return _log(spark, sf)


def q_consumed_totals(spark, sf):
    return rnd(consumed.consumed_totals(_log(spark, sf)), ("avg_generation",))


def q_top_regions(spark, sf):
    return rnd(consumed.top_regions(_log(spark, sf)), ("avg_generation",))


def q_consumption_stats(spark, sf):
    return rnd(consumed.consumption_stats(bridge.consumed_raw(spark, sf), _log(spark, sf)),
               ("avg_processing_time_ms",))


def q_sliding_window_stats(spark, sf):
    return rnd(sliding_window_stats(bridge.consumed_raw(spark, sf)), ("avg_generation",))


def q_ml_training_frame(spark, sf):
    return forecast.ml_training_frame(_features(spark, sf))


def q_ml_metrics(spark, sf):
    metrics, _ = forecast.train_forecast(spark, forecast.ml_training_frame(_features(spark, sf)))
    return metrics


def q_ml_linear(spark, sf):
    """Coefficients (the intercept as ``(intercept)``), and the metrics on the test split."""
    model, metrics = forecast.linear_model(forecast.ml_training_frame(_features(spark, sf)))
    rows = [("coefficient", n, b) for n, b in zip(model.features, model.coefficients)]
    rows += [("coefficient", "(intercept)", model.intercept), ("metric", "rmse", metrics["rmse"]), ("metric", "r2", metrics["r2"])]
    return rnd(spark.createDataFrame(rows, "kind string, name string, value double"), ("value",))


def q_ml_predict(spark, sf):
    frame = forecast.ml_training_frame(_features(spark, sf))
    path = scratch_dir(spark, "linear-model")
    forecast.linear_model(frame)[0].save(spark, path)
    _, test = forecast.split(frame)
    return rnd(forecast.LinearModel.load(spark, path).predict(test).select(*forecast.KEY, "prediction"), ("prediction",))


def q_ml_split_baseline(spark, sf):
    return rnd(forecast.split_baseline(forecast.ml_training_frame(_features(spark, sf))), ("rmse", "r2"))


def _raw_readings(spark, sf):
    return bridge.raw_reading_json(spark, sf)


def q_ingest_readings(spark, sf):
    latest = bridge.power_readings(spark, sf).select(F.max("ts")).scalar()  # reads one column
    out = ingest.ingest_readings(_raw_readings(spark, sf), as_of=latest)
    return out.select("event_id", "accepted", "error", "location", "solar_power", "wind_power",
                      F.col("ts").alias("timestamp"), "received_at", "data_type")


def q_ingest_batch_counts(spark, sf):
    raw = _raw_readings(spark, sf).withColumn("batch_id", F.expr("event_id div 100"))
    return ingest.ingest_batch_counts(ingest.batch_bodies(raw, "batch_id"))


QUERIES = {
    "ingest_readings": q_ingest_readings,
    "ingest_batch_counts": q_ingest_batch_counts,
    "solar_envelope": q_solar_envelope,
    "produce_totals": q_produce_totals,
    "control_message": q_control_message,
    "paged_json_source": q_paged_json_source,
    "numbered_pages": q_numbered_pages,
    "json_roundtrip": q_json_roundtrip,
    "unwrap_envelope": q_unwrap_envelope,
    "solar_features": q_solar_features,
    "solar_wire_names": q_solar_wire_names,
    "broker_times": q_broker_times,
    "solar_lag_diff": q_solar_lag_diff,
    "solar_daily_windows": q_solar_daily_windows,
    "solar_daily_totals": q_solar_daily_totals,
    "solar_overall_stats": q_solar_overall_stats,
    "solar_regional_stats": q_solar_regional_stats,
    "solar_hourly_pattern": q_solar_hourly_pattern,
    "solar_top_regions": q_solar_top_regions,
    "solar_report": q_solar_report,
    "solar_parquet_roundtrip": q_solar_parquet_roundtrip,
    "consumed_dedup": q_consumed_dedup,
    "consumed_totals": q_consumed_totals,
    "top_regions": q_top_regions,
    "consumption_stats": q_consumption_stats,
    "sliding_window_stats": q_sliding_window_stats,
    "ml_training_frame": q_ml_training_frame,
    "ml_metrics": q_ml_metrics,
    "ml_linear": q_ml_linear,
    "ml_predict": q_ml_predict,
    "ml_split_baseline": q_ml_split_baseline,
}

# --------------------------------------------------------------------------- oracle SQL

_CTES = """WITH
solar_hourly AS (
  SELECT transaction_date, transaction_hour, region,
    CASE WHEN transaction_hour % 11 = 0 THEN NULL ELSE CAST(v AS DOUBLE) END AS solar_generation_mwh
  FROM (SELECT 'R' || CAST(user_id % 10 AS VARCHAR) AS region, CAST(ts AS DATE) AS transaction_date,
               CAST(hour(ts) + 1 AS INTEGER) AS transaction_hour, sum(CAST(value AS DECIMAL(12,2))) AS v
        FROM events GROUP BY 1, 2, 3) g),
features AS (
  SELECT transaction_date, transaction_hour, region,
    coalesce(solar_generation_mwh, 0.0::DOUBLE) AS solar_generation_mwh,
    CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
    CAST(day(transaction_date) AS INTEGER) AS day, CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS weekday,
    CAST(quarter(transaction_date) AS INTEGER) AS quarter,
    CASE WHEN dayofweek(transaction_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN transaction_hour >= 6 AND transaction_hour <= 18 THEN 1 ELSE 0 END AS is_daylight,
    CASE WHEN transaction_hour < 6 THEN 'dawn' WHEN transaction_hour < 12 THEN 'morning'
         WHEN transaction_hour < 18 THEN 'afternoon' ELSE 'night' END AS hour_category
  FROM solar_hourly),
records AS (
  SELECT (transaction_date - DATE '1970-01-01') * 24 + transaction_hour - 1 AS page,
    CAST(transaction_date AS TIMESTAMP) + to_hours(transaction_hour - 1) AS "timestamp",
    strftime(transaction_date, '%Y-%m-%d') AS transaction_date, transaction_hour, region, solar_generation_mwh
  FROM solar_hourly),
consumed_raw AS (
  SELECT event_type AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", event_id // 10 AS "offset",
    event_id AS arrival, ts AS "timestamp", 'R' || CAST(user_id % 10 AS VARCHAR) AS key,
    strftime(ts, '%Y-%m-%d') AS transaction_date, CAST(hour(ts) + 1 AS INTEGER) AS transaction_hour,
    'R' || CAST(user_id % 10 AS VARCHAR) AS region,
    CASE WHEN (hour(ts) + 1) % 11 = 0 THEN NULL ELSE value END AS solar_generation_mwh
  FROM events),
consumed_log AS (
  SELECT topic, "partition", "offset", "timestamp", key, transaction_date, transaction_hour, region,
    solar_generation_mwh, "timestamp" AS consumed_at
  FROM consumed_raw QUALIFY row_number() OVER (PARTITION BY topic, "partition", "offset" ORDER BY arrival) = 1)
"""

_FEAT = ", ".join(FEATURE_COLS)

_SPLIT = """, frame AS (
  SELECT *, ('0x' || substr(md5(concat_ws('|', '42', region, transaction_date, transaction_hour)), 1, 8))::BIGINT % 10000
    < 8000 AS is_train
  FROM features WHERE solar_generation_mwh > 0)
"""


_ML = forecast.C.FEATURE_COLUMNS


def _elastic_net_sql(sweeps: int = 150) -> str:
    """Elastic net by coordinate descent in a recursive query, one coordinate a step."""
    n, reg, mix = len(_ML), forecast.C.LR_PARAMS["regParam"], forecast.C.LR_PARAMS["elasticNetParam"]
    dev = "[" + ", ".join(f"coalesce(nullif(stddev_pop({c}::DOUBLE), 0), 1)" for c in _ML) + "]"  # 1 for a constant
    mean = "[" + ", ".join(f"avg({c}::DOUBLE)" for c in _ML) + "]"
    gram = "[" + ", ".join("[" + ", ".join(f"covar_pop({a}::DOUBLE, {b}::DOUBLE)" for b in _ML) + "]" for a in _ML) + "]"
    label = "[" + ", ".join(f"covar_pop({a}::DOUBLE, {forecast.LABEL})" for a in _ML) + "]"
    each = "generate_series(1, " + str(n) + ")"
    rest = (f"(label[j] / (dev[j] * sy) - list_sum([gram[j][k] / (dev[j] * dev[k]) * beta[k] FOR k IN {each}])"
            " + gram[j][j] / (dev[j] * dev[j]) * beta[j])")
    return _CTES.replace("WITH", "WITH RECURSIVE", 1) + _SPLIT + f""",
stats AS (
  SELECT {dev} AS dev, {mean} AS mean, {gram} AS gram, {label} AS label, stddev_pop({forecast.LABEL}) AS sy, avg({forecast.LABEL}) AS my
  FROM frame WHERE is_train),
descent AS (
  SELECT 0 AS step, [0.0::DOUBLE FOR k IN {each}] AS beta
  UNION ALL
  SELECT step + 1, [CASE WHEN k <> j THEN beta[k] ELSE sign(r) * greatest(abs(r) - {reg * mix} / sy, 0)
                    / (gram[j][j] / (dev[j] * dev[j]) + {reg * (1 - mix)} / sy) END FOR k IN {each}]
  FROM (SELECT step, beta, j, {rest} AS r, sy, gram, dev FROM (SELECT *, step % {n} + 1 AS j FROM descent), stats)
  WHERE step < {n * sweeps}),
model AS (
  SELECT weights, my - list_sum([weights[k] * mean[k] FOR k IN {each}]) AS intercept
  FROM (SELECT [beta[k] * sy / dev[k] FOR k IN {each}] AS weights, mean, my FROM descent, stats WHERE step = {n * sweeps})),
scored AS (
  SELECT region, transaction_date, transaction_hour, {forecast.LABEL} AS y,
    intercept + {" + ".join(f"weights[{k + 1}] * {c}" for k, c in enumerate(_ML))} AS p
  FROM frame, model WHERE NOT is_train)
"""


def _ingest_sql() -> str:
    from voltaflow.plans.oracle_control import READINGS
    return "WITH" + READINGS + """,
raw AS (
  SELECT event_id, location, event_id % 50 AS kind, CASE WHEN event_id % 50 <> 3 THEN solar_power END AS solar_power,
    CASE WHEN event_id % 50 NOT IN (1, 4) THEN wind_power END AS wind_power,
    CASE WHEN event_id % 50 NOT IN (2, 5) THEN ts END AS ts0
  FROM readings),
as_of AS (SELECT max(ts) AS t FROM readings)
"""


ORACLE = {
    "ingest_readings": _ingest_sql() + """SELECT event_id, kind NOT IN (1, 3, 4, 5) AS accepted,
        CASE kind WHEN 1 THEN 'Missing required field: wind_power' WHEN 3 THEN 'Not numeric: solar_power'
                  WHEN 4 THEN 'Not numeric: wind_power' WHEN 5 THEN 'Unreadable timestamp' END AS error,
        location, solar_power, wind_power,
        CASE WHEN kind = 2 THEN (SELECT t FROM as_of) ELSE ts0 END AS "timestamp", (SELECT t FROM as_of) AS received_at,
        'power_generation' AS data_type FROM raw""",
    "ingest_batch_counts": _ingest_sql() + """SELECT event_id // 100 AS batch_id,
        count(*) FILTER (WHERE kind <> 1) AS success, count(*) FILTER (WHERE kind = 1) AS failed,
        count(*) AS total FROM raw GROUP BY 1""",
    "solar_envelope": _CTES + """SELECT 'batch_' || coalesce(region, 'unknown') AS key,
        strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS envelope_timestamp, 'solar_api' AS data_source,
        transaction_date, transaction_hour, region, solar_generation_mwh FROM records""",
    "produce_totals": _CTES + """SELECT page, count(*) AS records, count(*) AS success, 0::BIGINT AS failed
        FROM records GROUP BY page""",
    "control_message": _CTES + f"""SELECT 'control' AS key, 'daily_batch_complete' AS message_type,
        strftime(max("timestamp"), '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", transaction_date AS date,
        count(*) AS records, count(DISTINCT region) AS regions,
        {sround("sum(solar_generation_mwh)")} AS total_mwh
        FROM records GROUP BY transaction_date""",
    "paged_json_source": _CTES + """SELECT page, region, transaction_date, transaction_hour, solar_generation_mwh
        FROM records""",
    "numbered_pages": _CTES + """SELECT page, region, transaction_date, transaction_hour, solar_generation_mwh
        FROM records""",
    "unwrap_envelope": _CTES + """SELECT topic, "partition", "offset", arrival, transaction_date, transaction_hour,
        region, solar_generation_mwh FROM consumed_raw""",
    "solar_features": _CTES + f"SELECT {_FEAT} FROM features",
    "solar_parquet_roundtrip": _CTES + f"SELECT {_FEAT} FROM features",
    "solar_wire_names": _CTES + f"SELECT {_FEAT} FROM features",
    "broker_times": _CTES + """SELECT topic, "partition", "offset", arrival, date_trunc('milliseconds', "timestamp") AS event_time
        FROM consumed_raw""",
    "solar_lag_diff": _CTES + """SELECT region, transaction_date, transaction_hour, solar_generation_mwh,
        lag(solar_generation_mwh) OVER w AS prev_generation,
        solar_generation_mwh - lag(solar_generation_mwh) OVER w AS generation_diff
        FROM features WINDOW w AS (PARTITION BY region ORDER BY transaction_date, transaction_hour)""",
    "solar_daily_windows": _CTES + f"""SELECT region, transaction_date, transaction_hour, solar_generation_mwh,
        {sround("sum(solar_generation_mwh) OVER w")} AS daily_total,
        {sround("avg(solar_generation_mwh) OVER w")} AS daily_avg,
        max(solar_generation_mwh) OVER w AS daily_max
        FROM features WINDOW w AS (PARTITION BY region, transaction_date)""",
    "solar_daily_totals": _CTES + f"""SELECT region, transaction_date, count(*) AS records,
        {sround("sum(solar_generation_mwh)")} AS daily_total, {sround("avg(solar_generation_mwh)")} AS daily_avg,
        max(solar_generation_mwh) AS daily_max FROM features GROUP BY region, transaction_date""",
    "solar_overall_stats": _CTES + f"""SELECT count(*) AS total_records,
        {sround("avg(solar_generation_mwh)")} AS avg_generation, max(solar_generation_mwh) AS max_generation,
        {sround("stddev_samp(solar_generation_mwh)")} AS std_generation,
        {sround("sum(solar_generation_mwh)")} AS total_generation FROM features""",
    "solar_regional_stats": _CTES + f"""SELECT region, count(*) AS count,
        {sround("avg(solar_generation_mwh)")} AS avg_generation, max(solar_generation_mwh) AS max_generation,
        {sround("sum(solar_generation_mwh)")} AS total_generation FROM features GROUP BY region""",
    "solar_hourly_pattern": _CTES + f"""SELECT transaction_hour,
        {sround("avg(solar_generation_mwh)")} AS avg_generation FROM features GROUP BY transaction_hour""",
    "solar_top_regions": _CTES + f"""SELECT region, count(*) AS count,
        {sround("avg(solar_generation_mwh)")} AS avg_generation, max(solar_generation_mwh) AS max_generation,
        {sround("sum(solar_generation_mwh)")} AS total_generation FROM features GROUP BY region
        ORDER BY avg(solar_generation_mwh) DESC, region LIMIT 5""",
    "solar_report": _CTES + f""", top AS (
        SELECT region, avg(solar_generation_mwh) AS a, sum(solar_generation_mwh) AS s FROM features
        GROUP BY region ORDER BY a DESC, region LIMIT 5),
      ranked AS (SELECT *, row_number() OVER (ORDER BY a DESC, region) AS rk FROM top)
      SELECT 'overall' AS section, 0 AS rank, 'all' AS key, metric, {sround("value")} AS value FROM (
        SELECT 'total_records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM features
        UNION ALL SELECT 'avg_generation', avg(solar_generation_mwh) FROM features
        UNION ALL SELECT 'max_generation', max(solar_generation_mwh) FROM features
        UNION ALL SELECT 'total_generation', sum(solar_generation_mwh) FROM features) o
      UNION ALL
      SELECT 'top_regions', CAST(rk AS INTEGER), region, m.metric, {sround("m.value")} FROM ranked,
        LATERAL (SELECT 'avg_generation' AS metric, a AS value UNION ALL SELECT 'total_generation', s) m""",
    "consumed_dedup": _CTES + "SELECT * FROM consumed_log",
    "consumed_totals": _CTES + f"""SELECT count(*) AS messages, count(DISTINCT region) AS regions,
        {sround("avg(solar_generation_mwh)")} AS avg_generation, max(solar_generation_mwh) AS max_generation,
        min(consumed_at) AS first_consumed, max(consumed_at) AS last_consumed FROM consumed_log""",
    "top_regions": _CTES + f"""SELECT region, count(*) AS messages,
        {sround("avg(solar_generation_mwh)")} AS avg_generation FROM consumed_log
        WHERE solar_generation_mwh IS NOT NULL GROUP BY region
        ORDER BY avg(solar_generation_mwh) DESC, region LIMIT 5""",
    "consumption_stats": _CTES + f"""SELECT s.topic, messages_seen, start_time, end_time,
        coalesce(messages_inserted, 0) AS messages_inserted,
        {sround("CASE WHEN messages_seen > 0 THEN (date_diff('microsecond', start_time, end_time) / 1000.0::DOUBLE) / messages_seen ELSE 0.0::DOUBLE END")}
          AS avg_processing_time_ms
        FROM (SELECT topic, count(*) AS messages_seen, min("timestamp") AS start_time, max("timestamp") AS end_time
              FROM consumed_raw GROUP BY topic) s
        LEFT JOIN (SELECT topic, count(*) AS messages_inserted FROM consumed_log GROUP BY topic) i USING (topic)""",
    "sliding_window_stats": _CTES + f"""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, region,
        {sround("avg(solar_generation_mwh)")} AS avg_generation, max(solar_generation_mwh) AS max_generation,
        count(*) AS count
        FROM (SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") - to_minutes(i) AS window_start, region,
                     solar_generation_mwh FROM consumed_raw, range(0, 5) t(i)) x
        GROUP BY window_start, region""",
    "ml_training_frame": _CTES + """SELECT region, transaction_date, transaction_hour,
        month, day, weekday, is_weekend, is_daylight, solar_generation_mwh FROM features
        WHERE solar_generation_mwh > 0""",
    "ml_linear": _elastic_net_sql() + f"""
        SELECT 'coefficient' AS kind, name, {sround("value")} AS value FROM (
          SELECT unnest({list(_ML)}) AS name, unnest(weights) AS value FROM model
          UNION ALL SELECT '(intercept)', intercept FROM model)
        UNION ALL SELECT 'metric', 'rmse', {sround("sqrt(avg((y - p) ** 2))")} FROM scored
        UNION ALL SELECT 'metric', 'r2', {sround("1 - sum((y - p) ** 2) / (var_pop(y) * count(*))")} FROM scored""",
    "ml_predict": _elastic_net_sql() + f"""
        SELECT region, transaction_date, transaction_hour, {sround("p")} AS prediction FROM scored""",
    "ml_split_baseline": _CTES + _SPLIT + f"""SELECT count(*) FILTER (WHERE is_train) AS n_train,
        count(*) FILTER (WHERE NOT is_train) AS n_test,
        {sround("sqrt(avg((solar_generation_mwh - m) ** 2) FILTER (WHERE NOT is_train))")} AS rmse,
        {sround("1 - sum((solar_generation_mwh - m) ** 2) FILTER (WHERE NOT is_train) / (var_pop(solar_generation_mwh) FILTER (WHERE NOT is_train) * count(*) FILTER (WHERE NOT is_train))")} AS r2
        FROM frame, (SELECT avg(solar_generation_mwh) AS m FROM frame WHERE is_train)""",
    "json_roundtrip": "WITH RECURSIVE" + ",".join([OC.READINGS, OC.CHECKED, OC.REQ.replace("{bkey}", "location")])
        + """ SELECT request_id, location, ts, total_power, solar_efficiency, wind_efficiency, hour, day_of_week,
        is_weekend, quality_score FROM req2""",
}
