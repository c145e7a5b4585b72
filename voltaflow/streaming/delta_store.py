"""A results table kept as deliveries in buckets, merged when it is read.

Layout: ``date=/bucket=/epoch=/gen=``. An epoch (micro-batch) only adds its own
deliveries, hashed by key into the buckets of a date that a re-delivery can't change;
nothing stored is read or rewritten. The epoch counts once ``commit`` has written its
number, the last step of a micro-batch, so whatever a crashed epoch left behind in any
sink isn't seen, and running it again replaces it. Readers merge the deliveries of a key:
first-seen columns from the first, ``last_cols`` from the last one.

``compact`` merges buckets of many epochs into generation 1 of their last epoch and
deletes the deliveries it covers. Merged rows come before all deliveries as first
values, and after those of their epoch as last values; so readers get the same rows
before, during and after a compaction, also one that crashed half-way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.operators.rollups import RESULT_UPDATABLE
from voltaflow.session import path_exists

PLACE = ("date", "bucket", "epoch", "gen")


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def commit(spark: SparkSession, path: str, epoch: int) -> None:
    """Make all epochs up to this one count."""
    _, target = _files(spark, f"{path.rstrip('/')}/_committed/{epoch:012d}")
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.create(target, True).close()
    for old in store.listStatus(target.getParent()):  # one or two files: the number is all there is
        if old.getPath().getName() < target.getName():
            store.delete(old.getPath(), False)


def committed(spark: SparkSession, path: str) -> int:
    """The last epoch that counts; -1 before the first."""
    folder = f"{path.rstrip('/')}/_committed"
    if not path_exists(spark, folder):
        return -1
    store, target = _files(spark, folder)
    return max((int(f.getPath().getName()) for f in store.listStatus(target)), default=-1)


def append(batch: DataFrame, path: str, epoch: int, buckets: int, key: str = "result_id", day_col: str = "original_timestamp") -> None:
    """Add the deliveries of an epoch; run again, it replaces them."""
    placed = batch.withColumns({"date": F.to_date(day_col), "bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"),
                                "epoch": F.lit(epoch).cast("long"), "gen": F.lit(0)})
    (placed.repartition("date", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PLACE).parquet(path))


def _deliveries(spark: SparkSession, path: str, schema, upto: int) -> DataFrame:
    if upto < 0 or not path_exists(spark, path):
        return spark.createDataFrame([], f"{schema}, date date, bucket int, epoch long, gen int")
    return spark.read.schema(f"{schema}, date date, bucket int, epoch long, gen int").parquet(path).where(F.col("epoch") <= upto)


def _merged(rows: DataFrame, columns: list[str], key: str, last_cols, by: list[str]) -> DataFrame:
    """One row per key: partially aggregated before the shuffle."""
    # all deliveries of a key are in one (date, bucket), so grouping by these costs nothing more
    content = F.xxhash64(*columns)
    first = F.struct(-F.col("gen"), "epoch", "timestamp", content)
    last = F.struct("epoch", "gen", "timestamp", content)
    others = [c for c in columns if c != key and c not in last_cols]
    out = rows.groupBy(*by, key).agg(F.min_by(F.struct(*others), first).alias("_from_first"),
                                     F.max_by(F.struct(*last_cols), last).alias("_from_last"), F.max("epoch").alias("_epoch"))
    return out.select(*by, *[F.col(f"_from_first.{c}") if c in others else F.col(f"_from_last.{c}") if c in last_cols else F.col(c)
                             for c in columns], "_epoch")


def read(spark: SparkSession, path: str, schema: str, key: str = "result_id", last_cols=RESULT_UPDATABLE, upto: int | None = None) -> DataFrame:
    """The table with the columns of ``schema`` (DDL) and ``date``: one row per key, of the
    committed epochs. Filters on ``date`` prune folders."""
    end = committed(spark, path) if upto is None else upto
    rows = _deliveries(spark, path, schema, end)
    columns = [c for c in rows.columns if c not in PLACE]
    return _merged(rows, columns, key, last_cols, ["date", "bucket"]).drop("bucket", "_epoch")


def compact(spark: SparkSession, path: str, schema: str, at_least: int = 8, key: str = "result_id", last_cols=RESULT_UPDATABLE) -> int:
    """Merge the buckets that hold deliveries of ``at_least`` committed epochs; returns how many."""
    end = committed(spark, path)
    rows = _deliveries(spark, path, schema, end)
    columns = [c for c in rows.columns if c not in PLACE]
    # folders, not rows: one for each bucket in use
    full = (rows.select("date", "bucket", "epoch").distinct().groupBy("date", "bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.max("epoch").alias("last"))
            .where(F.col("n") >= at_least).collect())
    if not full:
        return 0
    of = spark.createDataFrame([(r["date"], r["bucket"], r["last"]) for r in full], "date date, bucket int, _last long")
    own = rows.join(F.broadcast(of), ["date", "bucket"])
    merged = (_merged(own, columns, key, last_cols, ["date", "bucket", "_last"]).drop("_epoch")
              .withColumnsRenamed({"_last": "epoch"}).withColumn("gen", F.lit(1)))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PLACE).parquet(path)
    for r in full:  # what generation 1 covers
        store, folder = _files(spark, f"{path.rstrip('/')}/date={r['date']}/bucket={r['bucket']}")
        for epoch in store.listStatus(folder):
            number = int(epoch.getPath().getName().partition("=")[2])
            if number < r["last"]:
                store.delete(epoch.getPath(), True)
            elif number == r["last"]:
                store.delete(spark._jvm.org.apache.hadoop.fs.Path(epoch.getPath(), "gen=0"), True)
    return len(full)
