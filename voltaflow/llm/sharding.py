"""Sharding by extendible hashing, with DataFrame operations only.

A row's hash is 60 bits of the MD5 of its key. The directory starts with one
bucket that holds everything; a bucket over the byte limit splits on its next
bit, all others stay as they are. Instead of one pass per bit, each round adds
up the bytes below ``ROUND_BITS`` more bits of the open buckets (partially
aggregated before the shuffle) and finds for each of these small cells the
shallowest prefix that fits; so 60 bits take four rounds at most, and usually
one or two. Only sums of bytes are shuffled, never texts.

Rows that share all 60 bits can't be split by hashing (in practice they repeat a
key). Their bucket gets overflow shards: rows over half the limit are a shard
each, the others are laid end to end, from a running sum in two levels (per slice
of the rows, then within a slice), and cut at every half limit, so each shard
fits. A single row over the limit has a shard of its own that is marked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltaflow.llm.common import cut

HASH_BITS = 60
ROUND_BITS = 15
#: Byte limit of a shard in production.
SHARD_BYTES = 1 << 20
#: Shards that one task writes.
SHARDS_PER_TASK = 128


def hashed(key: Column) -> Column:
    """60 bits of the MD5 of a key's text; a null key hashes like no other."""
    text = F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, bits: Column | int) -> Column:
    return F.shiftright(h, HASH_BITS - bits) if isinstance(bits, int) else \
        F.call_function("shiftright", h, (F.lit(HASH_BITS) - bits).cast("int"))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """The directory of ``rows(h, bytes)``: ``prefix`` (as a number), ``depth``,
    ``shard_bytes``, ``shard_rows`` of each shard. Only a shard of depth 60 may
    be over the limit."""
    shards, open_ = [], rows.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b")).where("n > 0")
    open_ = cut(open_.select(F.lit(0).cast("long").alias("prefix"), F.lit(0).alias("depth"),
                             F.col("b").alias("shard_bytes"), F.col("n").alias("shard_rows")))
    for depth in range(0, HASH_BITS, ROUND_BITS):
        fits = F.col("shard_bytes") <= limit
        shards.append(open_.where(fits))
        open_ = open_.where(~fits)
        if open_.isEmpty():
            return _union(shards)
        deep = depth + ROUND_BITS
        cells = (rows.join(open_.select(F.col("prefix").alias("open")), _prefix(F.col("h"), depth) == F.col("open"), "left_semi")
                 .groupBy(_prefix(F.col("h"), deep).alias("cell")).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n")))
        # bytes of every prefix between the open buckets and the cells
        level = (cells.withColumn("depth", F.explode(F.sequence(F.lit(depth + 1), F.lit(deep))))
                 .withColumn("prefix", F.call_function("shiftright", F.col("cell"), F.lit(deep) - F.col("depth")))
                 .groupBy("prefix", "depth").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows")))
        level = cut(level)
        # a prefix is a shard if it fits and its parent doesn't; the deepest stay open if they don't fit
        parent = (level.where(F.col("shard_bytes") > limit)
                  .select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")))
        top = F.col("depth") == depth + 1
        split = level.withColumn("parent", F.shiftright("prefix", 1))
        found = split.where(top).drop("parent").unionByName(
            split.where(~top).join(parent, ["depth", "parent"], "left_semi").drop("parent"))
        shards.append(found.where((F.col("shard_bytes") <= limit) & (F.col("depth") < deep)))
        open_ = cut(found.where(F.col("depth") == deep))
    return _union([*shards, open_])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assign(docs: DataFrame, limit: int = SHARD_BYTES, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``docs``: ``key_col``, ``shard`` (the bits of the
    shard's prefix, ``*`` for the empty one, then ``+`` and a number for overflow
    shards), ``depth``, ``bytes`` and ``oversize`` (the row alone is over the limit).

    A null or empty text has no bytes; a null key is a key like any other, so
    are repeated keys. Other columns are not read. An empty table has no shards.
    """
    return _assigned(docs, limit, key_col, text_col, []).withColumnRenamed("key", key_col)


def _assigned(docs: DataFrame, limit: int, key_col: str, text_col: str, carried: list[Column]) -> DataFrame:
    more = ["_row"] if carried else []
    rows = docs.select(F.col(key_col).alias("key"), hashed(F.col(key_col)).alias("h"),
                       F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"), *carried)
    rows = cut(rows)
    shards = cut(directory(rows.select("h", "bytes"), limit))
    depths = [r["depth"] for r in shards.select("depth").distinct().collect()]  # at most 61 numbers
    # a row belongs to the one depth at which its prefix is a shard
    tried = rows.withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths]))) if depths else \
        rows.withColumn("depth", F.lit(0))
    tried = tried.withColumn("prefix", F.call_function("shiftright", F.col("h"), F.lit(HASH_BITS) - F.col("depth")))
    placed = tried.join(shards.select("prefix", "depth", "shard_bytes"), ["prefix", "depth"])
    bits = F.when(F.col("depth") == 0, F.lit("*")).otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    placed = placed.select("key", "h", "bytes", "depth", bits.alias("shard"), (F.col("shard_bytes") > limit).alias("over"), *more)
    small = placed.where(~F.col("over")).select("key", "shard", "depth", "bytes", *more)
    return (small.unionByName(_overflow(placed.where("over"), limit, more))
            .withColumn("oversize", F.col("bytes") > limit))


def _overflow(rows: DataFrame, limit: int, more: list[str]) -> DataFrame:
    """Overflow shards of buckets that no bit can split."""
    # the slice and the order inside it are kept by the checkpoint
    rows = cut(rows.withColumn("slice", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()))
    big = F.col("bytes") * 2 > limit
    low = rows.where(~big)
    inside = Window.partitionBy("shard", "slice").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = (low.groupBy("shard", "slice").agg(F.sum("bytes").alias("total"))
              .withColumn("before", F.coalesce(F.sum("total").over(across), F.lit(0))).drop("total"))
    start = F.coalesce(F.sum("bytes").over(inside), F.lit(0))
    low = (low.withColumn("start", start).join(before, ["shard", "slice"])
           .withColumn("part", F.floor((F.col("start") + F.col("before")) * 2 / F.lit(limit)).cast("string")))
    high = rows.where(big).withColumn("part", F.concat(F.lit("r"), F.col("nth")))
    columns = ["key", "shard", "depth", "bytes", "part", *more]
    both = low.select(*columns).unionByName(high.select(*columns))
    return both.select("key", F.concat_ws("+", "shard", "part").alias("shard"), "depth", "bytes", *more)


def write(docs: DataFrame, folder: str, limit: int = SHARD_BYTES, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as Parquet in a folder for each shard (``_shard=s0110``, or
    ``_shard=s0110+7`` for an overflow shard) and return the assignment. The rows are
    placed along with their contents, so each goes to the shard it was given, also
    among equal keys, and no folder holds more text than the limit but for the shards
    of single rows over it. A task writes whole shards of at most the limit, so a hot
    key is spread over as many tasks as it has shards."""
    placed = cut(_assigned(docs, limit, key_col, text_col, [F.struct(*docs.columns).alias("_row")]))
    named = F.concat(F.lit("s"), F.replace("shard", F.lit("*"), F.lit("")))
    shards = placed.select("shard").distinct().count()
    (placed.select("_row.*", named.alias("_shard")).repartition(max(1, -(-shards // SHARDS_PER_TASK)), "_shard")
     .write.partitionBy("_shard").parquet(folder))
    return placed.select(F.col("key").alias(key_col), "shard", "depth", "bytes", "oversize")
