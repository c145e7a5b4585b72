"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaflow.session import checkpoint_root


#: Bytes of one Arrow batch that a Python worker holds.
BATCH_BYTES = 1 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches() -> None:
    """Bound the Arrow batches of the session by bytes, since texts can be long.

    A lower setting of the session stays. The setting only cuts batches; no
    result depends on it.
    """
    spark = SparkSession.getActiveSession()
    # without a second argument, which would hide Spark's own default
    now = spark.conf.get(_BATCH) if spark else None
    if now is not None:
        size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(now) if not now.lstrip("-").isdigit() else int(now)
        if size <= 0 or size > BATCH_BYTES:
            spark.conf.set(_BATCH, str(BATCH_BYTES))


def freeing(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task``, a function over the batches of a task, that at its end gives
    back the memory which Arrow's allocator keeps.

    Python workers live on and go from stage to stage, so what each stage left
    there would add up.
    """
    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        pa.default_memory_pool().release_unused()
    return run


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def min_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes under the links (a, b)."""
    lab = np.arange(n)
    while len(a):
        la, lb = lab[a], lab[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(lab, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(lab, up := lab[lab]):
            lab = up
    return lab


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(u, v)``: one row ``(node, root)`` for
    each node that has a link to another node; ``root`` is the smallest node
    reachable.

    Large-star and small-star rounds alternate until no edge changes, which
    takes a number of rounds in the order of log(diameter). A hub is never
    gathered: its minimum comes from a partially aggregated group, and its
    edges are moved by a join that AQE can split. Each round is cut with
    ``checkpoint()``; the driver sees one count and one hash per round.
    """
    edges = cut(edges.where("u is not null and v is not null and u <> v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _signature(edges)
    for _ in itertools.count():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # every edge now points from the larger node to the smaller one
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = cut(large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        after = _signature(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
