"""Session and scratch-space helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "voltaflow") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC; AQE is Spark's default)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, registered on the SparkContext.

    A folder the caller registered with ``setCheckpointDir`` wins over the
    setting ``spark.checkpoint.dir``. Where neither is given, a temporary
    folder is made for a local master; on a cluster that is an error, because
    every executor would write to its own disk.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        # Spark adds a folder of its own below the one that was set
        return root
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="voltaflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one materialised table under the checkpoint root.

    Every call gives another folder, so two jobs, or two runs of one job, never
    write over each other's files.
    """
    return f"{checkpoint_root(spark).rstrip('/')}/voltaflow/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its store; any error but absence is raised."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)
