"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "tabmine",
              shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Session with AQE on and the UI off.

    ``master`` defaults to ``local[$BENCH_CPUS or *]``; on a cluster pass the
    cluster's master (or build the session yourself — every operator only
    needs a session, not this helper).
    """
    if master is None:
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("TABMINE_DRIVER_MEM", "16g")))
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the cluster (shared storage). Only
    a local-mode session without the setting (tests, laptops) gets a fresh
    folder under the system temp dir.
    """
    sc = spark.sparkContext
    path = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())  # a folder made here, or set by the caller, stays the session's
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
        path = tempfile.mkdtemp(prefix="tabmine-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used where one intermediate feeds several jobs (fitted constants, rank
    cut points, bootstrap draws): it is computed once, later jobs scan the
    files, and the lineage is cut, so a lost executor costs a re-read rather
    than a recomputation from the sources.
    """
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tabmine-stage/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
