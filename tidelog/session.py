"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(app: str = "tidelog", cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "4k")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known to be none by the optimizer."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).where(F.lit(False)).select(*columns)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session, where driver and
    executors share one machine, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return "file://" + os.path.join(tempfile.mkdtemp(prefix="tidelog-"), label)
