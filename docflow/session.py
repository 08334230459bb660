"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings that the operators rely on. AQE splits skewed join partitions and
# picks join strategies from measured sizes, so no operator forces a broadcast.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "docflow", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``. A session without one uses a folder below its warehouse,
    which driver and executors share as well; a machine-local temporary folder is never used."""
    return spark.conf.get("spark.checkpoint.dir", None) or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared root."""
    return os.path.join(shared_root(spark), "docflow", f"{name}-{uuid.uuid4().hex}")


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop file system and path object, so listings work on any storage Spark can reach."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath
