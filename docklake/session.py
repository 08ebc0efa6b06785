"""Session defaults and scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("docklake")
    settings = SESSION_DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="docklake-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) file system."""
    system, target = _located(spark, path)
    return system.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    system, target = _located(spark, path)
    system.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a directory, none if it does not exist."""
    system, target = _located(spark, path)
    if not system.exists(target):
        return []
    return [status.getPath().getName() for status in system.listStatus(target)]


def _located(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target
