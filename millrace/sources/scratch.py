"""Folders for tables that a query itself makes, where the driver and all executors see them."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; only a local session without that setting gets a temporary one. It goes when Python ends."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", found)
    path = f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001  the JVM may be gone when Python ends
        pass
