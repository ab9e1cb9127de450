"""The folder all executors can reach, for tables a job writes only to read them again."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder serves a local master; on a cluster it would be
    visible to one machine only, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="strataroll-")
    return f"{base.rstrip('/')}/{purpose}-{uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A new path as ``shared_folder`` gives it, deleted with all that was written there when the caller is done."""
    path = shared_folder(spark, purpose)
    try:
        yield path
    finally:
        context = spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
