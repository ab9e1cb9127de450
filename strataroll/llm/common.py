"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters, as ``bytes.split`` cuts.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that the cluster shares, as ``spark.checkpoint.dir`` names it.

    Raises if the setting is absent and the master is not local; a local one then gets a folder
    in the working directory's warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors can reach")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base.rstrip('/')}/{purpose}-{uuid4().hex}"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def by_batch(
    df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``mapInArrow`` of a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = step(batch)
                if out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    """The texts of a column one by one, so that a batch is not held twice."""
    return (x.as_py() for x in batch.column(column))
