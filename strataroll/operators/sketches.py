"""Distinct counts by sketches that are stored per version and merged without a scan.

A sketch (HyperLogLog, Spark's own) has a fixed size, however many rows it stands for, and the sketch of several
tables is the union of theirs. It can show that a column does not identify rows, where far fewer values
than rows are certain. It can never show that a column does: then the exact check has to count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataroll.functions.names import named
from strataroll.operators import quality

#: Registers of a sketch are two to this power, a byte each.
PRECISION = 14
#: Bounds are so many standard errors wide: an estimate is outside them about once in two million times.
SIGMAS = 5.0
#: Types that Spark sketches as they are; others count by their text.
DIRECT = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def standard_error(precision: int = PRECISION) -> float:
    """Of an estimate relative to the true number, for merged sketches: 0.8 % at the usual precision."""
    return 1.04 / sqrt(2**precision)


def _value(df: DataFrame, name: str) -> Column:
    return named(name) if isinstance(df.schema[name].dataType, DIRECT) else named(name).cast("string")


def sketch_columns(df: DataFrame, columns: Sequence[str], precision: int = PRECISION) -> list[Column]:
    """Aggregates for ``sketch_table``, two a column and one for all; no distinct values are shuffled."""
    out = [F.count(F.lit(1)).alias("sketch_rows")]
    for i, name in enumerate(columns):
        out.append(F.count_if(named(name).isNull()).alias(f"sketch_missing{i}"))
        out.append(F.hll_sketch_agg(_value(df, name), F.lit(precision)).alias(f"sketch{i}"))
    return out


def sketch_table(totals: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, rows, missing, sketch`` from one row of the aggregates."""
    lines = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("sketch_rows").alias("rows"),
            F.col(f"sketch_missing{i}").alias("missing"),
            F.col(f"sketch{i}").alias("sketch"),
        )
        for i, name in enumerate(columns)
    ]
    return totals.select(F.inline(F.array(*lines)))


def column_sketches(df: DataFrame, columns: Sequence[str], precision: int = PRECISION) -> DataFrame:
    """``column, rows, missing, sketch``: a row for each column, from one pass over the table."""
    if not columns:
        raise ValueError("No columns are given")
    return sketch_table(df.agg(*sketch_columns(df, columns, precision)), columns)


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """The sketches of several tables or versions as those of all their rows."""
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), F.hll_union_agg("sketch").alias("sketch")
    )


def distinct_counts(sketches: DataFrame, precision: int = PRECISION) -> DataFrame:
    """``column, rows, missing, distinct_values, low, high``: the estimate, and the bounds of the true number.

    The upper bound is no higher than the number of rows with a value; nulls are no value.
    """
    estimate = F.hll_sketch_estimate("sketch")
    there = F.col("rows") - F.col("missing")
    wide = SIGMAS * standard_error(precision)
    return sketches.select(
        "column",
        "rows",
        "missing",
        F.least(estimate, there).alias("distinct_values"),
        F.floor(F.least(estimate, there) / (1 + wide)).alias("low"),
        F.least(F.ceil(estimate / (1 - wide)), there).alias("high"),
    )


def uniqueness(df: DataFrame, sketches: DataFrame, precision: int = PRECISION) -> DataFrame:
    """The uniqueness checks of ``quality_report`` for the columns of ``sketches``, which are of ``df``.

    A column that certainly has fewer values than rows fails by its sketch; its violations are an estimate, and
    its note says so. All others are counted exactly, so a column passes only by the exact check. The
    sketches, one for each checked column, are read on the driver.
    """
    lines = []
    for row in distinct_counts(sketches, precision).orderBy("column").collect():
        if row["high"] < row["rows"]:
            line = quality.report_line(
                quality.UNIQUENESS,
                row["column"],
                F.lit(row["rows"] - row["distinct_values"]),
                note=F.lit(f"estimated: {row['low']} to {row['high']} values in {row['rows']} rows"),
            )
            lines.append(df.sparkSession.range(1).select(F.inline(F.array(line))))
        else:
            lines.append(quality.uniqueness(df, row["column"]))
    return reduce(DataFrame.unionByName, lines)
