"""Schema drift: which columns are new or missing, and what a job does about it."""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEW, MISSING = "new", "missing"
#: New columns that one line of the log lists.
NAMES_A_LINE = 100


def schema_drift(docs: DataFrame, expected: Collection[str]) -> DataFrame:
    """``column_name, status, documents``: how many documents add or lack each column.

    Both directions come from one pass over the catalogues; counts are combined before the shuffle.
    A document without a catalogue lacks every expected column.
    """
    wanted = F.array(*map(F.lit, expected)) if expected else F.array().cast("array<string>")
    described = F.filter("meta.view.columns", lambda c: c["fieldName"].isNotNull())
    names = F.coalesce(F.transform(described, lambda c: c["name"]), F.array().cast("array<string>"))

    def tag(values, status):
        return F.transform(
            values, lambda n: F.struct(n.alias("column_name"), F.lit(status).alias("status"))
        )

    found = F.concat(
        tag(F.array_except(names, wanted), NEW), tag(F.array_except(wanted, names), MISSING)
    )
    return (
        docs.select(F.inline(found))
        .groupBy("column_name", "status")
        .agg(F.count("*").alias("documents"))
    )


def has_columns(df: DataFrame | None, expected: Collection[str]) -> bool:
    """False if the frame is absent, empty or lacks an expected column; extra columns are fine."""
    return df is not None and set(expected) <= set(df.columns) and not df.isEmpty()


def drift_log(drift: DataFrame, logged_at: datetime, lines: int = 1) -> DataFrame:
    """Log lines for new columns as ``value``; no row if there are none.

    Distinct names are dealt to the given number of lines by their hash.
    """
    line = F.pmod(F.xxhash64("column_name"), F.lit(lines)).alias("line")
    new = drift.filter(F.col("status") == NEW)
    names = new.groupBy(line).agg(F.array_sort(F.collect_set("column_name")).alias("names"))
    return names.select(
        # Fixed value: the form of the message.
        F.concat(
            F.lit(f"{logged_at:%Y-%m-%d %H:%M:%S}: Unexpected columns detected: ['"),
            F.array_join("names", "', '"),
            F.lit("']"),
        ).alias("value")
    )


def schema_gate(
    drift: DataFrame, log_path: str, logged_at: datetime, *, on_new: str = "fail"
) -> str | None:
    """Append new columns to the drift log; then raise (``fail``) or return the message (``warn``).

    Names come from the data, so their number has no bound: up to ``NAMES_A_LINE`` are one line,
    which is also the message. More are logged in as many lines as they need, written by
    the executors, and the message counts them.
    """
    if on_new not in ("fail", "warn"):
        raise ValueError(f"on_new must be 'fail' or 'warn', not {on_new!r}")
    new = drift.filter(F.col("status") == NEW).select("column_name").distinct().count()
    if not new:
        return None
    lines = -(-new // NAMES_A_LINE)
    logged = drift_log(drift, logged_at, lines)
    if lines == 1:
        message = logged.first()["value"]
        logged = drift.sparkSession.createDataFrame([(message,)], "value string").coalesce(1)
        listed = message.split(" detected: ", 1)[1]
    else:
        message = f"{logged_at:%Y-%m-%d %H:%M:%S}: {new} unexpected columns detected, listed in {log_path}"
        listed = f"({new} of them)"
    logged.write.mode("append").text(log_path)
    if on_new == "fail":
        # Fixed value: the form of the message.
        raise ValueError(
            f"Unexpected columns {listed}. Please review {log_path} and update the expected columns."
        )
    return message
