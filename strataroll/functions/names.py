"""Column-name handling: quoting and normalising."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Replacements that turn a display name into a table name, in the order they apply.
NAME_REPLACEMENTS = [
    (" - ", "_"),
    (" ", "_"),
    ("(", ""),
    (")", ""),
    ("-", "_"),
    (".", "_"),
]


def named(name: str, side: str | None = None) -> Column:
    """Column with exactly this name, whatever characters it holds, optionally of a join side."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{side}.{quoted}" if side else quoted)


def normalize_name(name: str) -> str:
    out = name.lower()
    for old, new in NAME_REPLACEMENTS:
        out = out.replace(old, new)
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its normalised name; two names that collide are an error."""
    names = [normalize_name(c) for c in df.columns]
    clashes = sorted(n for n, count in Counter(names).items() if count > 1)
    if clashes:
        raise ValueError(f"Column names collide after normalising: {clashes}")
    return df.toDF(*names)
