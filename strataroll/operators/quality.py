"""Data-quality checks as one report DataFrame, a row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataroll.functions.names import named
from strataroll.operators.flatten import REJECTED

Bounds = tuple[float, float]

COMPLETENESS, RANGE, UNIQUENESS, CONVERSION = "completeness", "range", "uniqueness", "conversion"


def report_line(
    check: str,
    column: str,
    violations: Column,
    passed: Column | None = None,
    low: Column | None = None,
    high: Column | None = None,
    bounds: Bounds | None = None,
    note: Column | None = None,
) -> Column:
    """One report row as a struct; all rows share this shape."""
    no_number = F.lit(None).cast("double")
    lower, upper = bounds or (None, None)
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        (violations == 0 if passed is None else passed).alias("passed"),
        violations.cast("bigint").alias("violations"),
        (no_number if low is None else low.cast("double")).alias("observed_min"),
        (no_number if high is None else high.cast("double")).alias("observed_max"),
        F.lit(lower).cast("double").alias("expected_min"),
        F.lit(upper).cast("double").alias("expected_max"),
        (F.lit(None).cast("string") if note is None else note).alias("note"),
    )


def quality_report(
    df: DataFrame,
    critical: Sequence[str] = (),
    ranges: Mapping[str, Bounds] | None = None,
    unique: Sequence[str] = (),
) -> DataFrame:
    """``check, column, passed, violations, observed/expected min and max, note``.

    Null counts, ranges and rejected cells share one scan and shuffle one row per task. Each
    uniqueness check is an aggregation of its own that reads and shuffles only its column: in one
    aggregation with the others it would carry all their buffers through the shuffle once per
    distinct value.
    """
    parts = []
    fused = _fused_checks(df, critical, ranges or {})
    if fused:
        parts.append(df.agg(*fused[0]).select(F.inline(F.array(*fused[1]))))
    parts += [uniqueness(df, column) for column in unique]
    if not parts:
        raise ValueError("No checks are given")
    return reduce(DataFrame.unionByName, parts)


def _fused_checks(
    df: DataFrame, critical: Sequence[str], ranges: Mapping[str, Bounds]
) -> tuple[list[Column], list[Column]] | None:
    types = {f.name: f.dataType for f in df.schema}
    sums: list[Column] = []
    lines: list[Column] = []

    def total(value: Column) -> Column:
        sums.append(value.alias(f"m{len(sums)}"))
        return F.col(f"m{len(sums) - 1}")

    for name in critical:
        lines.append(report_line(COMPLETENESS, name, total(F.count_if(named(name).isNull()))))
    for name, (lower, upper) in ranges.items():
        if not isinstance(types.get(name), T.NumericType):
            # As a failed check: the caller asked for a range that cannot be judged.
            lines.append(
                report_line(
                    RANGE,
                    name,
                    F.lit(0),
                    passed=F.lit(False),
                    bounds=(lower, upper),
                    note=F.lit("not a number column"),
                )
            )
            continue
        value = named(name)
        outside = (value < lower) | (value > upper)
        if isinstance(types[name], (T.DoubleType, T.FloatType)):
            outside = F.isnan(value) | outside
        low, high = total(F.min(value)), total(F.max(value))
        violations = total(F.count_if(outside))
        lines.append(
            report_line(
                RANGE,
                name,
                violations,
                passed=low.isNotNull() & (violations == 0),
                low=low,
                high=high,
                bounds=(lower, upper),
                note=F.when(low.isNull(), "no values"),
            )
        )
    for name in types:
        if name.endswith(REJECTED):
            lines.append(
                report_line(CONVERSION, name.removesuffix(REJECTED), total(F.count(named(name))))
            )
    if not lines:
        return None
    # Range checks on unusable columns alone still need one row to report from.
    return (sums or [F.lit(0).alias("m0")], lines)


class ObservedChecks:
    """The checks of ``quality_report`` that need no shuffle, counted by whatever first runs through the rows.

    Write ``rows`` in full once, then ask for the ``report``: it scans nothing again but the unique columns.
    """

    def __init__(
        self,
        df: DataFrame,
        critical: Sequence[str] = (),
        ranges: Mapping[str, Bounds] | None = None,
        more: Sequence[Column] = (),
    ):
        self.fused = _fused_checks(df, critical, ranges or {})
        self.totals = [*(self.fused[0] if self.fused else []), *more]
        self.rows, self.observation, self.schema = df, None, None
        if self.totals:
            self.observation = Observation()
            self.schema = df.agg(*self.totals).schema
            self.rows = df.observe(self.observation, *self.totals)

    def counted(self, written: DataFrame) -> DataFrame:
        """One row of all that was counted, ``more`` aggregates included."""
        found = self.observation.get
        if found.keys() == set(self.schema.names):
            return written.sparkSession.createDataFrame([tuple(found[n] for n in self.schema.names)], self.schema)
        return written.agg(*self.totals)  # no task saw a row, and the plan was cut short

    def report(self, written: DataFrame, unique: Sequence[str] = ()) -> DataFrame:
        """The report of ``quality_report`` for the rows; ``written`` is where they can be read again."""
        parts = []
        if self.fused:
            parts.append(self.counted(written).select(F.inline(F.array(*self.fused[1]))))
        parts += [uniqueness(written, column) for column in unique]
        if not parts:
            raise ValueError("No checks are given")
        return reduce(DataFrame.unionByName, parts)


def uniqueness(df: DataFrame, column: str) -> DataFrame:
    """Report row for a column that should identify rows; every null counts as a duplicate.

    Equal values are combined before the shuffle, so a value that fills much of the table
    costs no more than any other.
    """
    counted = df.agg(
        F.count("*").alias("rows"), F.count_distinct(named(column)).alias("distinct_values")
    )
    line = report_line(UNIQUENESS, column, F.col("rows") - F.col("distinct_values"))
    return counted.select(F.inline(F.array(line)))


def failures(report: DataFrame) -> DataFrame:
    """The failed checks of a report."""
    return report.filter(~F.col("passed"))


def passed(report: DataFrame) -> bool:
    """True if no check of the report failed."""
    return failures(report).isEmpty()
