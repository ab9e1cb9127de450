"""Fact tables derived from current rows with normalised names."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataroll.functions.names import named

# Default grouping of the aggregate fact, in output order.
GROUPING_COLUMNS = [
    "make",
    "model",
    "model_year",
    "city",
    "county",
    "electric_vehicle_type",
    "state",
    "clean_alternative_fuel_vehicle_cafv_eligibility",
    "electric_utility",
    "counties",
    "congressional_districts",
    "waofm_gis_legislative_district_boundary",
    "created_at",
    "updated_at",
]

# Columns the detail fact leaves out.
DETAIL_EXCLUDES = ["created_at", "updated_at", "vin_1_10", "is_current", "valid_from", "valid_to"]


def detail_fact(current: DataFrame, exclude: Sequence[str] = DETAIL_EXCLUDES) -> DataFrame:
    """Current rows without tracking and record-keeping columns."""
    return current.drop(*exclude)


def _measure(name: str) -> Column:
    return named(name).try_cast("double")


def _exact(name: str, digits: int) -> Column:
    # By way of double, as text in the form 1E5 is no decimal to every Spark.
    return _measure(name).try_cast(f"decimal({digits},6)")


def _fits(name: str, digits: int) -> Column:
    """True for a group whose measures are all decimals of so many digits."""
    return F.count(_measure(name)) == F.count(_exact(name, digits))


def _exact_mean(name: str) -> Column:
    exact = F.when(_fits(name, 28), F.round(F.try_avg(_exact(name, 28)), 2).cast("double"))
    return F.coalesce(exact, F.round(F.avg(_measure(name)), 2))


def _exact_spread(name: str) -> Column:
    """Sample standard deviation from exact sums; only the last division and the root are of doubles.

    The sum of squares is moved to the mean, rounded to six places, before it becomes a double, so nothing is
    lost where the mean is large beside the spread.
    """
    x, n = _exact(name, 19), F.count(_exact(name, 19)).cast("decimal(20,0)")
    total, squares = F.try_sum(x), F.try_sum(F.try_multiply(x, x))
    mean = F.round(F.try_divide(total, n), 6).cast("decimal(19,6)")
    moved = F.try_subtract(squares, F.try_multiply(mean, F.try_subtract(F.try_multiply(total, F.lit(2)), F.try_multiply(mean, n))))
    off = F.try_subtract(total, F.try_multiply(mean, n)).cast("double")
    count = n.cast("double")
    variance = (moved.cast("double") - off * off / count) / F.nullif(count - 1, F.lit(0.0))
    # A rest of the rounding must not make the variance negative.
    exact = F.when((n > 1) & _fits(name, 19), F.when(variance < 0, 0.0).otherwise(F.sqrt(variance)))
    return F.round(F.coalesce(exact, F.stddev_samp(_measure(name))), 2)


def aggregate_fact(
    current: DataFrame,
    as_of: date,
    keys: Sequence[str] = GROUPING_COLUMNS,
    *,
    year: str = "model_year",
    electric_range: str = "electric_range",
    price: str = "base_msrp",
) -> DataFrame:
    """Counts, mean and spread per group, with the age of the group's model year.

    Groups whose year is missing, unreadable or after ``as_of`` are left out; the filter is on a
    grouping column and so runs on the rows, next to the scan. All measures combine before the
    shuffle: a group that holds much of the table arrives as one row per task.

    Means and spread come from exact sums: measures are summed as decimals of six places, so the order in which
    tasks finish changes nothing. A group with a measure that no such decimal holds (beyond ten to the 22nd
    for means, to the 13th for the spread, or not finite), or with sums beyond 38 digits, is computed from doubles.
    """
    if year not in keys:
        raise ValueError(f"{year!r} must be one of the grouping columns")
    age = (F.lit(as_of.year) - named(year).try_cast("int").cast("bigint")).try_cast("int")
    groups = (
        current.filter(age >= 0)
        .groupBy(*map(named, keys))
        .agg(
            F.count("*").alias("vehicle_count"),
            _exact_mean(electric_range).alias("avg_electric_range"),
            _exact_spread(electric_range).alias("stddev_electric_range"),
            _exact_mean(price).alias("avg_base_msrp"),
        )
    )
    return groups.withColumn("vehicle_age", age)
