import math
import statistics
from datetime import date
from fractions import Fraction

import pytest

from strataroll.functions.names import normalize_columns, normalize_name
from strataroll.operators import facts

AS_OF = date(2025, 6, 1)


@pytest.mark.parametrize("name, normal", [
    ("VIN (1-10)", "vin_1_10"),
    ("WAOFM - GIS - Legislative District Boundary", "waofm_gis_legislative_district_boundary"),
    ("Clean Alternative Fuel Vehicle (CAFV) Eligibility", "clean_alternative_fuel_vehicle_cafv_eligibility"),
    ("2020 Census Tract", "2020_census_tract"),
    ("a.b", "a_b"),
])
def test_names(name, normal):
    assert normalize_name(name) == normal


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], "`A.b` int, `C (d)` int")
    assert normalize_columns(df).columns == ["a_b", "c_d"]
    with pytest.raises(ValueError, match="a_b"):
        normalize_columns(spark.createDataFrame([(1, 2)], "`A.b` int, `a-b` int"))


def test_aggregate(spark):
    rows = [
        ("m", "2020", 10, 1.0), ("m", "2020", 20, 2.005), ("one", "2025", 7, None),
        ("m", None, 1, 1.0), ("m", "2026", 1, 1.0), ("m", "n/a", 1, 1.0), (None, "2024", None, 3.0),
    ]
    df = spark.createDataFrame(rows, "make string, model_year string, electric_range int, base_msrp double")
    got = {r.make: tuple(r)[1:] for r in facts.aggregate_fact(df, AS_OF, ["make", "model_year"]).collect()}
    assert got == {
        "m": ("2020", 2, 15.0, 7.07, 1.5, 5),
        "one": ("2025", 1, 7.0, None, None, 0),
        None: ("2024", 1, None, None, 3.0, 1),
    }
    with pytest.raises(ValueError):
        facts.aggregate_fact(df, AS_OF, ["make"])


def test_aggregate_filters_before_and_combines_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT 'a' make, 2020 model_year, 1 electric_range, 1D base_msrp, 2 other").write.parquet(path)
    plan = facts.aggregate_fact(spark.read.parquet(path), AS_OF, ["make", "model_year"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    below = text.split("Exchange")[1]
    assert "partial_count" in below and "Filter" in below and "other" not in text


def test_detail(spark):
    df = spark.createDataFrame([(1, 2, True)], "make int, vin_1_10 int, is_current boolean")
    assert facts.detail_fact(df).columns == ["make"]


def test_means_do_not_depend_on_the_order_of_rows(spark):
    rows = spark.range(20000).selectExpr(
        "'m' AS make", "'2020' AS model_year", "1 AS electric_range",
        "CASE WHEN id % 2 = 0 THEN 1e15 ELSE 0.07 END AS base_msrp",
    )
    means = {
        facts.aggregate_fact(rows.repartition(n), AS_OF, ["make", "model_year"]).first().avg_base_msrp
        for n in (1, 7, 30)
    }
    assert means == {500000000000000.04}


def spread_of(spark, values, parts, kind="double"):
    rows = spark.createDataFrame([(v,) for v in values], f"electric_range {kind}").selectExpr(
        "'m' AS make", "'2020' AS model_year", "electric_range", "1 AS base_msrp"
    )
    return facts.aggregate_fact(rows.repartition(parts), AS_OF, ["make", "model_year"]).first().stddev_electric_range


@pytest.mark.parametrize("shift", [0, 0.1, 1e6, -3e9, 1e12])
def test_spread_does_not_depend_on_the_order_of_rows(spark, shift):
    values = [shift + (i * 7919 % 1000) / 8 for i in range(3000)]
    exact = statistics.stdev([Fraction(v).limit_denominator(10**6) for v in values])
    assert {spread_of(spark, values, n) for n in (1, 3, 200)} == {round(float(exact), 2)}


@pytest.mark.parametrize("values, spread", [
    ([5.0], None), ([], None), ([None, None], None), ([2.0, 2.0], 0.0), ([1e6 + 0.1] * 3, 0.0),
    ([0.0, 1e14], 70710678118654.75), ([1.0, float("nan")], float("nan")),
])
def test_spread_of_few_and_of_large_measures(spark, values, spread):
    if values:
        got = spread_of(spark, values, 2)
        assert got == spread or (spread and (got != got) == (spread != spread) and (got != got or math.isclose(got, spread)))


def test_means_of_measures_beyond_decimals(spark):
    rows = spark.createDataFrame([("m", 2020, 1.0, 1e25), ("m", 2020, 1e30, 3e25), ("n", 2020, 1.0, 2.0)], "make string, model_year int, electric_range double, base_msrp double")
    got = {r.make: (r.avg_electric_range, r.avg_base_msrp) for r in facts.aggregate_fact(rows, AS_OF, ["make", "model_year"]).collect()}
    assert got == {"m": (5e29, 2e25), "n": (1.0, 2.0)}
