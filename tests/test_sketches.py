"""Distinct counts by sketches, against exact counts."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from strataroll.operators import quality as q, sketches as s
from strataroll.plans import defaults, jobs
from strataroll.sources import versions as v
from test_jobs import FIRST, SECOND, car, raw


@pytest.mark.parametrize("values", [0, 1, 700, 40_000, 300_000])
def test_estimates_lie_within_their_bounds(spark, values):
    rows = spark.range(max(1, values) * 2).select(
        F.when(F.col("id") < values * 2, F.col("id") % max(1, values)).alias("n"), F.lit(None).cast("date").alias("d"),
        (F.col("id") % 3).cast("decimal(5,1)").alias("m"),
    )
    found = {r["column"]: r for r in s.distinct_counts(s.column_sketches(rows.repartition(5), ["n", "d", "m"])).collect()}
    n = found["n"]
    assert n.low <= values <= n.high and abs(n.distinct_values - values) <= 0.04 * values
    assert (found["d"].distinct_values, found["d"].missing) == (0, rows.count())
    assert found["m"].distinct_values == min(3, rows.count())


def test_sketches_of_parts_are_those_of_all_rows(spark):
    rows = spark.range(60_000).select((F.col("id") * 7 % 20_011).alias("a"), F.col("id").cast("string").alias("b"))
    parts = [s.column_sketches(rows.filter(F.col("a") % 3 == i), ["a", "b"]) for i in range(3)]
    merged = s.distinct_counts(s.merged_sketches(parts[0].union(parts[1]).union(parts[2])))
    for r in merged.collect():
        exact = 20_011 if r["column"] == "a" else 60_000
        assert r.rows == 60_000 and r.low <= exact <= r.high


def test_a_column_passes_only_by_the_exact_check(spark):
    rows = spark.range(50_000).select(
        "id", (F.col("id") % 40_000).alias("few"), F.when(F.col("id") > 0, F.col("id")).alias("one_null"),
        F.when(F.col("id") < 49_999, F.col("id")).otherwise(F.lit(7)).alias("one_copy"), F.lit(1).alias("same"),
    )
    got = {r["column"]: r for r in s.uniqueness(rows, s.column_sketches(rows, rows.columns)).collect()}
    exact = {c: q.uniqueness(rows, c).first() for c in rows.columns}
    for c in ("id", "one_copy"):  # as close as this only counting tells
        assert got[c] == exact[c]
    assert got["id"].passed and not got["one_copy"].passed and got["one_copy"].violations == 1
    assert not got["one_null"].passed
    for c in ("few", "same"):
        assert not got[c].passed and got[c].note.startswith("estimated")
        assert abs(got[c].violations - exact[c].violations) <= 0.04 * 50_000


def test_the_job_keeps_sketches_and_reports_the_same_verdicts(spark, tmp_path):
    chosen = jobs.Settings(sketched=True, unique=(defaults.KEY, "Make"))
    reports = []
    for name, settings in (("a", chosen), ("b", jobs.Settings(unique=chosen.unique))):
        root = str(tmp_path / name)
        for n, cars in enumerate((FIRST, SECOND, [car(f"x{i}") for i in range(50)]), 1):
            folder = tmp_path / f"r{n}"
            jobs.refresh_history(spark, raw(folder, cars) if not folder.exists() else str(folder), root, date(2025, 6, n), settings)
        rows = v.read_table(spark, root, "quality").select("check", "column", "passed").collect()
        reports.append(sorted(map(tuple, rows)))
    assert reports[0] == reports[1]
    stored = v.read_versions(spark, str(tmp_path / "a"), "sketches")
    assert {r.version for r in stored.select("version").collect()} == {1, 2, 3}
    keys = s.distinct_counts(s.merged_sketches(stored.drop("version"))).filter(F.col("column") == defaults.KEY).first()
    assert keys.distinct_values == 54 and (keys.rows, keys.missing) == (57, 1)
    assert v.read_versions(spark, str(tmp_path / "b"), "sketches") is None
    assert v.read_versions(spark, str(tmp_path / "none"), "sketches") is None


def test_columns_must_be_given(spark):
    with pytest.raises(ValueError):
        s.column_sketches(spark.range(1), [])
