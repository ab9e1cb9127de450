import pytest

from strataroll.operators import quality as q


def report(df, *args, **kwargs):
    return {(r.check, r.column): r for r in q.quality_report(df, *args, **kwargs).collect()}


def test_all_checks(spark):
    df = spark.createDataFrame(
        [("a", 5, 1.0, "x"), ("a", None, float("nan"), None), (None, 12, -1.0, None)],
        "k string, n int, `d.x` double, `n__rejected` string",
    )
    got = report(df, ["k", "d.x"], {"n": (0, 10), "d.x": (-1, 1), "k": (0, 1)}, ["k"])
    assert {key: (r.passed, r.violations) for key, r in got.items()} == {
        ("completeness", "k"): (False, 1),
        ("completeness", "d.x"): (True, 0),
        ("range", "n"): (False, 1),
        ("range", "d.x"): (False, 1),
        ("range", "k"): (False, 0),
        ("uniqueness", "k"): (False, 2),
        ("conversion", "n"): (False, 1),
    }
    n = got["range", "n"]
    assert (n.observed_min, n.observed_max, n.expected_min, n.expected_max) == (5, 12, 0, 10)
    assert got["range", "k"].note == "not a number column"


def test_bounds_are_inclusive_for_every_number_type(spark):
    df = spark.sql("""
        SELECT CAST(v AS TINYINT) t, CAST(v AS SMALLINT) s, CAST(v AS BIGINT) b,
               CAST(v AS DECIMAL(10, 2)) d, CAST(v AS FLOAT) f FROM VALUES (0), (10) AS x(v)""")
    assert all(r.passed for r in report(df, ranges={c: (0, 10) for c in df.columns}).values())
    assert not any(r.passed for r in report(df, ranges={c: (0, 9.5) for c in df.columns}).values())


def test_column_without_values_fails_its_range(spark):
    got = report(spark.createDataFrame([(None,)], "n int"), ranges={"n": (0, 1)})
    assert not got["range", "n"].passed and got["range", "n"].note == "no values"


def test_unknown_columns(spark):
    df = spark.createDataFrame([(1,)], "n int")
    assert not report(df, ranges={"m": (0, 1)})["range", "m"].passed
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        report(df, ["m"])
    with pytest.raises(ValueError):
        q.quality_report(df)


def test_verdict(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert q.passed(q.quality_report(df, ["n"], {"n": (1, 2)}, ["n"]))
    assert not q.passed(q.quality_report(df, ["n"], {"n": (1, 1)}, ["n"]))


def test_one_pass_for_everything_but_uniqueness(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id k", "id n", "id unused").write.parquet(path)
    plan = q.quality_report(spark.read.parquet(path), ["k", "n"], {"n": (0, 9)}, ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2
    assert "unused" not in text


def test_observed_checks_equal_the_report_without_another_scan(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "a", 1.5, None), (1, None, float("nan"), "x"), (None, "c", -7.0, "y")], "k int, t string, d double, e__rejected string"
    )
    arguments = ["t", "k"], {"d": (0, 1), "t": (0, 1), "k": (0, 5)}
    for name, frame in (("some", rows), ("none", rows.filter("k = 99")), ("wide", rows.repartition(7))):
        checks = q.ObservedChecks(frame, *arguments)
        path = str(tmp_path / name)
        checks.rows.write.parquet(path)
        written = spark.read.parquet(path)
        report = checks.report(written, ["k"])
        assert sorted(map(str, report.collect())) == sorted(map(str, q.quality_report(written, *arguments, ["k"]).collect()))
        scans = checks.report(written)._jdf.queryExecution().optimizedPlan().toString().count("Relation")
        assert scans == 0
    with pytest.raises(ValueError):
        q.ObservedChecks(rows.select("k")).report(rows)
