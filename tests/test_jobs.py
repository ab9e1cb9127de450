"""Publishing and the two jobs, run end to end on small raw files."""

import json
import os
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strataroll import __main__ as command_line
from strataroll.operators import history as h
from strataroll.plans import defaults, jobs
from strataroll.sources import versions as v

DAY = 86400
NAMES = [n for n in defaults.COLUMNS]
CATALOG = [{"fieldName": f"f{i}", "name": n} for i, n in enumerate(["extra", *NAMES])]


def car(key, make="AUDI", year=2020, rng=200, created=1, updated=1):
    values = {n: f"{n} {key}" for n in NAMES} | {
        "Make": make, "Model": "M", "Model Year": year, "Electric Range": rng, "Base MSRP": 100.5,
        "DOL Vehicle ID": key, "created_at": created * DAY, "updated_at": updated * DAY,
        "City": "C", "County": "K", "Counties": "1", "Electric Utility": "U",
        "Clean Alternative Fuel Vehicle (CAFV) Eligibility": "E", "Electric Vehicle Type": "T",
        "State": "WA", "Congressional Districts": "2", "WAOFM - GIS - Legislative District Boundary": "3",
    }
    return ["?", *[values[n] for n in NAMES]]


def raw(folder, cars, layout="document"):
    folder.mkdir()
    view = {"id": "d", "name": "N", "columns": CATALOG, "approvals": [{"state": "approved"}]}
    if layout == "rows":
        text = '{\n"meta" : ' + json.dumps({"view": view}, indent=1) + ',\n"data" : [ '
        text += "\n, ".join(map(json.dumps, cars)) + " ]\n}"
        (folder / "a.json").write_text(text)
    elif layout == "lines":
        lines = [json.dumps({"meta": {"view": view}, "data": [c]}) for c in cars]
        (folder / "a.json").write_text("\n".join(lines))
    else:
        (folder / "a.json").write_text(json.dumps({"meta": {"view": view}, "data": cars}, indent=1))
    return str(folder)


FIRST = [car("a"), car("b"), car("c", "BMW", 1995, 2000)]
SECOND = [car("a", rng=300, updated=5), car("b"), car("d", "FIAT", "n/a"), car(None)]


def brief(df):
    return sorted((r["DOL Vehicle ID"], r["Electric Range"], r.is_current, r.valid_from.day, r.valid_to and r.valid_to.day)
                  for r in df.collect())


@pytest.mark.parametrize(
    "layout, small_source", [("document", False), ("lines", False), ("rows", False), ("document", True)]
)
def test_two_snapshots(spark, tmp_path, layout, small_source):
    root, out = str(tmp_path / "history"), str(tmp_path / "facts")
    settings = jobs.Settings(layout=layout, small_source=small_source)
    jobs.run(spark, raw(tmp_path / "r1", FIRST, layout), root, out, date(2025, 6, 1), settings)
    assert brief(v.read_history(spark, root)) == [
        ("a", 200, True, 1, None), ("b", 200, True, 1, None), ("c", 2000, True, 1, None)]
    jobs.run(spark, raw(tmp_path / "r2", SECOND, layout), root, out, date(2025, 6, 2), settings)
    after = [
        ("a", 200, False, 1, 2), ("a", 300, True, 2, None), ("b", 200, True, 1, None),
        ("c", 2000, True, 1, None), ("d", 200, True, 2, None)]
    assert brief(v.read_history(spark, root)) == after
    # The same snapshot again changes nothing, and closed rows stay.
    jobs.run(spark, raw(tmp_path / "r3", SECOND, layout), root, out, date(2025, 6, 3), settings)
    assert brief(v.read_history(spark, root)) == after
    assert [c.version for c in v.commits(spark, root)] == [1, 2, 3]

    quarantine = v.read_table(spark, root, "quarantine")
    assert [r["DOL Vehicle ID"] for r in quarantine.collect()] == [None]
    found = [tuple(r)[:2] for r in v.read_table(spark, root, "drift").collect()]
    assert found == [("extra", "new")]
    assert v.read_table(spark, root, "metadata").distinct().count() == 1
    assert v.read_table(spark, root, "approvals").distinct().first().state == "approved"
    failed = v.read_table(spark, root, "quality").filter("not passed").collect()
    assert {(r.check, r.column, r.violations) for r in failed} == {
        ("uniqueness", "DOL Vehicle ID", 1), ("conversion", "Model Year", 1)}

    detail = v.read_table(spark, out, "detail")
    assert detail.count() == 4 and not set(detail.columns) & {"vin_1_10", "created_at", "is_current"}
    counts = {(r.make, str(r.updated_at)): (r.vehicle_count, r.avg_electric_range, r.vehicle_age)
              for r in v.read_table(spark, out, "aggregate").collect()}
    assert counts == {
        ("AUDI", "1970-01-06"): (1, 300.0, 5), ("AUDI", "1970-01-02"): (1, 200.0, 5),
        ("BMW", "1970-01-02"): (1, 2000.0, 30)}


def test_closed_rows_are_written_once(spark, tmp_path):
    root = str(tmp_path / "history")
    for n in range(1, 4):
        cars = [car("a", updated=n), car("b")]
        jobs.refresh_history(spark, raw(tmp_path / f"r{n}", cars), root, date(2025, 6, n))
    per_version = [
        spark.read.parquet(v.version_path(root, "history", n)).filter("not is_current").count()
        for n in (1, 2, 3)
    ]
    assert per_version == [0, 1, 1]
    assert v.read_history(spark, root).count() == 4
    read = v.read_current(spark, root)
    assert read.filter("is_current").count() == 2
    assert all("/v=3/" in f for f in read.inputFiles())
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan


def test_failed_run_keeps_the_last_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "history")
    jobs.refresh_history(spark, raw(tmp_path / "r1", FIRST), root, date(2025, 6, 1))
    before = brief(v.read_history(spark, root))
    second = raw(tmp_path / "r2", SECOND)

    def write(df, root, table, *args):
        if table == "history":
            doomed = df.withColumn("Make", F.raise_error(F.lit("disk on fire")).cast("string"))
            return real(doomed, root, table, *args)
        return real(df, root, table, *args)

    real = v.write_version
    monkeypatch.setattr(v, "write_version", write)
    with pytest.raises(Exception, match="disk on fire"):
        jobs.refresh_history(spark, second, root, date(2025, 6, 2))
    assert brief(v.read_history(spark, root)) == before
    assert v.read_table(spark, root, "snapshot").count() == 3
    monkeypatch.undo()
    assert jobs.refresh_history(spark, second, root, date(2025, 6, 2)) == 2
    assert len(brief(v.read_history(spark, root))) == 5


def test_strict_gates_publish_nothing(spark, tmp_path):
    root = str(tmp_path / "history")
    path = raw(tmp_path / "r1", SECOND)
    at = datetime(2025, 4, 11, 10)
    with pytest.raises(ValueError, match=r"\['extra'\]"):
        jobs.refresh_history(spark, path, root, date(2025, 6, 1), jobs.Settings(on_new_columns="fail"), logged_at=at)
    assert [r.value for r in spark.read.text(f"{root}/schema_log").collect()] == [
        "2025-04-11 10:00:00: Unexpected columns detected: ['extra']"]
    with pytest.raises(ValueError, match="quality checks failed"):
        jobs.refresh_history(spark, path, root, date(2025, 6, 1), jobs.Settings(on_failed_checks="fail"))
    assert v.read_history(spark, root) is None and v.commits(spark, root) == []
    with pytest.raises(ValueError, match="No history"):
        jobs.refresh_facts(spark, root, str(tmp_path / "facts"), date(2025, 6, 1))


def test_columns_may_grow(spark, tmp_path):
    root = str(tmp_path / "history")
    old = {n: t for n, t in defaults.COLUMNS.items() if n != "County"}
    jobs.refresh_history(spark, raw(tmp_path / "r1", FIRST), root, date(2025, 6, 1), jobs.Settings(columns=old))
    jobs.refresh_history(spark, raw(tmp_path / "r2", FIRST[1:] + [car("a", updated=9)]), root, date(2025, 6, 2))
    jobs.refresh_history(spark, raw(tmp_path / "r3", [car("a", updated=10)]), root, date(2025, 6, 3))
    county = {(r["DOL Vehicle ID"], str(r.updated_at)): r.County for r in v.read_history(spark, root).collect()}
    assert county == {("a", "1970-01-02"): None, ("a", "1970-01-10"): "K", ("a", "1970-01-11"): "K",
                      ("b", "1970-01-02"): None, ("c", "1970-01-02"): None}


def test_adopting_a_table(spark, tmp_path):
    root = str(tmp_path / "history")
    table = spark.createDataFrame(
        [("a", 1, date(2024, 1, 1), date(2024, 1, 1)), ("a", 2, date(2024, 1, 1), date(2024, 1, 2)),
         (None, 3, None, None)], "k string, n int, created_at date, updated_at date")
    settings = jobs.Settings(key="k")
    jobs.adopt_history(spark, table, root, date(2025, 6, 1), settings)
    got = sorted((r.n, r.is_current) for r in v.read_history(spark, root).collect())
    assert got == [(1, False), (2, True), (3, True)]
    with pytest.raises(ValueError, match="already"):
        jobs.adopt_history(spark, table, root, date(2025, 6, 1), settings)


def test_only_a_missing_path_means_no_history(spark, tmp_path):
    assert v.read_history(spark, str(tmp_path / "none")) is None
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        v.if_present(lambda: spark.table("nowhere"))


def test_version_folder_is_not_a_column(spark, tmp_path):
    with pytest.raises(ValueError, match="'v'"):
        v.write_version(spark.createDataFrame([(1,)], "V int"), str(tmp_path), "t", 1)


def test_allowed_columns(tmp_path):
    good = tmp_path / "c.json"
    good.write_text('{"allowed_columns": ["Make", "Model Year", "Battery Type"]}')
    assert jobs.load_allowed_columns(str(good)) == {"Make": "string", "Model Year": "int", "Battery Type": "string"}
    good.write_text("{}")
    with pytest.raises(ValueError):
        jobs.load_allowed_columns(str(good))
    with pytest.raises(OSError):
        jobs.load_allowed_columns(str(tmp_path / "absent.json"))


def test_published_history_equals_the_pure_merge(spark, tmp_path):
    root = str(tmp_path / "history")
    snapshots = [FIRST, SECOND, [car("a", updated=7), car("c", updated=7)]]
    pure = None
    for n, cars in enumerate(snapshots, 1):
        jobs.refresh_history(spark, raw(tmp_path / f"r{n}", cars), root, date(2025, 6, n))
        rows = v.read_table(spark, root, "snapshot").select(*[f"`{c}`" for c in NAMES])
        pure = h.scd2_merge(rows, pure, defaults.KEY, defaults.CHANGE_COLUMNS, date(2025, 6, n))
    published = v.read_history(spark, root).select(*[f"`{c}`" for c in pure.columns])
    assert published.exceptAll(pure).isEmpty() and pure.exceptAll(published).isEmpty()


def test_command_line_names_every_setting():
    argv = (
        "run --raw r --history h --facts f --as-of 2025-06-01 --layout lines --key id --change-columns seen"
        " --critical a b --unique id --range price 0 9.5 --small-source --on-new-columns fail"
        " --on-failed-checks fail --fact-keys maker year --fact-year year --fact-range reach --fact-price cost"
    )
    given = command_line.settings(command_line.arguments(argv.split()))
    assert given == jobs.Settings(
        key="id", change_columns=("seen",), critical=("a", "b"), ranges={"price": (0.0, 9.5)}, unique=("id",),
        on_new_columns="fail", on_failed_checks="fail", layout="lines", small_source=True,
        fact_keys=("maker", "year"), fact_year="year", fact_range="reach", fact_price="cost",
    )
    few = command_line.settings(command_line.arguments(["history", "--raw", "r", "--history", "h", "--as-of", "2025-06-01"]))
    assert few == jobs.Settings()
    with pytest.raises(SystemExit):
        command_line.arguments(["run", "--raw", "r", "--history", "h", "--as-of", "2025-06-01"])


def test_allowed_columns_by_session(spark, tmp_path):
    listed = tmp_path / "listed.json"
    listed.write_text('{\n "allowed_columns": ["Make"]\n}')
    assert jobs.load_allowed_columns(str(listed), spark) == {"Make": "string"}


def test_rows_under_another_catalogue_are_never_read(spark, tmp_path):
    """Two documents in one file, the second with its columns in another order."""
    folder = tmp_path / "raw"
    folder.mkdir()
    texts = []
    for names in ("ab", "ba"):
        view = {"columns": [{"fieldName": n, "name": n} for n in names]}
        texts.append('{"meta":\n' + json.dumps({"view": view}) + ',\n"data":[\n' + json.dumps([n.upper() for n in names]) + "\n]}")
    (folder / "a.json").write_text("\n".join(texts))
    chosen = jobs.Settings(columns={"a": "string", "b": "string"}, key="a", change_columns=("b",), critical=("a",), ranges={}, unique=("a",))
    for layout in ("document", "rows"):
        with pytest.raises(Exception, match="(?i)malformed"):
            jobs.refresh_history(spark, str(folder), str(tmp_path / layout), date(2025, 6, 1), replace(chosen, layout=layout))
    (folder / "a.json").write_text(texts[0])
    (folder / "b.json").write_text(json.dumps(json.loads(texts[1].replace("A", "C").replace("B", "D")), indent=1))
    for layout in ("document", "rows"):
        root = str(tmp_path / layout)
        assert jobs.refresh_history(spark, str(folder), root, date(2025, 6, 1), replace(chosen, layout=layout)) == 1
        assert sorted((r.a, r.b) for r in v.read_current(spark, root).collect()) == [("A", "B"), ("C", "D")]


def test_job_in_buckets_with_compaction(spark, tmp_path):
    cut, plain = str(tmp_path / "cut"), str(tmp_path / "plain")
    for n, cars in enumerate([FIRST, SECOND, [car("a", updated=7)], [car("b", updated=8)]], 1):
        path = raw(tmp_path / f"r{n}", cars)
        jobs.refresh_history(spark, path, cut, date(2025, 6, n), jobs.Settings(buckets=4, compact_after=2))
        jobs.refresh_history(spark, path, plain, date(2025, 6, n))
    assert brief(v.read_history(spark, cut)) == brief(v.read_history(spark, plain))
    assert len(v.latest(spark, cut).closed) < 4 == len(v.latest(spark, plain).closed)


def test_the_landing_write_is_the_only_scan_for_fused_checks(spark, tmp_path, monkeypatch):
    read = []
    real = v.write_version

    def write(df, root, table, *args):
        if table == "quality":
            read.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
        return real(df, root, table, *args)

    monkeypatch.setattr(v, "write_version", write)
    jobs.refresh_history(spark, raw(tmp_path / "r1", FIRST), str(tmp_path / "h"), date(2025, 6, 1))
    assert read == [1]  # the uniqueness check alone


@pytest.mark.parametrize("limit, merge", [("10MB", "merge_delta"), ("100b", "merge_current")])
def test_a_small_snapshot_is_reduced_once_and_merged_by_its_size(spark, tmp_path, monkeypatch, limit, merge):
    root = str(tmp_path / "history")
    jobs.refresh_history(spark, raw(tmp_path / "r1", FIRST), root, date(2025, 6, 1))
    ranked, used, folders = [], [], []
    for name in ("merge_delta", "merge_current"):
        real = getattr(h, name)
        monkeypatch.setattr(h, name, lambda *a, real=real, name=name, **k: used.append(name) or real(*a, **k))
    rank = h.latest_per_key
    monkeypatch.setattr(h, "latest_per_key", lambda *a: ranked.append(1) or rank(*a))
    read = spark.read.__class__.parquet
    monkeypatch.setattr(spark.read.__class__, "parquet", lambda self, *p: folders.extend(p) or read(self, *p))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        jobs.refresh_history(spark, raw(tmp_path / "r2", SECOND), root, date(2025, 6, 2), jobs.Settings(small_source=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert used == [merge] and ranked == [1]
    assert brief(v.read_history(spark, root)) == [
        ("a", 200, False, 1, 2), ("a", 300, True, 2, None), ("b", 200, True, 1, None), ("c", 2000, True, 1, None), ("d", 200, True, 2, None)]
    # What was only written to be read again is gone.
    scratch = [f for f in folders if "/refresh-" in f]
    assert scratch and not any(os.path.exists(f.rsplit("/", 1)[0]) for f in scratch)
