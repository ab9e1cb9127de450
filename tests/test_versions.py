"""Buckets, compaction, widening types, and writers at the same time."""

import json
import threading
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataroll.functions.widening import widened, widens
from strataroll.operators import history as h
from strataroll.plans import jobs
from strataroll.plans.queries import publish_step
from strataroll.sources import versions as v

SCHEMA = "k long, n int, created_at date, updated_at date"
DAY = date(2025, 1, 1)


def snapshot(spark, keys, day, schema=SCHEMA):
    return spark.createDataFrame([(k, day, DAY, DAY + timedelta(day)) for k in keys], schema)


def settings(**more):
    return jobs.Settings(key="k", change_columns=("created_at", "updated_at"), **more)


def publish(spark, root, rows, day, **more):
    publish_step(spark, str(root), rows, DAY + timedelta(day), settings(**more))


def listed(df):
    return Counter(map(str, df.select(*sorted(df.columns)).collect()))


def buckets_in(files):
    return {int(part.split("=")[1]) for f in files for part in f.split("/") if part.startswith(v.BUCKET + "=")}


def test_a_small_snapshot_reads_and_writes_only_its_buckets(spark, tmp_path):
    cut, plain = tmp_path / "cut", tmp_path / "plain"
    for root, more in ((cut, {"buckets": 20}), (plain, {})):
        publish(spark, root, snapshot(spark, range(400), 1), 1, **more)
        publish(spark, root, snapshot(spark, [3, 77, 1000, None], 2), 2, **more)
    few = spark.createDataFrame([(3,), (77,), (1000,)], "k long").select(v.bucket_of("k", 20))
    touched = {r[0] for r in few.collect()}
    record = v.latest(spark, str(cut))
    written = spark.read.parquet(f"{cut}/history/{record.folders['history']}")
    assert buckets_in(written.inputFiles()) == touched and len(touched) <= 3
    read = v.read_current(spark, str(cut), record, touched)
    assert buckets_in(read.inputFiles()) == touched
    untouched = {b for b, folder in record.current.items() if folder != record.folders["history"]}
    assert {*map(int, untouched)} == set(range(20)) - touched
    assert listed(v.read_history(spark, str(cut))) == listed(v.read_history(spark, str(plain)))


def test_buckets_change_with_the_settings(spark, tmp_path):
    pure = None
    steps = [([1, 2, 3, 4, 5], {}), ([1, 2, 6], {"buckets": 3}), ([], {"buckets": 3}), ([2, 7], {"buckets": 3}), ([1, 3, 8], {"buckets": 4}), ([9], {})]
    for day, (keys, more) in enumerate(steps, 1):
        rows = snapshot(spark, keys, day)
        publish(spark, tmp_path, rows, day, **more)
        pure = h.scd2_merge(rows, pure, "k", ["created_at", "updated_at"], DAY + timedelta(day))
        assert listed(v.read_history(spark, str(tmp_path))) == listed(pure)
        assert listed(v.read_current(spark, str(tmp_path))) == listed(pure.filter("is_current"))


def test_rows_without_a_key_or_a_flag_stay_in_buckets(spark, tmp_path):
    rows = [(None, 1, DAY, DAY, True), (1, 2, DAY, DAY, None), (1, 3, DAY, DAY, True), (2, 4, DAY, DAY, False)]
    jobs.adopt_history(spark, spark.createDataFrame(rows, SCHEMA + ", is_current boolean"), str(tmp_path), DAY, settings())
    for day in (1, 2, 3):
        publish(spark, tmp_path, snapshot(spark, [1, day], day), day, buckets=4)
    got = Counter((r.k, r.is_current) for r in v.read_history(spark, str(tmp_path)).collect())
    assert got == {(None, True): 1, (1, None): 1, (1, False): 3, (1, True): 1, (2, False): 1, (2, True): 1, (3, True): 1}


def test_a_column_for_the_bucket_is_refused(spark, tmp_path):
    rows = snapshot(spark, [1], 1).withColumn(v.BUCKET, F.lit(1))
    with pytest.raises(ValueError, match=v.BUCKET):
        publish(spark, tmp_path, rows, 1, buckets=2)


def test_folders_of_closed_rows_stay_few(spark, tmp_path):
    """Fifty versions, each closing a row."""
    root, record = str(tmp_path), v.Record()
    closed = lambda n: spark.createDataFrame([(n, False), (-n, True)], "k int, is_current boolean")
    before = None
    for n in range(1, 51):
        version, run = record.version + 1, v.new_run()
        done = v.write_version(closed(n), root, v.HISTORY, version, ["is_current"], run)
        record = v.commit(spark, root, version, DAY, {v.HISTORY: done}, run=run, base=record)
        if n == 49:
            before = v.read_history(spark, root)
        v.compact(spark, root, 4)
        record = v.latest(spark, root)
        assert len(record.closed) <= 3 * 3
    rows = v.read_history(spark, root)
    assert sorted(r.k for r in rows.collect()) == [-50, *range(1, 51)]
    folders = {f.split("/is_current")[0] for f in rows.inputFiles()}
    assert len(folders) <= 10
    # Readers that began before a compaction still find their folders.
    assert sorted(r.k for r in before.collect()) == [-49, *range(1, 50)]
    assert set(record.history) == {*record.current.values(), *(f for f, _ in record.closed)}


def test_jobs_compact(spark, tmp_path):
    pure = None
    for day in range(1, 6):
        rows = snapshot(spark, [1, 2], day)
        publish(spark, tmp_path, rows, day)
        v.compact(spark, str(tmp_path), 2)
        pure = h.scd2_merge(rows, pure, "k", ["created_at", "updated_at"], DAY + timedelta(day))
    assert listed(v.read_history(spark, str(tmp_path))) == listed(pure)
    with pytest.raises(ValueError):
        v.compact(spark, str(tmp_path), 1)


def raw(folder, keys, day):
    folder.mkdir()
    view = {"columns": [{"fieldName": n, "name": n} for n in ("k", "n", "created_at", "updated_at")]}
    rows = [[k, day, 0, day * 86400] for k in keys]
    (folder / "a.json").write_text(json.dumps({"meta": {"view": view}, "data": rows}))
    return str(folder)


def job_settings(**more):
    columns = {"k": "bigint", "n": "int", "created_at": "epoch_date", "updated_at": "epoch_date"}
    return settings(columns=columns, critical=("k",), ranges={}, unique=("k",), **more)


def race(spark, tmp_path, monkeypatch, attempts):
    """Two runs that both read the first version before either commits the second."""
    root = str(tmp_path / "history")
    jobs.refresh_history(spark, raw(tmp_path / "r0", [0], 1), root, DAY, job_settings())
    paths = [raw(tmp_path / f"r{i}", [i], 2) for i in (1, 2)]
    real, met, first = v.latest, threading.Barrier(2), set()

    def latest(spark, root):
        record = real(spark, root)
        if threading.get_ident() not in first:
            first.add(threading.get_ident())
            met.wait(60)
        return record

    monkeypatch.setattr(v, "latest", latest)
    results = {}

    def run(i):
        try:
            results[i] = jobs.refresh_history(spark, paths[i], root, DAY, job_settings(attempts=attempts))
        except v.Conflict as error:
            results[i] = error

    threads = [threading.Thread(target=run, args=(i,)) for i in (0, 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    monkeypatch.undo()
    return root, results


def test_one_of_two_writers_commits(spark, tmp_path, monkeypatch):
    root, results = race(spark, tmp_path, monkeypatch, attempts=1)
    won = [i for i, r in results.items() if r == 2]
    assert len(won) == 1 and isinstance(results[1 - won[0]], v.Conflict)
    assert sorted(r.k for r in v.read_history(spark, root).collect()) == [0, won[0] + 1]


def test_the_loser_runs_again_and_nothing_is_lost(spark, tmp_path, monkeypatch):
    root, results = race(spark, tmp_path, monkeypatch, attempts=3)
    assert sorted(results.values()) == [2, 3]
    assert sorted(r.k for r in v.read_history(spark, root).collect()) == [0, 1, 2]
    assert [c.version for c in v.commits(spark, root)] == [1, 2, 3]


def test_a_record_is_created_once(spark, tmp_path):
    done = v.write_version(spark.range(1), str(tmp_path), "t", 1)
    v.commit(spark, str(tmp_path), 1, DAY, {"t": done})
    with pytest.raises(v.Conflict):
        v.commit(spark, str(tmp_path), 1, DAY, {"t": done}, base=v.Record())
    with pytest.raises(v.Conflict):
        v.commit(spark, str(tmp_path), 3, DAY, {"t": done})
    assert v.latest(spark, str(tmp_path)).version == 1
    # A record that its writer has not filled yet is not there for readers.
    (tmp_path / "commits" / "2.json").write_text("")
    assert v.latest(spark, str(tmp_path)).version == 1
    assert [c.version for c in v.commits(spark, str(tmp_path))] == [1]


WIDER = [
    ("tinyint", "smallint"), ("int", "bigint"), ("bigint", "decimal(19,0)"), ("int", "decimal(12,2)"), ("float", "double"),
    ("decimal(10,2)", "decimal(12,3)"), ("date", "timestamp_ntz"), ("date", "timestamp"),
]
OTHER = [
    ("bigint", "int"), ("bigint", "decimal(18,0)"), ("decimal(10,2)", "decimal(10,3)"), ("double", "float"), ("int", "double"),
    ("timestamp", "date"), ("string", "int"), ("int", "string"), ("decimal(10,0)", "bigint"), ("int", "int"), ("boolean", "int"),
]


def type_of(name):
    return T._parse_datatype_string(f"c {name}")[0].dataType


@pytest.mark.parametrize("old, new", WIDER)
def test_wider_types(spark, old, new):
    assert widens(type_of(old), type_of(new)) and not widens(type_of(new), type_of(old))


@pytest.mark.parametrize("old, new", OTHER)
def test_types_that_are_not_wider(spark, old, new):
    assert not widens(type_of(old), type_of(new))


def test_a_snapshot_with_a_wider_type_merges_and_a_narrower_one_raises(spark, tmp_path):
    for more in ({}, {"buckets": 3}):
        root = tmp_path / str(len(more))
        for day, kind in enumerate(("int", "bigint", "decimal(20,1)"), 1):
            publish(spark, root, snapshot(spark, [1, day], day).withColumn("n", F.lit(day).cast(kind)), day, **more)
        rows = v.read_history(spark, str(root))
        assert dict(rows.dtypes)["n"] == "decimal(20,1)"
        assert sorted((r.k, int(r.n), r.is_current) for r in rows.collect()) == [
            (1, 1, False), (1, 2, False), (1, 3, True), (2, 2, True), (3, 3, True)]
        with pytest.raises(ValueError, match=r"\['n'\]"):
            publish(spark, root, snapshot(spark, [1], 4), 4, **more)


def test_columns_are_added_and_cast(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    wanted = T.StructType([T.StructField("b", T.StringType()), T.StructField("c", T.DateType()), T.StructField("a", T.LongType())])
    out = widened(df, wanted)
    assert out.dtypes == [("b", "string"), ("c", "date"), ("a", "bigint")] and out.first() == ("x", None, 1)
    with pytest.raises(ValueError, match=r"\['b'\]"):
        widened(df, T.StructType([T.StructField("b", T.LongType())]))
