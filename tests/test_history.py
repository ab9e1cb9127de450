"""One test per rule of the history merge; every rule is checked on both plans of the merge."""

from datetime import date

import pytest

from strataroll.operators import history as h

SRC = "k string, v string, created_at date, updated_at date"
TGT = SRC + ", is_current boolean, valid_from date, valid_to date"
CHANGES = ["created_at", "updated_at"]
OLD, NEW, NEWER = date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)
START, RUN = date(2024, 1, 15), date(2024, 6, 1)


def src(spark, *rows):
    return spark.createDataFrame(list(rows), SRC)


def tgt(spark, *rows):
    return spark.createDataFrame(list(rows), TGT)


def cur(k, v, created=OLD, updated=OLD, since=START):
    return (k, v, created, updated, True, since, None)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(params=[False, True], ids=["snapshot", "delta"])
def merge(request):
    def run(source, target, as_of=RUN):
        return h.scd2_merge(source, target, "k", CHANGES, as_of, small_source=request.param)

    return run


def test_no_target(spark, merge):
    got = merge(src(spark, ("a", "x", OLD, None)), None)
    assert rows(got) == [("a", "x", OLD, None, True, RUN, None)]


def test_new_key_is_inserted(spark, merge):
    got = merge(src(spark, ("b", "y", OLD, OLD)), tgt(spark, cur("a", "x")))
    assert rows(got) == [cur("a", "x"), ("b", "y", OLD, OLD, True, RUN, None)]


@pytest.mark.parametrize("created, updated", [(OLD, NEW), (NEW, OLD), (NEW, None), (None, NEW)])
def test_newer_row_closes_the_old_one(spark, merge, created, updated):
    got = merge(src(spark, ("a", "y", created, updated)), tgt(spark, cur("a", "x")))
    assert rows(got) == sorted(
        [
            ("a", "x", OLD, OLD, False, START, RUN),
            ("a", "y", created, updated, True, RUN, None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("created, updated", [(OLD, OLD), (None, None), (OLD, None)])
def test_equal_or_unknown_times_change_nothing(spark, merge, created, updated):
    target = tgt(spark, cur("a", "x"))
    assert rows(merge(src(spark, ("a", "other", created, updated)), target)) == rows(target)


def test_late_row_is_ignored(spark, merge):
    target = tgt(spark, cur("a", "x", NEW, NEW))
    assert rows(merge(src(spark, ("a", "other", OLD, OLD)), target)) == rows(target)


def test_null_times_in_the_target(spark, merge):
    target = tgt(spark, cur("a", "x", None, None))
    assert rows(merge(src(spark, ("a", "other", NEW, NEW)), target)) == rows(target)


def test_vanished_key_stays_current(spark, merge):
    target = tgt(spark, cur("a", "x"), cur("b", "y"))
    assert rows(merge(src(spark, ("a", "x", OLD, OLD)), target)) == rows(target)


def test_null_keys(spark, merge):
    source = src(spark, (None, "lost", NEW, NEW), ("a", "x", OLD, OLD))
    target = tgt(spark, cur("a", "x"), cur(None, "keyless"))
    assert rows(merge(source, target)) == rows(target)
    assert rows(h.without_key(source, "k")) == [(None, "lost", NEW, NEW)]


def test_latest_of_several_source_rows(spark, merge):
    source = src(
        spark,
        ("a", "1", NEW, NEW),
        ("a", "2", OLD, NEWER),
        ("a", "3", NEWER, None),
        ("a", "2", OLD, NEWER),
    )
    got = merge(source, tgt(spark, cur("a", "x")))
    assert rows(got) == sorted(
        [("a", "x", OLD, OLD, False, START, RUN), ("a", "2", OLD, NEWER, True, RUN, None)],
        key=repr,
    )


def test_ties_are_settled_the_same_way_each_time(spark):
    copies = [("a", v, NEW, NEW) for v in "qzm"]
    for order in (copies, copies[::-1]):
        got = h.latest_per_key(src(spark, *order).repartition(3), "k", CHANGES)
        assert rows(got) == [("a", "z", NEW, NEW)]


def test_closed_rows_survive_changes(spark, merge):
    closed = ("a", "w", OLD, OLD, False, OLD, START)
    got = merge(src(spark, ("a", "y", OLD, NEW)), tgt(spark, closed, cur("a", "x")))
    assert closed in rows(got) and len(rows(got)) == 3


def test_null_flags_survive(spark, merge):
    odd = ("z", "w", OLD, OLD, None, OLD, START)
    got = merge(src(spark, ("a", "y", OLD, NEW)), tgt(spark, odd))
    assert odd in rows(got) and len(rows(got)) == 2


def test_added_and_removed_columns(spark, merge):
    source = spark.createDataFrame([("a", OLD, NEW, 7)], "k string, created_at date, updated_at date, extra int")
    got = merge(source, tgt(spark, cur("a", "x"), cur("b", "y")))
    assert got.columns == ["k", "v", "created_at", "updated_at", "extra", *h.TRACKING]
    by = {(r.k, r.is_current): (r.v, r.extra) for r in got.collect()}
    assert by == {("a", True): (None, 7), ("a", False): ("x", None), ("b", True): ("y", None)}


def test_changed_type_is_an_error(spark, merge):
    source = spark.createDataFrame([("a", 1, OLD, NEW)], "k string, v int, created_at date, updated_at date")
    with pytest.raises(ValueError, match="types"):
        merge(source, tgt(spark, cur("a", "x")))


def test_healing(spark, merge):
    got = merge(src(spark, ("a", "y", OLD, NEW)), src(spark, ("a", "x", OLD, OLD)), RUN)
    assert rows(got) == sorted(
        [("a", "x", OLD, OLD, False, RUN, RUN), ("a", "y", OLD, NEW, True, RUN, None)], key=repr
    )


def test_awkward_names(spark, merge):
    names = ["A.B (1-10)", "v `x`", "created_at", "updated_at"]
    source = src(spark, ("a", "y", OLD, NEW)).toDF(*names)
    target = tgt(spark, cur("a", "x")).toDF(*names, *h.TRACKING)
    for small in (False, True):
        got = h.scd2_merge(source, target, names[0], CHANGES, RUN, small_source=small)
        assert got.count() == 2


def test_repeated_and_successive_merges(spark, merge):
    first = src(spark, ("a", "1", OLD, OLD), ("b", "1", OLD, OLD))
    second = src(spark, ("a", "2", OLD, NEW), ("c", "1", NEW, NEW))
    third = src(spark, ("a", "3", OLD, NEWER), ("b", "1", OLD, OLD))
    table = merge(first, None, date(2024, 4, 1))
    assert rows(merge(first, table, date(2024, 4, 2))) == rows(table)
    for source, day in ((second, date(2024, 5, 1)), (third, date(2024, 6, 1))):
        table = merge(source, table, day)
    got = rows(table)
    assert len(got) == 5
    current = [r[0] for r in got if r[4]]
    assert sorted(current) == ["a", "b", "c"]
    assert all(r[6] is None or r[5] <= r[6] for r in got)
    assert [r[1] for r in got if r[0] == "a" and not r[4]] == ["1", "2"]


def test_adopt_closes_older_duplicates(spark):
    copies = [("a", "1", OLD, OLD), ("a", "2", OLD, NEW), ("a", "2", OLD, NEW)]
    table = src(spark, *copies, (None, "n", OLD, OLD), ("b", "1", OLD, OLD))
    got = [(r.k, r.v, r.is_current, r.valid_to) for r in h.adopt(table, "k", CHANGES, RUN).collect()]
    assert sorted(got, key=repr) == sorted(
        [
            ("a", "1", False, RUN),
            ("a", "2", False, RUN),
            ("a", "2", True, None),
            (None, "n", True, None),
            ("b", "1", True, None),
        ],
        key=repr,
    )


def test_parts_make_up_the_merge(spark, merge):
    source = src(spark, ("a", "y", OLD, NEW), ("b", "y", OLD, OLD), ("d", "n", OLD, OLD))
    target = tgt(spark, cur("a", "x"), cur("b", "x"), cur("c", "x"))
    parts = (
        h.unchanged_rows(source, target, "k", CHANGES)
        .unionByName(h.closed_rows(source, target, "k", CHANGES, RUN))
        .unionByName(h.start_tracking(h.changed_rows(source, target, "k", CHANGES), RUN))
    )
    assert rows(parts) == rows(merge(source, target))


def test_full_merge_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = h.scd2_merge(
            src(spark, ("a", "y", OLD, NEW)), tgt(spark, cur("a", "x")), "k", CHANGES, RUN
        )._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("WindowGroupLimit") == 2
