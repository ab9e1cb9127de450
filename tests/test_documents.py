"""Reading documents, flattening them, and schema drift."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from strataroll.functions.cells import epoch_to_date, typed
from strataroll.operators import drift, flatten as fl
from strataroll.sources import envelopes as env

COLUMNS = {"Make": "string", "Model Year": "int", "Base MSRP": "double", "created_at": "epoch_date"}
CATALOG = [
    {"fieldName": ":id", "name": "id"},
    {"fieldName": "make", "name": "Make"},
    {"name": "Model Year"},
    {"fieldName": "year", "name": "Model Year"},
    {"fieldName": "msrp", "name": "Base MSRP"},
    {"fieldName": ":created_at", "name": "created_at"},
    {"fieldName": "battery", "name": "Battery Type"},
]


def document(data, columns=CATALOG, **view):
    return {"meta": {"view": {"columns": columns, **view}}, "data": data}


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


DATA = [
    ["r1", "AUDI", "skipped", 2020, 1234.5, 1700000000, {"kwh": [1, 2]}],
    ["r2", "BMW, \"i\" ]", None, "n/a", None, -1, None],
    ["r3", "short"],
    ["r4", None, None, "2021", "x", "later", []],
]
FLAT = [
    ("AUDI", 2020, 1234.5, date(2023, 11, 14)),
    ('BMW, "i" ]', None, None, date(1969, 12, 31)),
    ("short", None, None, None),
    (None, 2021, None, None),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_multi_line_document(spark, tmp_path):
    path = write(tmp_path, "a.json", json.dumps(document(DATA), indent=2))
    assert rows(fl.flatten(env.read_envelopes(spark, path), COLUMNS)) == sorted(FLAT, key=repr)


def test_rejected_cells_keep_their_text(spark, tmp_path):
    path = write(tmp_path, "a.json", json.dumps(document(DATA)))
    got = fl.flatten(env.read_envelopes(spark, path), COLUMNS, keep_rejected=True)
    kept = got.select(*[f"`{c}{fl.REJECTED}`" for c in ("Model Year", "Base MSRP", "created_at")])
    assert rows(kept) == sorted(
        [(None, None, None), ("n/a", None, None), (None, None, None), (None, "x", "later")], key=repr
    )


def test_line_documents_are_all_read(spark, tmp_path):
    text = "\n".join(json.dumps(document([row])) for row in DATA)
    docs = env.read_envelopes(spark, write(tmp_path, "a.json", text), multi_line=False)
    assert docs.count() == 4
    assert rows(fl.flatten(docs, COLUMNS)) == sorted(FLAT, key=repr)


def test_each_document_has_its_own_column_order(spark, tmp_path):
    other = [{"fieldName": "y", "name": "Model Year"}, {"fieldName": "m", "name": "Make"}]
    write(tmp_path, "a.json", json.dumps(document([["r", "AUDI", None, 2020]])))
    path = write(tmp_path, "b.json", json.dumps(document([[1999, "FIAT"]], other)))
    got = fl.flatten(env.read_envelopes(spark, path), {"Make": "string", "Model Year": "int"})
    assert rows(got) == [("AUDI", 2020), ("FIAT", 1999)]


@pytest.mark.parametrize("data", [None, []])
def test_no_data_gives_no_rows(spark, tmp_path, data):
    docs = env.read_envelopes(spark, write(tmp_path, "a.json", json.dumps(document(data))))
    assert docs.count() == 1 and fl.flatten(docs, COLUMNS).isEmpty()


def test_no_declared_columns_is_an_error(spark, tmp_path):
    docs = env.read_envelopes(spark, write(tmp_path, "a.json", json.dumps(document(DATA))))
    with pytest.raises(ValueError):
        fl.flatten(docs, {})


def test_broken_document_stops_the_read(spark, tmp_path):
    path = write(tmp_path, "a.json", '{"meta": {"view": {"id": "x"')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        env.read_envelopes(spark, path).collect()


def by_row(head, records, tail):
    body = "\n, ".join(json.dumps(r) for r in records)
    return '{\n  "meta" : ' + json.dumps(head, indent=2) + ',\n  "data" : [ ' + body + tail


@pytest.mark.parametrize("tail", [" ]\n}", "\n]\n}\n", " ] }", "\r\n ]\r\n}"])
def test_rows_on_lines_match_the_document(spark, tmp_path, tail):
    meta = document(None, tags=["a", "b"], description='say "data": [ twice')["meta"]
    path = write(tmp_path, "a.json", by_row(meta, DATA, tail))
    docs, records = env.read_envelopes(spark, path), env.read_record_lines(spark, path)
    assert rows(fl.flatten_record_lines(records, docs, COLUMNS)) == sorted(FLAT, key=repr)


def test_other_row_layouts(spark, tmp_path):
    head = '{"meta":\n' + json.dumps(document(None)["meta"]) + ',\n"data":[\n'
    body = ",\n".join(json.dumps(r) for r in DATA[:2]) + ",\n" + json.dumps(DATA[2]) + "," + json.dumps(DATA[3])
    path = write(tmp_path, "a.json", head + body + "]}")
    docs, records = env.read_envelopes(spark, path), env.read_record_lines(spark, path)
    assert rows(fl.flatten_record_lines(records, docs, COLUMNS)) == sorted(FLAT, key=repr)


def test_null_rows_are_kept_in_every_layout(spark, tmp_path):
    head = '{"meta":\n' + json.dumps(document(None)["meta"]) + ',\n"data":[ null\n'
    body = ", " + json.dumps(DATA[0]) + ", null,\n" + json.dumps(DATA[1]) + ",null\n, [], null ]}"
    path = write(tmp_path, "a.json", head + body)
    docs = env.read_envelopes(spark, path)
    got = rows(fl.flatten_record_lines(env.read_record_lines(spark, path), docs, COLUMNS))
    assert got == rows(fl.flatten(docs, COLUMNS)) and len(got) == 7


@pytest.mark.parametrize("layout", ['"data" : [\n["a"]\n, null\n]}', '"data" : [\nnull ]}'])
def test_lines_that_may_be_rows_or_not_are_an_error(spark, tmp_path, layout):
    path = write(tmp_path, "a.json", '{"meta": {},\n' + layout)
    with pytest.raises(Exception, match="lines of their own"):
        env.read_record_lines(spark, path).collect()


def test_lines_are_parsed_once(spark, tmp_path):
    path = write(tmp_path, "a.json", '{"meta": {},\n"data" : [\n["a"]\n]}')
    plan = env.read_record_lines(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_cell_text_is_the_same_in_every_layout(spark, tmp_path):
    cells = '[ 1.10, 1E+3, {"a" : [ 1 ]}, true, 12345678901234567890, "1.10" ]'
    names = "abcdef"
    meta = json.dumps(document(None, [{"fieldName": n, "name": n} for n in names])["meta"])
    text = '{"meta":\n' + meta + ',\n"data":[\n' + cells + "\n]}"
    path = write(tmp_path, "a.json", text)
    declared = {n: "string" for n in names}
    plain = [("1.1", "1000.0", '{"a":[1]}', "true", "12345678901234567890", "1.10")]
    docs = env.read_envelopes(spark, path)
    assert rows(fl.flatten(docs, declared)) == plain
    assert rows(fl.flatten_record_lines(env.read_record_lines(spark, path), docs, declared)) == plain
    (tmp_path / "lines").mkdir()
    path = write(tmp_path / "lines", "a.json", text.replace("\n", " ") + "\n\n")
    docs = env.read_envelopes(spark, path, multi_line=False)
    assert docs.count() == 1 and rows(fl.flatten(docs, declared)) == plain


@pytest.mark.parametrize("text", [
    json.dumps(document(DATA)),
    json.dumps(document(DATA), indent=1),
])
def test_rows_not_on_lines_are_an_error(spark, tmp_path, text):
    path = write(tmp_path, "a.json", text)
    with pytest.raises(Exception, match="lines of their own|MALFORMED"):
        env.read_record_lines(spark, path).collect()


def test_catalog(spark, tmp_path):
    docs = env.read_envelopes(spark, write(tmp_path, "a.json", json.dumps(document([]))))
    got = [tuple(r) for r in fl.column_catalog(docs).orderBy("ordinal").collect()]
    assert got == [(i, c["fieldName"], c["name"]) for i, c in enumerate(CATALOG) if "fieldName" in c]


def test_metadata_and_approvals(spark, tmp_path):
    approval = {
        "reviewedAt": 5, "reviewedAutomatically": True, "state": "approved", "submissionId": 9,
        "submissionDetails": {"permissionType": "READ"}, "submitter": {"displayName": "S"},
        "submissionOutcomeApplication": {"status": "success"}, "submittedAt": 4,
    }
    full = document([], id="d1", name="N", description="D", owner={"displayName": "O"}, tags=["t"],
                    createdAt=1, publicationDate=2, approvals=[approval, {"state": "pending"}])
    write(tmp_path, "a.json", json.dumps(full))
    write(tmp_path, "b.json", json.dumps(document([], id="d2")))
    docs = env.read_envelopes(spark, write(tmp_path, "c.json", json.dumps(document([], id="d3", approvals=None))))
    assert rows(fl.metadata(env.read_meta(spark, str(tmp_path)))) == rows(fl.metadata(docs))
    assert rows(fl.approvals(env.read_meta(spark, str(tmp_path)))) == rows(fl.approvals(docs))
    assert rows(fl.metadata(docs)) == [
        ("d1", "N", "D", "O", ["t"], 1, 2),
        ("d2", None, None, None, None, None, None),
        ("d3", None, None, None, None, None, None),
    ]
    assert rows(fl.approvals(docs)) == [
        (5, True, "approved", "9", "READ", "S", "success", 4),
        (None, None, "pending", None, None, None, None, None),
    ]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_dates_do_not_depend_on_the_time_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        cells = spark.createDataFrame([("0",), ("86399",), ("86400",), ("-1",), ("x",), (None,)], "s string")
        got = [r[0] for r in cells.select(epoch_to_date(F.col("s")).cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["1970-01-01", "1970-01-01", "1970-01-02", "1969-12-31", None, None]


def test_drift(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps(document([])))
    docs = env.read_envelopes(spark, write(tmp_path, "b.json", json.dumps(document([], None))))
    got = rows(drift.schema_drift(docs, ["Make", "Model Year", "Base MSRP", "created_at", "City"]))
    assert got == sorted([
        ("Battery Type", "new", 1), ("id", "new", 1), ("City", "missing", 2), ("Make", "missing", 1),
        ("Model Year", "missing", 1), ("Base MSRP", "missing", 1), ("created_at", "missing", 1),
    ], key=repr)


def test_gate(spark, tmp_path):
    docs = env.read_envelopes(spark, write(tmp_path, "a.json", json.dumps(document([]))))
    found = drift.schema_drift(docs, [*COLUMNS, "id"])
    at, log = datetime(2025, 4, 11, 10), str(tmp_path / "log")
    with pytest.raises(ValueError, match=r"Unexpected columns \['Battery Type'\]\. Please review"):
        drift.schema_gate(found, log, at)
    line = "2025-04-11 10:00:00: Unexpected columns detected: ['Battery Type']"
    assert drift.schema_gate(found, log, at, on_new="warn") == line
    assert [r.value for r in spark.read.text(log).collect()] == [line, line]
    known = drift.schema_drift(docs, [*COLUMNS, "id", "Battery Type", "City"])
    assert drift.schema_gate(known, log, at) is None
    with pytest.raises(ValueError, match="on_new"):
        drift.schema_gate(known, log, at, on_new="stop")


def test_has_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert drift.has_columns(df, ["a"]) and not drift.has_columns(df, ["a", "c"])
    assert not drift.has_columns(df.filter("a > 1"), ["a"]) and not drift.has_columns(None, [])


def test_metadata_query_does_not_parse_rows(spark, tmp_path):
    path = write(tmp_path, "a.json", json.dumps(document(DATA)))
    plan = fl.metadata(env.read_meta(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "data:array" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("tail", ['\n{"meta": {}, "data": []}', " trailing", "]"])
@pytest.mark.parametrize("read", [env.read_envelopes, env.read_meta])
def test_anything_after_a_document_is_an_error(spark, tmp_path, read, tail):
    (tmp_path / "a.json").write_text('{"meta": {"view": {"id": "x"}},\n "data": [[1]]}' + tail)
    with pytest.raises(Exception):
        read(spark, str(tmp_path)).collect()


def test_whole_numbers_in_any_spelling(spark):
    texts = ["75", "75.0", "1.7E9", "75.5", "3000000000.0", "x", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(typed(F.col("t"), "int")).collect()]
    assert got == [75, 75, 1700000000, None, None, None, None]
    dates = rows.select(typed(F.col("t"), "epoch_date").cast("string").alias("d")).collect()
    assert dates[2].d == "2023-11-14"


def test_many_new_columns_are_counted_not_listed(spark, tmp_path):
    found = spark.range(250).selectExpr("concat('c', id) AS column_name", "'new' AS status", "1L AS documents")
    log = str(tmp_path / "log")
    message = drift.schema_gate(found, log, datetime(2025, 4, 11, 10), on_new="warn")
    assert message == f"2025-04-11 10:00:00: 250 unexpected columns detected, listed in {log}"
    lines = [r.value for r in spark.read.text(log).collect()]
    assert 1 < len(lines) <= 3 and sum(line.count("'c") for line in lines) == 250
    with pytest.raises(ValueError, match="250 of them"):
        drift.schema_gate(found, log, datetime(2025, 4, 11, 10))


@pytest.mark.parametrize("text, whole", [
    ("75", 75), ("75.0", 75), ("75.", 75), ("+75.00", 75), ("7.5E1", 75), ("1.7E3", 1700), (" 75.0 ", 75), ("-0.0", 0), ("75.0000001", None),
    ("74.9999999", None), ("75." + "0" * 30 + "1", None), ("7.55E1", None), ("1.7E-1", None), ("x", None), ("", None), (None, None),
    ("99999999999.0", None),
])
def test_whole_numbers_in_any_spelling(spark, text, whole):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(typed(F.col("c"), "int")).first()[0] == whole
