"""Documents read by ranges of lines, against the same documents read whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strataroll.operators import flatten
from strataroll.sources import envelopes, ranges

META = {"view": {"id": "d[1]", "name": 'say "data": [ twice', "tags": ["[", "]", "a\\", "{"], "columns": [{"fieldName": "a", "name": "A"}],
                 "data": [["no row"]], "owner": {"displayName": "x"}}}
ROWS = [["a", 1, None], None, ["]", "[\"", "\\"], [], [{"b": [1, {"c": "]"}]}, [2, [3]]], ["data", ":", ","], ["é \U0001f600"]]


def document(rows=ROWS, **more):
    return {"meta": META, "data": rows, **more}


def by_row(rows, comma=", ", head="", tail="] }"):
    return head + '{"meta":\n' + json.dumps(META) + ',\n"data" :\n[ ' + f"\n{comma}".join(map(json.dumps, rows)) + "\n" + tail


def comma_after(rows):
    return '{"data":[\n' + ",\n".join(json.dumps(r) for r in rows) + '],\n"more":[["no row"]],"meta":' + json.dumps(META) + "}"


LAYOUTS = {
    "one line": json.dumps(document()),
    "indented": json.dumps(document(), indent=1),
    "tabs, data first": json.dumps({"data": ROWS, "x": [["no row"], []], "meta": META}, indent="\t", ensure_ascii=False),
    "row a line": by_row(ROWS),
    "blank lines": by_row(ROWS, head="\n \n", tail="]\n\n}\n\n").replace("\n,", "\n\n , \n"),
    "comma after": comma_after(ROWS),
    "several a line": by_row(ROWS, comma=", null, ").replace("\n, null", ", null"),
    "escaped name": json.dumps(document()).replace('"data": [["a"', '"d\\u0061ta": [["a"'),
    "no data": json.dumps({"meta": META}, indent=2),
    "null data": '{"meta": {}, "data": null}',
    "empty data": '{"data":[\n\n],"meta":{}}',
    "empty": "{\n}",
    "white space": "  ",
    "long row": json.dumps(document([["x"] * 400, ["y" * 3000], [["z"] * 200]]), indent=0),
}
FAULTS = {
    "second document": by_row(ROWS) + by_row(ROWS),
    "second document on a line of its own": by_row(ROWS) + "\n" + json.dumps(document(), indent=1),
    "text after": by_row(ROWS) + "\nx",
    "bracket after": by_row(ROWS) + "]",
    "root array": json.dumps([document()]),
    "root number": "5",
    "truncated": by_row(ROWS)[:-4],
    "truncated in a row": by_row(ROWS, tail="")[:-9],
    "comma at the end": by_row(ROWS, tail=", ]}"),
    "comma at the start": by_row(ROWS).replace('[ ["a"', '[ , ["a"'),
    "two commas": by_row(ROWS, comma=",\n, "),
    "missing comma": by_row(ROWS, comma=" "),
    "number as row": by_row([["a"], 5, ["b"]]),
    "object as row": by_row([["a"], {"b": 1}, ["b"]]),
    "text as row": by_row([["a"], "x", ["b"]]),
    "object as data": json.dumps({"meta": META, "data": {"a": 1}}),
    "brackets crossed": by_row([["a"]]).replace('["a"]', '["a"}'),
    "open text": by_row([["a"]]).replace('["a"]', '["a]'),
    "bad cell": by_row([["a"]]).replace('["a"]', '["a", x]'),
}


@pytest.fixture(params=[20, 150, 10_000_000], ids="ranges of {} bytes".format)
def small_ranges(spark, request):
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    spark.conf.set(name, str(request.param))
    yield request.param
    spark.conf.set(name, old)


def listed(frame):
    return sorted(frame.select(F.to_json(F.struct("source_file", "record"), {"ignoreNullFields": "false"})).toPandas().iloc[:, 0])


def whole(spark, path):
    docs = envelopes.read_envelopes(spark, path)
    rows = docs.select("source_file", F.posexplode_outer("data").alias("at", "record")).filter("at IS NOT NULL")
    return sorted(map(str, docs.select("meta", "source_file").collect())), listed(rows)


def by_ranges(spark, path, **settings):
    docs, rows = ranges.read_ranges(spark, path, **settings)
    return sorted(map(str, docs.select("meta", "source_file").collect())), listed(rows)


def test_every_layout_reads_as_the_whole_document(spark, tmp_path, small_ranges):
    for i, text in enumerate(LAYOUTS.values()):
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    want = whole(spark, str(tmp_path))
    assert len(want[0]) == len(LAYOUTS) - 1
    assert by_ranges(spark, str(tmp_path)) == want
    if small_ranges == 150:  # starts that are too many to be broadcast
        assert by_ranges(spark, str(tmp_path), broadcast_limit=0) == want


def test_random_documents(spark, tmp_path, small_ranges):
    rng = random.Random(small_ranges)

    def value(depth):
        kind = rng.randrange(7 if depth else 5)
        if kind < 2:
            return "".join(rng.choices('ab"\\[]{}:, é\t', k=rng.randrange(12)))
        if kind < 5:
            return rng.choice([1, 2.5, None, True, "data"])
        if kind == 5:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {rng.choice(["data", "meta", "x", "]"]): value(depth - 1) for _ in range(rng.randrange(3))}

    for i in range(25):
        rows = [None if rng.random() < 0.1 else [value(2) for _ in range(rng.randrange(5))] for _ in range(rng.randrange(30))]
        content = {"x": value(3), "meta": META, "y": value(3)}
        content = dict(rng.sample([*content.items(), ("data", rows)], 4))
        separators = rng.choice([",", " ,\n", "\n, "]), rng.choice([":", "\n:\n"])
        text = json.dumps(content, indent=rng.choice([None, 0, 1]), ensure_ascii=rng.random() < 0.5, separators=separators)
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
    assert by_ranges(spark, str(tmp_path)) == whole(spark, str(tmp_path))


@pytest.mark.parametrize("text", FAULTS.values(), ids=FAULTS)
@pytest.mark.parametrize("size", [30, 10_000_000])
def test_faults_raise_as_in_the_whole_document(spark, tmp_path, text, size):
    path = tmp_path / "a.json"
    path.write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        whole(spark, str(path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        with pytest.raises(Exception, match="(?i)malformed"):
            by_ranges(spark, str(path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_of_white_space_hold_no_document(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n\t \n")
    assert by_ranges(spark, str(tmp_path)) == ([], [])


def test_two_data_arrays_raise(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"meta":{},\n"data":[["a"]],\n"data":[["b"]]}')
    docs, _ = ranges.read_ranges(spark, str(path))
    with pytest.raises(Exception, match="data twice"):
        docs.collect()


def test_rows_meet_their_catalogue(spark, tmp_path):
    for name, order in (("a", "AB"), ("b", "BA")):
        meta = {"view": {"columns": [{"fieldName": c, "name": c} for c in order]}}
        (tmp_path / f"{name}.json").write_text(json.dumps({"meta": meta, "data": [[f"{c}-{name}" for c in order]]}, indent=1))
    docs, rows = ranges.read_ranges(spark, str(tmp_path))
    flat = flatten.flatten_record_lines(rows, docs, {"A": "string", "B": "string"})
    assert sorted(map(tuple, flat.collect())) == [("A-a", "B-a"), ("A-b", "B-b")]
