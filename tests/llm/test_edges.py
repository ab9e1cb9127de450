"""Every operator and pipeline stage on nulls, empty and long texts, repeated rows, clashing columns, and no rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strataroll.llm import decontamination, divergence, mixing, personal_data, quality, queries, secret_scan, simhash, warc
from strataroll.llm.common import saved, scratch

SF_DIR = "/root/testdata/sf0.001"
#: Names that the operators use for columns of their own.
OWN = ["row", "label", "features", "score", "size", "mark", "node", "fp", "key", "kind", "part", "spans", "all", "first", "piece", "block", "taken", "digest"]
PROSE = "The river ran past the old mill and the town beyond it lay quiet under a grey sky. "
ROWS = [
    (1, PROSE * 5, "en", "a"), (1, PROSE * 5, "en", "a"), (1, PROSE * 5, "en", "b"), (None, PROSE * 5, "en", "a"), (2, None, None, None),
    (None, None, None, None), (3, "", "en", None), (4, " \t\n", None, "a"), (5, PROSE * 3000, "de", "b"), (6, "x" * 300_000, "en", "b"),
    (7, "token = 'abcdefgh12345678' " + PROSE, "en", "a"), (8, "\x00 \U0001f600 é " + PROSE * 2, "fr", "a"), (-9, "one", "en", "é"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars int")
    return saved(rows.select("*", *[F.lit(f"own {c}").alias(c) for c in OWN]), "edge-docs")


@pytest.fixture(scope="module")
def plain(docs):
    return docs.select("doc_id", "text", "lang", "source", "n_chars")


def listed(frame):
    return Counter(map(str, frame.collect()))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, plain, name, stage):
    out = saved(stage(spark, docs, SF_DIR), "stage")
    base = saved(stage(spark, plain, SF_DIR), "stage")
    if name == "mix":
        assert listed(out) == listed(base) and out.count() == len(ROWS)
    else:
        assert out.columns == docs.columns and base.columns == plain.columns
        assert listed(out.select(*plain.columns)) == listed(base)
        assert out.filter(" OR ".join(f"`{c}` <> 'own {c}'" for c in OWN)).isEmpty()
        kept = Counter((r.doc_id, r.source) for r in base.collect())
        assert kept <= Counter((r[0], r[3]) for r in ROWS)
        if name == "secrets":
            assert sum(kept.values()) == len(ROWS)
            assert {r.doc_id for r in base.collect() if "[SECRET]" in (r.text or "")} == {7}
            assert all(r.n_chars == len(r.text or "") or r.text is None for r in base.collect())
        if name == "decontamination":
            assert sum(kept.values()) == len(ROWS)
    for frame in (docs, plain):
        none = stage(spark, frame.filter("false"), SF_DIR)
        assert none.count() == 0 and none.columns == (out if frame is docs else base).columns


OPERATORS = {
    "near duplicates": simhash.simhash_components, "mix": mixing.mix_documents, "secrets": secret_scan.scan_secrets,
    "personal data": personal_data.find_personal_data, "divergence": divergence.audit,
    "quality": lambda d: quality.score_quality(d, d.sparkSession.read.parquet(f"{SF_DIR}/labels.parquet")),
    "benchmark": lambda d: decontamination.find_benchmark(d, d.sparkSession.read.parquet(f"{SF_DIR}/benchmark.parquet")),
}


@pytest.mark.parametrize("operator", OPERATORS.values(), ids=OPERATORS)
def test_operators_ignore_further_columns_and_take_no_rows(docs, plain, operator):
    assert listed(operator(docs)) == listed(operator(plain))
    assert operator(docs.filter("false")).count() == 0


def test_rows_alike_score_alike(docs):
    labels = docs.sparkSession.createDataFrame([(1, 1, 0), (1, 0, 1), (3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.score_quality(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    alike = docs.sparkSession.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in quality.score_quality(docs, alike).collect())


def test_pages_of_all_kinds(spark):
    pages = [(1, "u", "a" * 300_000), (2, "u", "a" * 300_000), (3, None, None), (None, "u", "b"), (4, "http://x/é", "\x00é\r\n\r\n"), (4, "u", "b")]
    frame = spark.createDataFrame([(*p, "own", "own", "own") for p in pages], "page_id long, url string, html string, row string, digest string, first string")
    frame = saved(frame, "edge-pages")

    def captures(rows):
        path = scratch(spark, "warc-edge")
        warc.write_captures(rows, path)
        return warc.capture_digests(warc.assemble(saved(warc.read_records(spark, path), "records")))

    found = captures(frame).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.payload_bytes) for r in found) == sorted(
        (p[0] is None, p[0] or 0, len((p[2] or "").encode())) for p in pages
    )
    assert {(r.page_id, r.record_type, r.refers_to) for r in found if r.payload_bytes >= 300_000} == {(1, "response", None), (2, "revisit", 1)}
    assert captures(frame.filter("false")).count() == 0


def test_pipeline_keeps_the_planted_rows_apart(spark, tmp_path):
    """The whole pipeline over the odd rows: the same as its stages one after the other."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    rows = spark.createDataFrame([(*r, len(r[1] or "")) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars int")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    docs = queries.table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, str(tmp_path)), "stage")
    assert listed(corpus_pipeline.run(spark, str(tmp_path))) == listed(docs)
