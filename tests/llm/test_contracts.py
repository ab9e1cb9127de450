"""Registered operators against plain Python over whole tables, and on rows that broke them before."""

import hashlib
import re

import duckdb
import numpy as np
import pytest

from strataroll.llm import decontamination, mixing, personal_data, quality, queries, secret_scan, top_k
from strataroll.llm.common import saved

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


# --- op5 ------------------------------------------------------------------------------------------


def exact_top(rows, every, k=5):
    whole = lambda v: [int(np.floor(x * 256)) if abs(x) < 2.0**50 else int(x * 256) for x in v]
    fine = {i: whole(v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x * 256) for x in v)}
    out = set()
    for q, v in fine.items():
        if q % every == 0:
            clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
            scores = sorted((-clip(sum(a * b for a, b in zip(v, w))), i) for i, w in fine.items() if i != q and len(v) == len(w))[:k]
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)}
    return out


def test_top_k_keeps_every_finite_vector(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=3) * scale).tolist()) for scale, ids in ((1, range(100)), (1e6, range(100, 160)), (1e9, range(160, 200)), (1e14, range(200, 210))) for i in ids]
    rows += [(1000, [2e6] * 3), (1001, [1e160, 1.0, 0.0]), (1002, [1e160, 2.0, 0.0]), (1010, [-1e160, 0.0, 2.0**50]), (1003, [1e307] * 3)]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id long, embedding array<double>, rank int, size int, v int")
    got = top_k.top_k(frame, every=10).collect()
    want = exact_top(rows, 10)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("sizes", [{}, {"DATA_ROWS": 30, "QUERY_ROWS": 3, "FANOUT": 3, "DATA_LEAF": 4, "QUERY_LEAF": 2}])
def test_top_k_in_small_pieces(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(top_k, name, value)
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(0, 3, 4) / 256).tolist()) for i in range(200)]  # many ties
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in top_k.top_k(frame, every=10).collect()} == exact_top(rows, 10)
    assert top_k.top_k(frame.filter("false")).count() == 0


def test_top_k_by_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    want = connection.sql(top_k.TOP_K_SQL)
    got = queries.op5_top_k(spark, SF_DIR)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# --- op8 ------------------------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def small(number):
    stripped = number.lstrip("0")
    return len(stripped) <= 3 and int(stripped or 0) <= 255


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(small(p) for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def check_personal(row, text):
    base = personal(text)
    counts = [sum(k == kind for k, *_ in base) for kind in ("email", "ip", "card", "phone")]
    assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts
    assert row.base_sha256 == digest(base)
    assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(row.spans.split(",")) | ({""} if not base else set())


def test_personal_data_over_the_table(spark, texts):
    rows = queries.op8_personal_data(spark, SF_DIR).collect()
    assert len(rows) == len(texts) and any(personal(t) for t in texts.values())
    for row in rows:
        check_personal(row, texts[row.doc_id])


def test_numbers_of_any_length_are_personal_data_or_not(spark):
    zeros = "0" * 5000
    odd = [
        f"{zeros}1.2.3.4", f"1.{zeros}255.3.{zeros}", f"1.{zeros}256.3.4", "9" * 30_000, "1 " * 20_000, f"+{'1' * 9000}", "1." * 9000,
        "4111 1111 1111 1111 0", "4111-1111-1111-1111", "", None, "a@b.c" * 2000, "+1 (555) 123-4567" * 3, "@" * 9000, "a@" * 9000,
    ]
    rows = [(i, t, "x") for i, t in enumerate(odd)] * 2
    docs = saved(spark.createDataFrame(rows, "doc_id long, text string, spans string"), "odd")
    got = personal_data.find_personal_data(docs).collect()
    assert len(got) == len(rows)
    for row in got:
        check_personal(row, odd[row.doc_id] or "")


# --- op6 ------------------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_secrets_over_the_table(spark, texts):
    rows = queries.op6_secret_scan(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    planted = [
        "Password: 'abcdefgh' token=short SECRET = \"a.b-c_d/e+f=\" api-key: no apikey:12345678", "AKIA" + "B" * 12 + " AKIA" + "B" * 11 + " xAKIAAKIAAKIAAKIA0",
        "f" * 32 + " " + "e" * 31 + "token=" + "0" * 40 + " g" + "1" * 33, "ſecret=abcdefghij toKen=abcdefghij pass\nword=abcdefgh", "token='' token=\"abc\" tokentoken=abcdefgh", None,
    ]
    more = spark.createDataFrame([(-i, t) for i, t in enumerate(planted, 1)] * 2, "doc_id long, text string")
    rows += secret_scan.scan_secrets(more).collect()
    texts = texts | {-i: t or "" for i, t in enumerate(planted, 1)}
    for row in rows:
        base = secrets(texts[row.doc_id])
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == kind for k, *_ in base) for kind in ("assign", "access", "hex")]
        assert row.base_sha256 == digest(base)
        assert not base or {f"{k}:{a}:{b}" for k, a, b in base} <= set(row.spans.split(","))


KEY = "aB3dE5gH7jK9mN1pQ3sT5vX7zZ"
UUID = "0f8fad5b-d9cb-469f-a165-70867728950e"


@pytest.mark.parametrize("text", [
    f"v1/samples/{KEY}", f"{UUID}/{KEY}", f"{KEY}/{UUID}", f"sha256-{KEY}", f"example={KEY}", f"{KEY}/xxxx", f"see {KEY} there",
])
def test_a_key_beside_an_allowed_part_is_found_and_redacted(text):
    assert KEY not in secret_scan.redact_text(text)
    assert any(kind == 3 for *_, kind in secret_scan.added_spans(text, []))


@pytest.mark.parametrize("text", [
    UUID, f"{UUID}/{UUID}", "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "path/to/some/long-directory_name/of/words",
    "2024-01-01/2024-02-02_0000000000", "exampleKeyaB3dE5gH7jK9mN1pQ3sT5vX7", "x" * 5000, "=" * 40,
])
def test_allowed_forms_alone_are_left(text):
    assert secret_scan.redact_text(text) == text


# --- op4 ------------------------------------------------------------------------------------------


def test_the_mix_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE_DOCS", 5)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs.union(docs.limit(20)).union(docs.limit(10).selectExpr("NULL AS doc_id", "text", "lang", "source", "n_chars"))
    docs = saved(docs, "mixed-docs")
    results = []
    for parts in (1, 3, 7):
        rows = mixing.mix_documents(docs.repartition(parts)).collect()
        results.append(sorted(map(str, rows)))
    assert results[0] == results[1] == results[2] and len(results[0]) == 230


# --- op7 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("odd", ["İ", "K", "ẞ", "Kİİ", "Ⱥ", ""])
def test_letters_that_change_their_size_hide_no_copy(spark, odd):
    item = "Который из этих городов стоит на реке Волге и как давно он там стоит?"
    text = f"{odd} before {odd} {item.upper()} after {odd}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    row = decontamination.find_benchmark(docs, items).first()
    assert text[row.start : row.end].strip() == item.upper() and row.item_id == 7
    assert decontamination.drop_contaminated(docs, items).count() == 0


# --- op10 -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts, part_rows", [(1, 250_000), (40, 250_000), (40, 5), (3, 5)])
def test_partial_sums_are_those_of_all_rows(spark, monkeypatch, parts, part_rows):
    monkeypatch.setattr(quality, "PART_ROWS", part_rows)
    rng = np.random.default_rng(parts)
    width = len(quality.FEATURES)
    x, y = rng.normal(size=(200, width)), rng.integers(0, 2, 200).astype(float)
    train = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "features array<double>, label double")
    square, right = quality._sums(train.repartition(parts), lambda z: z, width)
    assert np.allclose(square, x.T @ x) and np.allclose(right, x.T @ y)
    square, right = quality._sums(train.filter("false"), lambda z: z, width)
    assert not square.any() and not right.any()
