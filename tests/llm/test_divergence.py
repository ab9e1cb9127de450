"""Divergence of sources against SQL and against plain loops."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest

from strataroll.llm import divergence, queries

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ROWS = [
    ("en", "a", "the cat The dog's cat"), ("en", "a", "the cat"), ("en", "b", "THE Cat éÉ É a1b"), ("en", "b", None),
    ("en", None, "the cat é dog"), ("en", "c", ""), ("en", "c", "cat " * 5000), ("en", "c", "\x00é\U0001f600x \x7fé"),
    ("en", "é", "dog dog dog"), ("de", "a", "eins"), ("de", "b", "eins zwei"), ("fr", "only", "un un un"), ("fr", "only", "un"),
    ("fr", "only", "un deux"), (None, "a", "x y"), (None, "a", "x y"), (None, "b", "x y"), ("", "b", "x"), ("es", None, None),
]
SCHEMA = "lang string, source string, text string, term string, n int, p long, tile string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "x", 1, 2, "z") for r in ROWS], SCHEMA)


def brute_force(rows):
    docs_of, n, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]
        sources[lang].add(source)
        n[lang, source].update(terms)
        docs_of[lang].update(set(terms))
    out = []
    for lang, names in sources.items():
        kept = {t for t, d in docs_of[lang].items() if d >= 3}

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(n[lang, s]) for s in names}
        q = shares(sum((n[lang, s] for s in names), Counter()))
        f = lambda x, y: (x - y) ** 2 // y
        for s in names:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in names - {s}]
            terms = [(t, f(p[s][t], q[t])) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 200)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("tile, strip, held", [(256, 500_000, 500_000), (1, 2, 3), (2, 3, 1)])
def test_audit_by_plain_loops(docs, monkeypatch, tile, strip, held):
    for name, value in (("TILE_ROWS", tile), ("STRIP_CELLS", strip), ("HELD_COUNTS", held)):
        monkeypatch.setattr(divergence, name, value)
    for frame, rows in ((docs, ROWS), (docs.union(docs), ROWS * 2)):
        assert sorted(map(tuple, divergence.audit(frame).collect())) == brute_force(rows)


def test_empty_table(docs):
    assert divergence.audit(docs.filter("false")).count() == 0


def test_query_by_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = queries.op13_divergence(spark, sf_dir)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = connection.sql(divergence.AUDIT_SQL)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert got.columns == want.columns


@pytest.mark.parametrize("sources, terms, density", [(1, 5, 0.5), (40, 300, 0.02), (17, 33, 0.9), (70, 2, 0.3), (3, 5000, 0.001)])
def test_quadtree_by_dense_arrays(sources, terms, density):
    rng = np.random.default_rng(sources)
    there = rng.random((sources, terms)) < density
    there[:, rng.random(terms) < 0.3] = False  # columns of zeros
    p = rng.integers(1, 10**9, (sources, terms))
    zero = rng.integers(1, 100, sources)
    full = np.where(there, p, zero[:, None])
    compare = rng.random((sources, sources)) < 0.7
    total, seen = divergence.divergences(*np.nonzero(there), p[there], zero, compare)
    for a, b in permutations(range(sources), 2):
        if compare[a, b]:
            either = there[a] | there[b]
            assert seen[a, b] == either.sum()
            assert total[a, b] == sum((int(x) - int(y)) ** 2 // int(y) for x, y in zip(full[a][either], full[b][either]))
