"""Hard negatives against plain loops and SQL."""

import math

import duckdb
import numpy as np
import pytest

from strataroll.llm import hard_negatives, queries

LONG = (-(2**63), 2**63 - 1)


def scaled(x):
    return math.floor(x * 256) if abs(x) < 2.0**50 else int(x * 256)


def takes_part(row):
    vec_id, label, v = row[:3]
    return None not in (vec_id, label, v) and all(c is not None and math.isfinite(c * 256) for c in v)


def brute_force(rows, positives=5, negatives=3, every=50, least=50, most=95):
    rows = sorted({(r[0], r[1], tuple(map(scaled, r[2]))) for r in rows if takes_part(r)})
    out = []
    for anchor, label, v in rows:
        if anchor % every:
            continue
        scored = []
        for other, its, w in rows:
            if other != anchor and len(v) == len(w):
                scored.append((-min(max(sum(map(int.__mul__, v, w)), LONG[0]), LONG[1]), other, its))
        scored.sort(key=lambda s: s[:2])
        for minus, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [s for s in scored if s[2] != label and least * -minus <= -100 * s[0] <= most * -minus]
            out += [(anchor, positive, i + 1, s[1], -minus, -s[0]) for i, s in enumerate(fit[:negatives])]
    return sorted(out)


def mined(spark, rows, **settings):
    frame = spark.createDataFrame(
        [(*r, 1, 2.0, "x") for r in rows], "vec_id long, label int, embedding array<double>, size int, cell double, v string"
    )
    return sorted(map(tuple, hard_negatives.mine(frame, **settings).collect()))


def clustered(n, dims=8, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dims))
    return [(i, int(rng.integers(0, 4)), (centers[i % 6] + 0.2 * rng.normal(size=dims)).tolist()) for i in range(n)]


ODD = [
    (None, 1, [1.0] * 8), (2, None, [1.0] * 8), (4, 1, None), (6, 1, [None] + [1.0] * 7), (8, 1, [float("nan")] * 8),
    (10, 1, [float("inf")] + [0.0] * 7), (0, 1, [1.0, 2.0]), (3, 1, [2.0, 1.0]), (9, 2, [1.0, 1.0]), (0, 3, []), (5, 3, []), (7, 4, []),
    (12, 2, [0.0] * 8), (14, 2, [0.0] * 8), (15, 3, [0.0] * 8), (-10, 1, [0.5] * 8), (11, 1, [-0.5] * 8),
]


@pytest.mark.parametrize("sizes", [{}, {"PIECE_ROWS": 40, "BLOCK_ANCHORS": 3, "FANOUT": 3, "LEAF": 4, "PIVOTS": 5}])
def test_mine_by_plain_loops(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = clustered(300)
    rows += ODD + rows[:20]  # repeated rows
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(150)]  # a hot vector, with many labels and ties
    rows += [(rows[0][0], 1, [0.3] * 8)]  # the same id with another vector
    want = brute_force(rows, every=10)
    assert len(want) > 300
    assert mined(spark, rows, every=10) == want


def test_large_components(spark):
    """Products beyond the 53 bits of a double, beyond a long, and lengths whose squares overflow."""
    rng = np.random.default_rng(3)
    rows = [(i, i % 2, (rng.normal(size=3) * 1e6).tolist()) for i in range(60)]
    rows += [(60 + i, i % 2, (rng.normal(size=3) * 1e9).tolist()) for i in range(20)]
    rows += [(100, 0, [1e160, 1.0, 0.0]), (101, 0, [1e160, 0.0, 0.0]), (102, 1, [-1e160, 2.0**50, 1.0])]
    assert mined(spark, rows, every=5) == brute_force(rows, every=5)


def test_without_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, 1, [1.0]), (51, 2, [1.0])]) == []  # no positives
    assert mined(spark, [(50, 1, [1.0]), (51, 1, [1.0])]) == []  # no negatives


def test_query_by_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = queries.op12_hard_negatives(spark, sf_dir)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = connection.sql(hard_negatives.MINE_SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, q = np.floor(256 * rng.normal(size=(200, 6))), np.floor(256 * rng.normal(size=(9, 6)))
    longest = float((x * x).sum(1).max())
    augmented = np.hstack([x, np.sqrt(longest - (x * x).sum(1))[:, None]])
    radius = np.sqrt(((augmented - augmented[0]) ** 2).sum(1)).max()
    low, high = hard_negatives.bounds(q, x[:1], np.array([radius]), longest)
    scores = hard_negatives.products(q, x)
    assert (low <= scores).all() and (scores <= high).all()
