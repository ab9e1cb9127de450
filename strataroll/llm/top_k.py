"""Exact top-k search by inner product with two cover trees, one of queries and one of data.

Data and queries are cut into pieces of bounded size. Each pair of pieces builds both trees and
descends them together. A pair of nodes is left out where even the best product that
their covering radii allow is below the worst k-th score so far in the query node.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataroll.llm.common import saved
from strataroll.llm.hard_negatives import LEAST, MOST, products

DATA_ROWS, QUERY_ROWS = 8192, 16384
#: Children of a node, and rows of a leaf.
FANOUT, DATA_LEAF, QUERY_LEAF = 16, 256, 64


@dataclass
class Node:
    """Rows within ``radius`` of a centre. Centres of children lie apart by their radius at least."""

    center: np.ndarray
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)
    worst: float = -np.inf  # for queries: smallest k-th score within


def distances(x: np.ndarray, rows: np.ndarray, center: int) -> np.ndarray:
    """Distances from a row; infinite where they leave the range of a double."""
    with np.errstate(all="ignore"):
        return np.nan_to_num(np.sqrt(((x[rows] - x[center]) ** 2).sum(1)), nan=np.inf, posinf=np.inf)


def cover_tree(x: np.ndarray, rows: np.ndarray, leaf: int, center: int | None = None) -> Node:
    """Children are the net that farthest-first choice finds, which covers and separates alike."""
    center = rows[0] if center is None else center
    away = distances(x, rows, center)
    node = Node(x[center], float(away.max(initial=0)), rows)
    if len(rows) <= leaf or not 0 < node.radius < np.inf:
        return node
    chosen, near, owner = [center], away, np.zeros(len(rows), np.int64)
    while len(chosen) < FANOUT and near.max() > 0:
        chosen.append(rows[int(near.argmax())])
        d = distances(x, rows, chosen[-1])
        owner[d < near] = len(chosen) - 1
        near = np.minimum(near, d)
    for i, c in enumerate(chosen):
        mine = rows[owner == i]
        if len(mine):
            node.children.append(cover_tree(x, mine, leaf, c))
    return node


class Search:
    """Best scores of all queries of a piece in the rows of a piece."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
        self.q, self.q_ids, self.x, self.ids, self.k = q, q_ids, x, ids, k
        self.scores = np.full((len(q), k), LEAST)
        self.found = np.full((len(q), k), MOST)

    def run(self) -> None:
        queries = cover_tree(self.q, np.arange(len(self.q)), QUERY_LEAF)
        data = cover_tree(self.x, np.arange(len(self.x)), DATA_LEAF)
        self.descend(queries, data, self.best(queries, data))

    @staticmethod
    def best(a: Node, b: Node) -> float:
        """No product of rows of the nodes is above this; the slack is for rounding.

        Where it leaves the range of a double nothing is known. Scores are at least LEAST.
        """
        with np.errstate(all="ignore"):
            lengths = np.linalg.norm(a.center), np.linalg.norm(b.center)
            reach = lengths[0] * b.radius + lengths[1] * a.radius + a.radius * b.radius
            bound = a.center @ b.center + reach + 1e-9 * (lengths[0] * lengths[1] + reach) + 1
        return np.inf if np.isnan(bound) else max(float(bound), float(LEAST))

    def descend(self, a: Node, b: Node, bound: float) -> None:
        if bound < a.worst:
            return
        if not a.children and not b.children:
            self.compare(a, b)
            return
        pairs = [(self.best(x, y), x, y) for x in a.children or [a] for y in b.children or [b]]
        for bound, x, y in sorted(pairs, key=lambda p: -p[0]):
            self.descend(x, y, bound)
        if a.children:
            a.worst = min(c.worst for c in a.children)

    def compare(self, a: Node, b: Node) -> None:
        q, x = a.rows, b.rows
        scores = products(self.q[q], self.x[x])
        ids = np.broadcast_to(self.ids[x], scores.shape)
        own = self.q_ids[q][:, None] == ids
        scores = np.hstack([self.scores[q], np.where(own, LEAST, scores)])
        ids = np.hstack([self.found[q], np.where(own, MOST, ids)])
        order = np.lexsort((ids, ~scores), axis=1)[:, : self.k]  # ~ turns the order round
        self.scores[q] = np.take_along_axis(scores, order, 1)
        self.found[q] = np.take_along_axis(ids, order, 1)
        full = (self.found[q, -1] != MOST).all()
        a.worst = float(self.scores[q, -1].min()) if full else -np.inf


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: components as floor(256 x), for vectors that take part."""
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    # From 2^50 on 256 x is a whole number; floor would make it a long.
    whole = F.transform(x, lambda c: F.when(F.abs(c) < 2.0**50, F.floor(c * 256).cast("double")).otherwise(c * 256))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v")).filter(finite).distinct()


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id ``every`` divides, the ``k`` best others.

    The score is the inner product of the components as floor(256 x); ties go to the smaller id.
    Null vectors, null ids, and vectors with a component that is null or not finite (times 256) take no part.
    Scores are exact however large the components; one beyond a long counts as its nearest end. Vectors of
    different lengths aren't compared. Rows alike in id and vector count once; all rows with
    a query's id are its own and no candidates. Further columns are ignored. An empty table gives no rows.
    """
    rows = saved(usable(vectors).withColumn("size", F.size("v")), "vectors")
    # Of equal vectors the k + 1 smallest ids can be in a result; ranking them combines before the shuffle.
    same = Window.partitionBy("v").orderBy("vec_id")
    data = rows.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k + 1).drop("n")
    queries = rows.filter(F.col("vec_id") % every == 0)
    n_data, n_queries = rows.count(), queries.count()
    pieces, blocks = -(-n_data // DATA_ROWS) or 1, -(-n_queries // QUERY_ROWS) or 1
    number = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    data = data.withColumn("piece", number(pieces)).withColumn("block", all_of(blocks))
    queries = queries.withColumn("block", number(blocks)).withColumn("piece", all_of(pieces))

    def matrix(t: pa.Table) -> np.ndarray:
        flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(t.num_rows, -1) if len(flat) else np.zeros((t.num_rows, 0))

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return EMPTY
        ids = left.column("vec_id").to_numpy()
        s = Search(matrix(left), ids, matrix(right), right.column("vec_id").to_numpy(), k)
        s.run()
        at, place = np.nonzero(s.found != MOST)
        columns = [ids[at], left.column("version").to_numpy()[at], s.found[at, place]]
        columns.append(s.scores[at, place])
        return pa.table([pa.array(c) for c in columns], names=EMPTY.column_names)

    key = ["size", "block", "piece"]
    queries = queries.withColumn("version", F.xxhash64("v"))
    found = queries.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(
        search, "query_id bigint, version bigint, vec_id bigint, score bigint"
    )
    # The same id with other vectors is another query, and the same candidate with its best score.
    best = found.groupBy("query_id", "version", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id", "version").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


EMPTY = pa.table(
    {c: pa.array([], pa.int64()) for c in ("query_id", "version", "vec_id", "score")}
)

#: The registered query in SQL, every query against every row.
TOP_K_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, hash(q.v) AS version, e.vec_id,
    max(CAST(list_inner_product(q.v, e.v) AS BIGINT)) AS score
  FROM e q JOIN e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v) WHERE q.vec_id % 50 = 0
  GROUP BY q.vec_id, hash(q.v), e.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, version ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
