"""Hard negatives by a cover tree over norm-augmented candidates.

A further component makes all candidates equally long: with M the largest length, x becomes
(x, sqrt(M^2 - |x|^2)) and a query q (q, 0). The inner product is then a falling function of the distance,
2 q.x = |q|^2 + M^2 - d^2, and the covering radius of a node bounds the products of all its rows from both
sides. The descent takes the node of the best bound first, skips nodes that lie outside all windows or
below the last of the rows found, and computes the rows of leaves exactly.

Candidates are dealt to cells by their nearest pivot and large cells are cut into pieces. Anchors go
to their own cell first; the scores found there keep them from cells that can hold nothing better.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataroll.llm.common import saved

#: Pivots, from so many rows looked at. They only deal the rows out: any choice gives the same result.
PIVOTS, LOOKED_AT = 64, 1024
#: Rows of a piece of a cell, anchors of a block, children of a node, and rows of a leaf.
PIECE_ROWS, BLOCK_ANCHORS, FANOUT, LEAF = 4096, 4096, 32, 128
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact; those beyond a long are its nearest end."""
    with np.errstate(all="ignore"):
        longest = [np.sqrt((m * m).sum(1)).max(initial=0) for m in (q, x)]
        bound = longest[0] * longest[1]
    if bound < 2.0**52:  # all partial sums are whole numbers that a double holds
        return (q @ x.T).astype(np.int64)
    whole = [np.array([[int(c) for c in row] for row in m], object).reshape(m.shape) for m in (q, x)]
    exact = np.zeros((len(q), len(x)), object)
    for d in range(q.shape[1]):
        exact += whole[0][:, d, None] * whole[1][None, :, d]
    return np.clip(exact, LEAST, MOST).astype(np.int64)


@dataclass
class Node:
    """Rows within ``radius`` of the row ``center``; ``only`` is their label if they share one."""

    center: int
    radius: float
    rows: np.ndarray
    only: int | None = None
    children: list[Node] = field(default_factory=list)


def cover_tree(x: np.ndarray, label: np.ndarray, rows: np.ndarray, center: int) -> Node:
    """Children are a net of far rows, grown until it covers at half the radius of its level or has FANOUT rows."""
    away = np.sqrt(((x[rows] - x[center]) ** 2).sum(1))
    node = Node(center, float(away.max(initial=0)), rows)
    if len(rows) and (label[rows] == label[rows[0]]).all():
        node.only = int(label[rows[0]])
    if len(rows) <= LEAF or not 0 < node.radius < np.inf:
        return node
    chosen, owner = [center], np.zeros(len(rows), np.int64)
    while len(chosen) < FANOUT and away.max() > node.radius / 2:
        chosen.append(int(rows[away.argmax()]))
        d = np.sqrt(((x[rows] - x[chosen[-1]]) ** 2).sum(1))
        owner[d < away] = len(chosen) - 1
        away = np.minimum(away, d)
    node.children = [cover_tree(x, label, rows[owner == i], c) for i, c in enumerate(chosen) if (owner == i).any()]
    return node


def bounds(q: np.ndarray, centers: np.ndarray, radius: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """No product of a query with a row within ``radius`` of a centre is below the first or above the second.

    The slack is for rounding; where lengths leave the range of a double nothing is known.
    """
    with np.errstate(all="ignore"):
        both = (q * q).sum(1)[:, None] + longest
        d = np.sqrt(np.maximum(both - 2 * (q @ centers.T), 0))
        low, high = (both - (d + radius) ** 2) / 2, (both - np.maximum(d - radius, 0) ** 2) / 2
        slack = 1e-6 * both + 1
        return np.nan_to_num(low - slack, nan=-np.inf), np.nan_to_num(high + slack, nan=np.inf)


@dataclass
class Anchors:
    """Anchors of a block: their vectors and labels, and for each window its ends and the worst of ``k`` found."""

    ids: np.ndarray
    v: np.ndarray
    label: np.ndarray
    low: np.ndarray
    high: np.ndarray
    worst: np.ndarray
    k: int
    alike: bool  # candidates of the same label, or of all others

    def __post_init__(self) -> None:
        shape = (*self.low.shape, self.k)
        self.scores, self.found = np.full(shape, LEAST), np.full(shape, MOST)

    def concerned(self, who: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether products between the bounds can matter to any window of each of them."""
        open_ = (high[:, None] >= self.low[who]) & (low[:, None] <= self.high[who]) & (self.low[who] <= self.high[who])
        return (open_ & (high[:, None] >= self.worst[who])).any(1)

    def offer(self, who: np.ndarray, scores: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
        fits = (label[None, :] == self.label[who][:, None]) == self.alike
        fits &= ids[None, :] != self.ids[who][:, None]
        for w in range(self.low.shape[1]):
            inside = fits & (scores >= np.maximum(self.low[who, w], self.worst[who, w])[:, None])
            inside &= scores <= self.high[who, w][:, None]
            some = inside.any(1)
            if not some.any():
                continue
            mine, inside = who[some], inside[some]
            all_scores = np.hstack([self.scores[mine, w], np.where(inside, scores[some], LEAST)])
            all_ids = np.hstack([self.found[mine, w], np.where(inside, ids[None, :], MOST)])
            order = np.lexsort((all_ids, ~all_scores), axis=1)[:, : self.k]  # ~ turns the order round
            self.scores[mine, w] = np.take_along_axis(all_scores, order, 1)
            self.found[mine, w] = np.take_along_axis(all_ids, order, 1)
            self.worst[mine, w] = np.maximum(self.worst[mine, w], self.scores[mine, w, -1])

    def search(self, x: np.ndarray, ids: np.ndarray, label: np.ndarray, longest: float) -> None:
        """Descend the tree of the rows, the node of the best bound first."""
        with np.errstate(all="ignore"):
            extra = np.sqrt(np.maximum(longest - (x * x).sum(1), 0))
            augmented = np.nan_to_num(np.hstack([x, extra[:, None]]), nan=np.inf)
            root = cover_tree(augmented, label, np.arange(len(x)), 0)
        heap = [(0.0, 0, root, np.arange(len(self.ids)), np.full(len(self.ids), -np.inf), np.full(len(self.ids), np.inf))]
        pushed = 0
        while heap:
            _, _, node, who, low, high = heappop(heap)
            who = who[self.concerned(who, low, high)]
            if node.only is not None:
                who = who[(self.label[who] == node.only) == self.alike]
            if not len(who):
                continue
            if not node.children:
                rows = node.rows
                self.offer(who, products(self.v[who], x[rows]), ids[rows], label[rows])
                continue
            centers = np.array([c.center for c in node.children])
            lows, highs = bounds(self.v[who], x[centers], np.array([c.radius for c in node.children]), longest)
            for child, child_low, child_high in zip(node.children, lows.T, highs.T):
                pushed += 1
                heappush(heap, (-float(child_high.max()), pushed, child, who, child_low, child_high))


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, v, size``: components as floor(256 x), for rows that take part; rows alike count once."""
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    # From 2^50 on 256 x is a whole number; floor would make it a long.
    whole = F.transform(x, lambda c: F.when(F.abs(c) < 2.0**50, F.floor(c * 256).cast("double")).otherwise(c * 256))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
    kept = kept.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), whole.alias("v")).filter(finite)
    return kept.distinct().withColumn("size", F.size("v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(flat) else np.zeros((len(column), 0), flat.dtype)


class Cells:
    """Cells around pivots: which one a vector belongs to, and which ones may hold what an anchor looks for."""

    def __init__(self, pivots: list[list[float]], longest: float):
        self.longest, self.pivots = longest, {}
        for size in {len(p) for p in pivots}:
            numbers = [i for i, p in enumerate(pivots) if len(p) == size]
            self.pivots[size] = (np.array(numbers), np.array([pivots[i] for i in numbers]).reshape(len(numbers), size))
        self.radius = np.zeros(len(pivots))

    def home(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each row and the distance to it; -1 and 0 without a pivot of its length."""
        if v.shape[1] not in self.pivots:
            return np.full(len(v), -1), np.zeros(len(v))
        numbers, pivots = self.pivots[v.shape[1]]
        with np.errstate(all="ignore"):
            extra = [np.sqrt(np.maximum(self.longest - (m * m).sum(1), 0)) for m in (v, pivots)]
            away = np.full((len(v), len(pivots)), np.inf)
            for i, p in enumerate(pivots):
                away[:, i] = np.sqrt(((v - p) ** 2).sum(1) + (extra[0] - extra[1][i]) ** 2)
            away = np.nan_to_num(away, nan=np.inf)
        nearest = away.argmin(1)
        return numbers[nearest], away[np.arange(len(v)), nearest]

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``cell`` and the distance ``away`` from its pivot."""

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell, away = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
                sizes = batch.column("size").to_numpy()
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    cell[at], away[at] = self.home(matrix(batch.column("v").take(pa.array(at))))
                arrays = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)]
                yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "cell", "away"])

        fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema)
        return rows.mapInArrow(deal, f"{fields}cell int, away double")

    def others(self, anchors: DataFrame) -> DataFrame:
        """``anchors`` once for each further cell that may hold rows for one of their windows, as ``target``."""

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, cells = (batch.column(c).to_numpy() for c in ("size", "cell"))
                for size in np.unique(sizes[cells >= 0]):
                    part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                    numbers, pivots = self.pivots[size]
                    block = block_of(part, 1, True)
                    low, high = bounds(block.v, pivots, self.radius[numbers], self.longest)
                    everyone = np.arange(len(block.ids))
                    wanted = np.stack([block.concerned(everyone, *ends) for ends in zip(low.T, high.T)], 1)
                    wanted &= numbers[None, :] != part.column("cell").to_numpy()[:, None]
                    who, which = np.nonzero(wanted)
                    arrays = [c.take(pa.array(who)) for c in part.columns] + [pa.array(numbers[which].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names, "target"])

        fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in anchors.schema)
        return anchors.mapInArrow(route, f"{fields}target int")


def block_of(table: pa.Table | pa.RecordBatch, k: int, alike: bool) -> Anchors:
    ids, label = (np.asarray(table.column(c)) for c in ("anchor_id", "label"))
    v = matrix(table.column("v"))
    return Anchors(ids, v, label, *(matrix(table.column(c)).copy() for c in ("low", "high", "worst")), k, alike)


FOUND = ["anchor_id", "version", "window", "vec_id", "score"]


def best_rows(anchors: DataFrame, data: DataFrame, cells: Cells, k: int, alike: bool) -> DataFrame:
    """``anchor_id, version, window, rank, vec_id, score``: the ``k`` best rows in each window of each anchor.

    ``anchors`` has ``anchor_id, version, label, v, size, cell``, and an entry for each window in ``low, high``
    (ends included, a window with low > high is closed). ``data`` has ``vec_id, label, v, size, cell, piece``.
    """
    longest = cells.longest

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        block = block_of(left, k, alike)
        if left.num_rows and right.num_rows:
            block.search(matrix(right.column("v")), *(right.column(c).to_numpy() for c in ("vec_id", "label")), longest)
        at, window, place = np.nonzero(block.found != MOST)
        columns = [block.ids[at], left.column("version").to_numpy()[at], window]
        columns += [block.found[at, window, place], block.scores[at, window, place]]
        return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=FOUND)

    pieces = data.select("size", F.col("cell").alias("target"), "piece").distinct()
    # Anchors of neighbouring cells share a block, as each block builds the trees of the pieces that it visits.
    blocks = min(-(-anchors.count() // BLOCK_ANCHORS), PIVOTS)
    anchors = anchors.withColumn("near", F.expr(f"(cell * {blocks}) div {PIVOTS}"))
    crowd = anchors.groupBy("size", "near").agg(F.ceil(F.count("*") / BLOCK_ANCHORS).alias("parts"))
    part = F.pmod(F.xxhash64("anchor_id"), "parts").alias("part")
    anchors = anchors.join(crowd, ["size", "near"]).withColumn("block", F.struct("near", part)).drop("parts", "near")
    key = ["size", "target", "piece", "block"]

    def visit(routed: DataFrame) -> DataFrame:
        sent = saved(routed.join(pieces, ["size", "target"]).drop("cell"), "sent-anchors")
        wanted = saved(sent.select(*key).distinct(), "wanted-pieces")
        visited = data.withColumnRenamed("cell", "target").join(wanted, key[:3])
        found = sent.groupBy(*key).cogroup(visited.groupBy(*key)).applyInArrow(search, ", ".join(f"{c} bigint" for c in FOUND))
        return saved(found, "found-rows")

    order = Window.partitionBy("anchor_id", "version", "window").orderBy(F.desc("score"), "vec_id")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    none = F.transform("low", lambda _: F.lit(LEAST))
    at_home = visit(anchors.withColumns({"worst": none, "target": F.col("cell")}))
    last = ranked(at_home).filter(F.col("rank") == k).groupBy("anchor_id", "version")
    last = last.agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("last"))
    known = F.transform("low", lambda _, i: F.coalesce(F.try_element_at("last", i.cast("bigint")), F.lit(LEAST)))
    anchors = anchors.join(last, ["anchor_id", "version"], "left").withColumn("worst", known).drop("last")
    return ranked(at_home.union(visit(cells.others(anchors))))


def mine(
    rows: DataFrame, positives: int = 5, negatives: int = 3, every: int = 50, least: int = 50, most: int = 95
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vec_id, label, embedding``.

    Anchors are rows whose id ``every`` divides; their positives the ``positives`` best other rows of their label.
    For each positive, the ``negatives`` best rows of other labels with a score from ``least`` to ``most``
    hundredths of its score. Scores are inner products of the components as floor(256 x); ties
    go to the smaller id.

    Rows with a null id, label or vector, or with a component that is null or not finite (times 256), take no
    part. Rows alike in id, label and vector count once; all rows with an anchor's id are its own. Vectors of
    other lengths aren't compared. A score beyond a long counts as its nearest end. Further columns
    are ignored. An empty table, or one without positives or negatives, gives no rows.
    """
    base = saved(usable(rows), "vectors")
    # Of rows alike in vector and label only the smallest ids can be in a result; ranking them combines before the shuffle.
    same = Window.partitionBy("v", "label").orderBy("vec_id")
    copies = base.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= max(positives, negatives) + 1)
    copies = saved(copies, "candidates")
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    longest = copies.agg(F.max(square)).first()[0] or 0.0
    looked_at = copies.filter("copy = 1").orderBy(F.xxhash64("v"), "vec_id").select("v").limit(LOOKED_AT).collect()
    cells = Cells([list(p) for p in list(dict.fromkeys(tuple(r.v) for r in looked_at))[:PIVOTS]], longest)
    dealt = saved(cells.dealt(copies.drop("copy")), "dealt")
    sizes = dealt.groupBy("size", "cell").agg(F.ceil(F.count("*") / PIECE_ROWS).alias("pieces"), F.max("away").alias("radius"))
    for row in sizes.filter("cell >= 0").collect():  # one for each pivot
        cells.radius[row.cell] = row.radius
    piece = F.pmod(F.xxhash64("vec_id", "v"), "pieces")
    data = saved(dealt.join(sizes.drop("radius"), ["size", "cell"]).withColumn("piece", piece).drop("pieces", "away"), "pieces")

    long_array = lambda *c: F.array(*[F.lit(x).cast("bigint") if isinstance(x, int) else x for x in c])
    anchor = [F.col("vec_id").alias("anchor_id"), F.xxhash64("label", "v").alias("version"), "label", "v", "size"]
    anchors = saved(cells.dealt(base.filter(F.col("vec_id") % every == 0).select(*anchor)).drop("away"), "anchors")
    whole = anchors.withColumns({"low": long_array(LEAST), "high": long_array(MOST)})
    chosen = saved(best_rows(whole, data, cells, positives, True), "positives")
    chosen = chosen.select("anchor_id", "version", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))

    score = F.col("positive_score").cast("decimal(19,0)")
    window = F.struct("nth", F.ceil(score * least / 100).cast("bigint").alias("low"), F.floor(score * most / 100).cast("bigint").alias("high"))
    windows = chosen.groupBy("anchor_id", "version").agg(F.array_sort(F.collect_list(window)).alias("windows"))
    end = lambda name: F.col(f"windows.{name}")
    # An anchor has as many windows as positives; those it lacks are closed.
    padded = lambda name, value: F.slice(
        F.concat(end(name), F.array_repeat(F.lit(value).cast("bigint"), positives)), 1, positives
    )
    narrowed = anchors.join(windows, ["anchor_id", "version"]).withColumns({"low": padded("low", 1), "high": padded("high", 0)})
    found = best_rows(narrowed.drop("windows"), data, cells, negatives, False)
    found = found.select("anchor_id", "version", (F.col("window") + 1).alias("nth"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(chosen, ["anchor_id", "version", "nth"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


#: The registered query in SQL, every anchor against every row.
MINE_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, hash(a.label, a.v) AS version, a.label = e.label AS alike, e.vec_id, hash(e.v) AS other,
    CAST(list_inner_product(a.v, e.v) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id AND len(a.v) = len(e.v) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, version, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor_id, version ORDER BY score DESC, vec_id) AS nth
  FROM s WHERE alike),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.version, p.nth ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.version = p.version
  WHERE p.nth <= 5 AND NOT s.alike
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
