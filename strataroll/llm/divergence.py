"""Divergence of the sources of each language, over a quadtree of the group-term count matrix.

The matrix of a language has a row for each source and a column for each kept term. Most of it is
zero, and a zero has the same share everywhere in its row. So a quadrant of two sources in which both are zero
costs their divergence at zero times its columns, without a look inside. The rest is found by descending a
tree of K x K quadrants for both sources at once, down to small leaves that are computed in full.

Spark cuts the matrix into strips of columns and tiles of rows. Each task builds the tree of one strip
for one pair of tiles, and the sums of all strips are added up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataroll.llm.common import saved, text_or_empty, texts_of

#: Bytes of terms: ASCII letters, in lower case, and all bytes of other characters. The rest become spaces.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LEAST_DOCS, SCALE, TOP_TERMS = 3, 1_000_000_000, 200
#: Counts that a task holds before it passes them on. It bounds memory, not results.
HELD_COUNTS = 500_000
#: Rows of a tile, and nonzero cells of a strip, about.
TILE_ROWS, STRIP_CELLS = 256, 32_768
#: Parts of a quadrant in each direction; side of a leaf; leaves computed at once.
K, LEAF, LEAVES = 4, 16, 128


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents, in partial sums.

    An empty term, which no text has, stands for the documents themselves, so that groups without terms occur.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = docs.select(name("lang"), name("source"), text_or_empty().alias("text"))
    schema = "lang string, source string, term string, n bigint, docs bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[tuple[str, str], Counter] = {}
        docs: dict[tuple[str, str], Counter] = {}
        for batch in batches:
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            for group, text in zip(zip(langs, sources), texts_of(batch, "text")):
                words = text.encode().translate(LETTERS).split()
                if group not in n:
                    n[group], docs[group] = Counter(), Counter()
                n[group].update(words)
                docs[group].update(set(words))
                docs[group][b""] += 1
            if sum(map(len, docs.values())) > HELD_COUNTS:
                yield from flush(n, docs)
                n, docs = {}, {}
        yield from flush(n, docs)

    def flush(n: dict, docs: dict) -> Iterator[pa.RecordBatch]:
        for group, found in docs.items():
            terms = list(found)
            columns = [[group[0]] * len(terms), [group[1]] * len(terms), [t.decode() for t in terms]]
            columns += [[n[group][t] for t in terms], list(found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "source", "term", "n", "docs"])

    return rows.mapInArrow(count, schema)


def share(n: Column, total: Column) -> Column:
    """1 + floor(SCALE (n + 1) / total), exact; 1 where there are no terms at all."""
    scaled = (n.cast("bigint") + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.call_function("div", scaled, F.nullif(total, F.lit(0)).cast("decimal(20,0)"))
    return 1 + F.coalesce(whole, F.lit(0).cast("bigint"))


class Quadtree:
    """The nonzero cells of rows and columns, as the nonzero quadrants of each level, largest first."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int]):
        side = -(-max(shape) // LEAF)  # it spans rows without cells too: they meet rows with some
        depth = 0
        while K**depth < side:
            depth += 1
        self.levels = []
        for level in range(depth, -1, -1):
            size = LEAF * K**level
            self.levels.append(np.unique((rows // size) << 32 | columns // size))

    def holds(self, level: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        codes, wanted = self.levels[level], rows << 32 | columns
        at = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
        return codes[at] == wanted

    def joint_leaves(self, pairs: np.ndarray) -> Iterator[np.ndarray]:
        """``(row, other row, column)`` of leaves that hold a cell in one of both rows.

        ``pairs`` says of each two rows of leaves whether any of their rows are compared. Quadrants
        that are zero in both are left where they are met.
        """
        steps = np.stack(np.meshgrid(*[np.arange(K)] * 3, indexing="ij"), -1).reshape(-1, 3)
        stack = [(0, np.zeros((1, 3), np.int64))] if len(self.levels[0]) else []
        while stack:
            level, nodes = stack.pop()
            a, b, c = nodes.T
            nodes = nodes[self.holds(level, a, c) | self.holds(level, b, c)]
            if level == len(self.levels) - 1:
                inside = (nodes[:, :2] < len(pairs)).all(1)
                nodes = nodes[inside]
                nodes = nodes[pairs[nodes[:, 0], nodes[:, 1]]]
                yield from np.split(nodes, range(LEAVES, len(nodes), LEAVES)) if len(nodes) else []
                continue
            width = K ** (len(self.levels) - 1 - level)  # leaves along a side of a quadrant
            nodes = nodes[(nodes[:, :2] * width < len(pairs)).all(1)]
            for at in range(0, len(nodes), 4096):  # depth first, so that few nodes wait
                stack.append((level + 1, (nodes[at : at + 4096, None, :] * K + steps).reshape(-1, 3)))


def divergences(
    row: np.ndarray, column: np.ndarray, p: np.ndarray, zero: np.ndarray, compare: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each two rows: the sum of floor((p - q)^2 / q) over columns with a cell in one of both, and how many these are.

    Cells are ``row, column, p``; ``zero`` is the share of each row's zeros; ``compare`` says which rows meet.
    """
    n = len(zero)
    blocks = -(-n // LEAF)
    total, columns = (np.zeros((blocks * LEAF, blocks * LEAF), np.int64) for _ in range(2))
    if not len(row):
        return total[:n, :n], columns[:n, :n]
    # Dense rows and columns first, so that zeros lie together.
    by_row, by_column = (np.argsort(-np.bincount(x, minlength=m), kind="stable") for x, m in ((row, n), (column, 0)))
    row_at, column_at = np.empty(n, np.int64), np.empty(len(by_column), np.int64)
    row_at[by_row], column_at[by_column] = np.arange(n), np.arange(len(by_column))
    row, column = row_at[row], column_at[column]
    zeros = np.ones(blocks * LEAF, np.int64)
    zeros[:n] = zero[by_row]
    meet = np.zeros((blocks * LEAF, blocks * LEAF), bool)
    meet[:n, :n] = compare[np.ix_(by_row, by_row)]
    tree = Quadtree(row, column, (n, len(by_column)))
    # Cells sorted by leaf, so that the cells of a leaf are a slice.
    leaf = (row // LEAF) << 32 | column // LEAF
    order = np.argsort(leaf, kind="stable")
    row, column, p, leaf = row[order], column[order], p[order], leaf[order]

    def dense(a: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = a << 32 | c
        low, high = np.searchsorted(leaf, codes), np.searchsorted(leaf, codes, "right")
        sizes = high - low
        cell = np.arange(sizes.sum()) + np.repeat(low - (np.cumsum(sizes) - sizes), sizes)
        at = np.repeat(np.arange(len(a)), sizes), row[cell] % LEAF, column[cell] % LEAF
        values = np.repeat(zeros.reshape(-1, LEAF)[a][:, :, None], LEAF, 2)
        there = np.zeros(values.shape, bool)
        values[at], there[at] = p[cell], True
        return values, there

    for nodes in tree.joint_leaves(meet.reshape(blocks, LEAF, blocks, LEAF).any((1, 3))):
        a, b, c = nodes.T
        (p_a, in_a), (q_b, in_b) = dense(a, c), dense(b, c)
        q = q_b[:, None, :, :]
        f = (p_a[:, :, None, :] - q) ** 2 // q
        either = in_a[:, :, None, :] | in_b[:, None, :, :]
        at = (a[:, None, None] * LEAF + np.arange(LEAF)[:, None], b[:, None, None] * LEAF + np.arange(LEAF))
        np.add.at(total, at, np.where(either, f, 0).sum(3))
        np.add.at(columns, at, either.sum(3))
    back = np.ix_(row_at, row_at)
    return total[back], columns[back]


def pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, source, item, value``: of each two sources of a language, over all kept terms.

    ``cells`` has ``lang, source, term, p``; ``groups`` has ``lang, source, terms, cells, sources, zero``. Beside the sums,
    tasks return for how many columns a pair was looked at; all others are zero in both and are
    priced at once.
    """
    tiles, strips = (F.ceil(F.col(c) / n).cast("int") for c, n in (("sources", TILE_ROWS), ("cells", STRIP_CELLS)))
    groups = groups.withColumns({"tiles": tiles, "strips": F.greatest(strips, F.lit(1))})
    tiled = groups.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
    placed = cells.join(tiled.select("lang", "source", "tile", "tiles", "strips"), ["lang", "source"])
    placed = placed.withColumn("strip", F.pmod(F.xxhash64("term"), F.col("strips")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("strips") - 1))
    # A source itself goes to every strip: its share where it is zero, under no term.
    owners = tiled.select("lang", "source", "tile", "tiles", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"), every.alias("strip"))
    rows = owners.unionByName(placed.drop("strips")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")})
    rows = rows.select("lang", "low", "high", "strip", "source", "tile", "term", "p")

    def sums(key: tuple, table: pa.Table) -> pa.Table:
        terms = table.column("term").combine_chunks()
        owner = np.asarray(terms.is_null())
        sources = table.column("source").combine_chunks()
        names = sources.filter(pa.array(owner))
        cell = pa.array(~owner)
        row = pc.index_in(sources.filter(cell), names).to_numpy(zero_copy_only=False).astype(np.int64)
        column = terms.filter(cell).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        p, tile = (table.column(c).to_numpy() for c in ("p", "tile"))
        low, high = key[1].as_py(), key[2].as_py()
        compare = np.ones((len(names), len(names)), bool) if low == high else tile[owner][:, None] != tile[owner][None, :]
        np.fill_diagonal(compare, False)
        total, seen = divergences(row, column, p[~owner], p[owner], compare)
        a, b = np.nonzero(compare)
        out = [pa.array([key[0].as_py()] * len(a), pa.string()), names.take(pa.array(a)), names.take(pa.array(b))]
        out += [pa.array(total[a, b]), pa.array(seen[a, b])]
        return pa.table(out, names=["lang", "source", "item", "value", "seen"])

    schema = "lang string, source string, item string, value bigint, seen bigint"
    found = rows.groupBy("lang", "low", "high", "strip").applyInArrow(sums, schema)
    found = found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    here = groups.select("lang", "source", "terms", F.col("zero").alias("p"))
    there = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("q"))
    priced = found.join(here, ["lang", "source"]).join(there, ["lang", "item"])
    unseen = (F.col("terms") - F.col("seen")) * F.expr("((p - q) * (p - q)) div q")
    return priced.select("lang", "source", "item", (F.col("value") + unseen).alias("value"))


def audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank`` for ``docs`` (``lang, source, text``).

    Terms are runs of letters and non-ASCII characters, ASCII in lower case; a language keeps those in LEAST_DOCS of
    its documents. Part ``pair``: how far the source is from each other one of the language; part
    ``term``: the TOP_TERMS kept terms that the source has more of than the language. Shares are whole
    numbers of parts in 10^9, and all sums are exact.

    Null text, lang and source are empty ones; rows alike are documents of their own. A language without kept
    terms has pairs of value 0 and no terms; one with a single source has no pairs. Ties go
    by item in UTF-8. Further columns are ignored; an empty table gives no rows. Texts are read whole.
    """
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term").orderBy("source")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns = {"lang_n": F.sum("n").over(whole), "lang_docs": F.sum("docs").over(whole), "nth": F.row_number().over(same)}
    is_term = F.col("term") != ""
    kept = counts.withColumns(columns).filter(~is_term | (F.col("lang_docs") >= LEAST_DOCS))
    matrix = saved(kept.select("lang", "source", "term", "n", "lang_n", (is_term & (F.col("nth") == 1)).alias("first")), "matrix")
    sizes = matrix.groupBy("lang", "source").agg(
        F.sum("n").alias("total"), F.count_if(is_term).alias("cells"), F.count_if("first").alias("terms")
    )
    whole_lang = sizes.groupBy("lang").agg(
        F.sum("total").alias("lang_total"), F.sum("cells").alias("cells"), F.sum("terms").alias("terms"), F.count("*").alias("sources")
    )
    zero = share(F.lit(0), F.col("total") + F.col("terms"))
    groups = saved(sizes.select("lang", "source", "total").join(whole_lang, "lang").withColumn("zero", zero), "groups")
    shares = {
        "p": share(F.col("n"), F.col("total") + F.col("terms")),
        "q": share(F.col("lang_n"), F.col("lang_total") + F.col("terms")),
    }
    sized = groups.select("lang", "source", "total", "lang_total", "terms")
    cells = matrix.filter(is_term).join(sized, ["lang", "source"]).withColumns(shares)
    value = F.expr("((p - q) * (p - q)) div q")
    terms = cells.filter("p > q").select("lang", "source", F.col("term").alias("item"), value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    top = ranked(terms).filter(F.col("rank") <= TOP_TERMS)
    pairs = ranked(pair_sums(cells.select("lang", "source", "term", "p"), groups))
    parts = [rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, rows in (("pair", pairs), ("term", top))]
    return parts[0].unionByName(parts[1])


#: The same rows in SQL, without a tree.
AUDIT_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
t AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY t.lang, t.source, t.term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS terms FROM kept GROUP BY lang),
size AS (
  SELECT g.lang, g.source, CAST(coalesce(sum(c.n), 0) AS BIGINT) AS total
  FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (s.total + v.terms) AS p
  FROM size s JOIN kept k ON s.lang = k.lang JOIN v ON s.lang = v.lang
  LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
q AS (
  SELECT k.lang, k.term, 1 + (1000000000 * (k.n + 1)) // (z.total + v.terms) AS q
  FROM (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY lang, term) k
  JOIN (SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY lang) z ON k.lang = z.lang
  JOIN v ON k.lang = v.lang),
sums AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT p.lang, p.source, p.term AS item, (p.p - q.q) * (p.p - q.q) // q.q AS value
  FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term' AS part, item, value,
      row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms) WHERE rank <= 200)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""
