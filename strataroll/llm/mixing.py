"""Mixing sources to target weights: packed blocks, multinomial draws, pseudorandom permutations.

1. Each source's words are one stream, cut into blocks of a fixed length.
2. Output shards draw how many blocks they take of each source: multinomial in what is left of the
   targets, so that the shards together meet them.
3. The slots of a source map through a pseudorandom permutation of its block indexes, one
   permutation for each pass over the source, and meet the blocks in a join by index.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strataroll.llm.common import WORD, saved, text_or_empty

BLOCK_WORDS = 128
SHARD_BLOCKS = 1 << 16
#: Documents a piece of a source has about; pieces are numbered side by side.
PIECE_DOCS = 4096
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
#: Blocks of the mix that a task makes about.
TASK_BLOCKS = 250_000
SEED = 11


def word_targets(
    sizes: Mapping[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> dict[str | None, float]:
    """Words to take of each source.

    Sources by code point, null last, have the weights in turn and split ``share`` of all words by
    them; what exceeds ``most`` times a source's own words is split among the others, until none
    exceeds.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full: dict[str | None, float] = {}
    while rest := [s for s in order if s not in full]:
        left = share * sum(sizes.values()) - sum(full.values())
        unit = left / sum(weight[s] for s in rest)
        above = [s for s in rest if unit * weight[s] > most * sizes[s]]
        if not above:
            return {s: full.get(s, unit * weight[s]) for s in order}
        full |= {s: most * sizes[s] for s in above}
    return full


def draw_counts(wanted: np.ndarray, shard_blocks: int, seed: int) -> np.ndarray:
    """Blocks of each source in each shard: multinomial draws from what is still wanted.

    A draw above what is left of a source is cut, and the shard draws the difference again, so the
    columns sum to ``wanted``.
    """
    random = np.random.default_rng(seed)
    left, shards = wanted.astype(np.int64).copy(), []
    while left.sum():
        shard, open_ = np.zeros_like(left), min(shard_blocks, int(left.sum()))
        while open_:
            drawn = np.minimum(random.multinomial(open_, left / left.sum()), left)
            shard, left, open_ = shard + drawn, left - drawn, open_ - int(drawn.sum())
        shards.append(shard)
    return np.array(shards).reshape(len(shards), len(wanted))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of ``index`` in the pseudorandom permutation of 0 to n - 1 that ``key`` names.

    A Feistel network permutes the least square power of two that holds n; walking on from results
    outside stays a permutation.
    """
    half = (np.maximum(np.ceil(np.log2(np.maximum(n, 2))), 2).astype(np.uint64) + np.uint64(1)) >> np.uint64(1)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, n, key = index.astype(np.uint64), n.astype(np.uint64), key.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for round_ in range(4):
            x = (right + k * np.uint64(0x9E3779B97F4A7C15) + np.uint64(round_ + 1)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(32))) & m)
        out[todo] = (left << h) | right
        todo &= out >= n
    return out.astype(np.int64)


def numbered(docs: DataFrame, id_col: str, with_text: bool = False) -> DataFrame:
    """``row, mark, doc_id, source, size`` of each row, and its text if asked for, written once.

    The write fixes the row numbers. They only tell rows apart that are alike in id and text, which ``mark`` stands
    for, so places in the mix don't depend on how the table is cut.
    """
    words = F.regexp_count(text_or_empty(), F.lit(WORD)).cast("bigint")
    columns = [
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(text_or_empty()).alias("mark"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words.alias("size"),
    ]
    return saved(docs.select(*columns, *([text_or_empty().alias("text")] if with_text else [])), "mix")


def plan_mix(totals: list, seed: int = SEED) -> tuple[list[tuple], np.ndarray]:
    """From a row a source (``source, docs, size``): its numbers for the joins, and the draws."""
    order = sorted(totals, key=lambda r: (r["source"] is None, r["source"] or ""))
    targets = word_targets({r["source"]: r["size"] for r in order})
    rows = []
    for i, r in enumerate(order):
        blocks, target = -(-r["size"] // BLOCK_WORDS), targets[r["source"]]
        wanted = round(target * blocks / r["size"]) if r["size"] else 0
        pieces = 1 + r["docs"] // PIECE_DOCS
        rows.append((i, r["source"], r["size"], float(target), blocks, wanted, pieces))
    return rows, draw_counts(np.array([r[5] for r in rows], np.int64), SHARD_BLOCKS, seed)


def small_table(spark, rows: list[tuple], names: list[str], types: list[pa.DataType]) -> DataFrame:
    """Rows made on the driver, as a relation of known size: Spark decides by it what to broadcast."""
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return spark.createDataFrame(pa.table(dict(zip(names, arrays, strict=True))))


def mix_blocks(spark, rows: list[tuple], draws: np.ndarray, seed: int = SEED) -> DataFrame:
    """The mix as ``shard, slot, source_no, block``: each slot of each shard names a block.

    Slots are numbered by source within a shard; the table has a row for each block of the mix and
    is made on the executors from the counts of shards.
    """
    before = np.cumsum(draws, axis=0) - draws
    counts = [
        (s, i, int(draws[s, i]), int(before[s, i]), int(draws[s, :i].sum()), rows[i][4])
        for s in range(len(draws))
        for i in range(len(rows))
        if draws[s, i]
    ]
    names = ["shard", "source_no", "n", "first", "first_slot", "blocks"]
    spans = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(4096).cast("bigint")))
    # Explode in two steps, with a shuffle between, so that large counts spread over the tasks.
    runs = small_table(spark, counts, names, [pa.int32(), pa.int32(), *[pa.int64()] * 4]).select("*", spans.alias("run"))
    tasks = 1 + int(draws.sum()) // TASK_BLOCKS
    runs = runs.repartition(tasks, "shard", "source_no", "run")
    last = F.least(F.col("run") + 4095, F.col("n") - 1)
    slots = runs.select("*", F.explode(F.sequence("run", last)).alias("k")).select(
        "shard",
        (F.col("first_slot") + F.col("k")).alias("slot"),
        "source_no",
        "blocks",
        (F.col("first") + F.col("k")).alias("draw"),
    )

    @F.pandas_udf(T.LongType())
    def block_of(draw: pd.Series, blocks: pd.Series, source_no: pd.Series) -> pd.Series:
        n, d = blocks.to_numpy(), draw.to_numpy()
        key = (seed * 1_000_003 + source_no.to_numpy()) * 1_000_003 + d // n
        return pd.Series(permuted(d % n, n, key))

    return slots.select("shard", "slot", "source_no", block_of("draw", "blocks", "source_no").alias("block"))


def pack(base: DataFrame, sources: DataFrame) -> DataFrame:
    """``row, source_no, block, skip, at, words``: the words of each document in each block.

    They come after ``skip`` words of the document and ``at`` words of the block. A source's
    documents are numbered through in pieces, each by id within it; only totals of pieces are added
    up in order. So no source, however large, passes through one task.
    """
    placed = base.join(sources, base["source"].eqNullSafe(sources["source"])).select(
        "row", "mark", "doc_id", "size", "source_no", F.pmod(F.xxhash64("doc_id", "mark"), F.col("pieces")).alias("piece")
    )
    order = Window.partitionBy("source_no", "piece").orderBy("doc_id", "mark", "row")
    local = placed.filter("size > 0").select("*", (F.sum("size").over(order) - F.col("size")).alias("in_piece"))
    totals = placed.groupBy("source_no", "piece").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source_no").orderBy("piece")) - F.col("words")
    starts = totals.select("source_no", "piece", before.alias("start"))
    ranges = local.join(starts, ["source_no", "piece"]).select(
        "row", "source_no", "size", (F.col("start") + F.col("in_piece")).alias("a")
    )
    first, last = F.expr(f"a div {BLOCK_WORDS}"), F.expr(f"(a + size - 1) div {BLOCK_WORDS}")
    parts = ranges.select("*", F.explode(F.sequence(first, last)).alias("block"))
    opens = F.col("block") * BLOCK_WORDS
    begin, end = F.greatest("a", opens), F.least(F.col("a") + F.col("size"), opens + BLOCK_WORDS)
    return parts.select(
        "row", "source_no", "block", (begin - F.col("a")).alias("skip"), (begin - opens).alias("at"),
        (end - begin).alias("words"),
    )


def _prepared(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sources with their numbers, and the blocks of the mix."""
    spark = base.sparkSession
    totals = base.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("size"))
    rows, draws = plan_mix(totals.collect())
    names = ["source_no", "source", "source_size", "target", "blocks", "wanted", "pieces"]
    types = [pa.int32(), pa.string(), pa.int64(), pa.float64(), *[pa.int64()] * 3]
    # Written, as Spark can't foresee how many rows the counts stand for, and would broadcast them.
    return small_table(spark, rows, names, types), saved(mix_blocks(spark, rows, draws), "mix-blocks")


def mix_documents(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for each row of ``docs``.

    ``taken`` counts the words of the document in the blocks of the mix, repeats counted. Blocks
    are taken at most twice, so no document exceeds twice its size. Null and empty texts have size
    0 and are taken 0 times. A null source is a source of its own, the last. Repeated rows take
    part each; null ids stay null and come first in their piece. An empty table gives no rows.
    Further columns are ignored. A row a source reaches the driver, as the weights are by source.
    """
    base = numbered(docs, id_col)
    sources, blocks = _prepared(base)
    times = blocks.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    taken = (
        pack(base, sources)
        .join(times, ["source_no", "block"])
        .groupBy("row")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    of_source = base.join(sources, base["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    return of_source.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken")
    )


def mixed_texts(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix itself: ``shard, slot, source, text``, a row for each block taken.

    Words of a block are joined by one space. Rules as in ``mix_documents``.
    """
    base = numbered(docs, id_col, with_text=True)
    sources, blocks = _prepared(base)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    parts = pack(base.drop("text"), sources).join(base.select("row", "text"), "row")
    cut = F.array_join(F.slice(words, (F.col("skip") + 1).cast("int"), F.col("words").cast("int")), " ")
    texts = (
        parts.groupBy("source_no", "block")
        .agg(F.sort_array(F.collect_list(F.struct("at", cut.alias("cut")))).alias("cuts"))
        .select("source_no", "block", F.array_join("cuts.cut", " ").alias("text"))
    )
    named = sources.select("source_no", "source")
    return blocks.join(texts, ["source_no", "block"]).join(named, "source_no").select("shard", "slot", "source", "text")
