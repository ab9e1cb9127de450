"""SimHash near duplicates: pivot distance tables discard pairs, the rest are verified.

Distances of unrelated fingerprints all lie about half their bits apart, so distances to
pivots alone cannot say which pairs to look at without looking at all of them. Pairs are proposed
where fingerprints agree in enough bands of bits, which loses none: with b bands, fingerprints that
differ in r bits agree in b - r bands at least. Within such blocks a table holds the distances of
each fingerprint to the pivots. By the triangle inequality two fingerprints are as far apart
as any of their coordinates differ, so pairs with a larger maximum difference are discarded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from strataroll.llm.common import by_batch, saved, text_or_empty, texts_of
from strataroll.llm.components import components

BITS, PIVOTS = 64, 32
#: Blocks with more rows are compared piece against piece, in as many tasks as there are pairs of pieces.
BLOCK_ROWS = 2048
_PIVOTS = np.random.default_rng(3).integers(0, 2**64, PIVOTS, dtype=np.uint64)
#: Shingles hashed at once, so that long texts need no more memory.
CHUNK = 1 << 16


def shingle_hashes(words: list[bytes], n: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of all n-word shingles, repeats included; fewer words are one shingle."""
    if 0 < len(words) < n:
        yield np.array([xxh64_intdigest(b" ".join(words), seed)], np.uint64)
        return
    for at in range(0, len(words) - n + 1, CHUNK):
        part = words[at : at + CHUNK + n - 1]
        shingles = part if n == 1 else map(b" ".join, zip(*(part[i:] for i in range(n))))
        yield np.fromiter((xxh64_intdigest(s, seed) for s in shingles), np.uint64)


def fingerprint(words: list[bytes], n: int, seed: int) -> np.uint64:
    """Bits set in more than half of the hashes; zero without words."""
    count, total = np.zeros(BITS, np.int64), 0
    for h in shingle_hashes(words, n, seed):
        count += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            0, dtype=np.int64
        )
        total += len(h)
    return np.packbits(count * 2 > total, bitorder="little").view("<u8")[0]


def by_words(docs: DataFrame, of_words: Callable[[list[bytes]], tuple], fields: str, *keep: Column, text_col: str = "text") -> DataFrame:
    """The kept columns and the ``fields`` that a function gives for the words of each text."""
    rows = docs.select(*keep, text_or_empty(text_col).alias("text"))
    names = [f.strip().split(" ")[0] for f in fields.split(",")]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [of_words(text.encode().lower().split()) for text in texts_of(batch, "text")]
        kinds = [pa.list_(pa.int64()) if "array" in f else pa.int64() for f in fields.split(",")]
        columns = [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *names])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return by_batch(rows, step, f"{kept}{fields}")


def fingerprints(docs: DataFrame, n: int, seed: int, *keep: Column) -> DataFrame:
    """The kept columns and ``fp bigint``."""
    return by_words(docs, lambda words: (int(fingerprint(words, n, seed).astype(np.int64)),), "fp bigint", *keep)


def band_masks(radius: int) -> list[int]:
    """Masks of the bits of all choices of bands that must agree somewhere within the radius.

    Twice as many bands as bits may differ, so a mask holds half the bits and blocks stay small.
    """
    bands = 2 * radius
    cuts = [BITS * i // bands for i in range(bands + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, bands - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


class Forest:
    """Links among rows 0 to n - 1: the smallest row of each connected set, and the pairs that connected it."""

    def __init__(self, label: np.ndarray):
        self.label = label
        self.links = [(label[:0], label[:0])]

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            if not (apart := x != y).any():
                return
            a, b, high, low = a[apart], b[apart], np.maximum(x, y)[apart], np.minimum(x, y)[apart]
            np.minimum.at(self.label, high, low)
            won = np.flatnonzero(self.label[high] == low)
            won = won[np.unique(high[won], return_index=True)[1]]
            self.links.append((a[won], b[won]))
            while (self.label != (up := self.label[self.label])).any():
                self.label = up


def close_rows(key: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int, forest: Forest | None = None) -> np.ndarray:
    """The smallest linked row of each row, for rows sorted by block.

    Rows of the same side (1 or 2, 0: none) are left to another pair of pieces.
    """
    n, forest = len(key), forest or Forest(np.arange(len(key)))
    table = np.bitwise_count(fp[:, None] ^ _PIVOTS[None, :]).astype(np.int16)
    alive = np.arange(n)
    for shift in range(1, n):
        alive = alive[alive + shift < n]
        alive = alive[key[alive] == key[alive + shift]]
        if not len(alive):
            break
        a = alive[(side[alive] == 0) | (side[alive] != side[alive + shift])]
        a = a[forest.label[a] != forest.label[a + shift]]
        for coordinates in (slice(0, 4), slice(4, PIVOTS)):  # most pairs go with the first few
            a = a[np.abs(table[a, coordinates] - table[a + shift, coordinates]).max(1, initial=0) <= radius]
        a = a[np.bitwise_count(fp[a] ^ fp[a + shift]) <= radius]
        if len(a):
            forest.link(a, a + shift)
    return forest.label


def by_masks(nodes: DataFrame, radius: int) -> DataFrame:
    """``node, fp, key`` for each choice of bands of the fingerprint of ``nodes`` (``node bigint, fp bigint``)."""
    keys = [
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint"))) for i, m in enumerate(band_masks(radius))
    ]
    return nodes.select("node", "fp", F.explode(F.array(*keys)).alias("key"))


def near_links(keyed: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` that connect what the near pairs connect.

    ``keyed`` has ``node, fp, key``, all bigint. Pairs that share a key are near if the fingerprints differ in
    ``radius`` bits at most. A block gives fewer links than it has rows.
    """
    large = keyed.groupBy("key").count().filter(F.col("count") > BLOCK_ROWS)
    pieces = F.coalesce(F.ceil(F.col("count") / (BLOCK_ROWS // 2)), F.lit(1)).cast("int")
    cut = keyed.join(saved(large, "large-blocks"), "key", "left").withColumn("pieces", pieces)
    cut = cut.withColumn("mine", F.pmod(F.xxhash64("node", "key"), F.col("pieces")).cast("int"))
    other = F.sequence(F.lit(0), F.col("pieces") - 1)
    paired = cut.select("node", "fp", "key", "mine", "pieces", F.explode(other).alias("other")).select(
        "node",
        "fp",
        F.when(F.col("pieces") == 1, F.col("key"))
        .otherwise(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")))
        .alias("key"),
        # Within a piece all rows meet; of two pieces only rows of different ones do.
        F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            start = int(np.searchsorted(key, key[-1]))  # the last block may go on in the next batch
            if start == 0 and held and held[-1].column("key")[-1].as_py() == key[0]:
                held.append(batch)
                continue
            yield from linked([*held, batch.slice(0, start)])
            held = [batch.slice(start)]
        yield from linked(held)

    def linked(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts) if parts else None
        if not rows or rows.num_rows < 2:
            return
        rows = rows.combine_chunks()
        node, key = (rows.column(c).to_numpy() for c in ("node", "key"))
        same = np.r_[key[1:] == key[:-1], False]
        some = np.flatnonzero(same | np.r_[False, same[:-1]])  # rows that are not alone in their block
        if not len(some):
            return
        forest = Forest(np.arange(len(some)))
        fp = rows.column("fp").to_numpy()[some].astype(np.uint64)
        close_rows(key[some], rows.column("side").to_numpy()[some], fp, radius, forest)
        links = [pa.array(node[some][np.concatenate(end)]) for end in zip(*forest.links)]
        yield pa.RecordBatch.from_arrays(links, ["a", "b"])

    grouped = paired.repartition("key").sortWithinPartitions("key")
    return grouped.mapInArrow(run, "a bigint, b bigint")


def labelled(nodes: DataFrame, radius: int) -> DataFrame:
    """``nodes`` (``fp bigint`` and more, one row for each) with the ``label`` of what links within ``radius`` connect."""
    links = near_links(by_masks(nodes.select(F.col("fp").alias("node"), "fp"), radius), radius)
    labels = components(links).select(F.col("node").alias("fp"), "label")
    return nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def simhash_components(docs: DataFrame, n: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    Fingerprints within ``radius`` bits are linked; the component is named by its smallest id. Null
    and empty texts have the fingerprint zero and link like others. Equal fingerprints are one
    node, so copies of a text make one, however many. Null ids stay null and name no component
    unless there is no other id in it. Repeated rows are kept each. Long texts are hashed whole, piece
    by piece. Further columns are ignored. Empty tables give no rows.
    """
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    prints = saved(fingerprints(docs, n, seed, doc_id), "fingerprints")
    nodes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    grouped = labelled(nodes, radius)
    names = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    found = saved(grouped.join(names, "label").select("fp", "component_id"), "named")
    return prints.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, n: int = 3, seed: int = 42, radius: int = 3) -> DataFrame:
    """``docs`` with one document of each component that ``simhash_components`` would name.

    The smallest id of each stays (null last, then the first row). Null and empty texts are alike.
    ``docs`` must be a stored table or another plan that gives its rows in the same places each
    time, as it is read twice. All columns stay.
    """
    row = F.monotonically_increasing_id().alias("row")
    doc_id = F.col("doc_id").cast("bigint").alias("doc_id")
    prints = saved(fingerprints(docs, n, seed, doc_id, row), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    nodes = saved(prints.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    firsts = labelled(nodes, radius).groupBy("label").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    dropped = saved(prints.select("row").join(firsts, "row", "left_anti"), "dropped")
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("all"), row)
    return rows.join(dropped, "row", "left_anti").select("all.*")
