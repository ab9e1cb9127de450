"""Token counts by heap-and-linked-list byte-pair merging, without making token ids."""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataroll.llm.common import by_batch, text_or_empty, texts_of

SPACE = "▁"
#: Pieces of a vocabulary hold space marks only at their start, and never a line feed: nothing
#: merges across the start of a run of space marks, or across a line feed.
SEGMENT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")
#: Segments that a Python worker remembers the counts of. It bounds memory, not results.
REMEMBERED = 1_200_000


def read_vocabulary(model_path: str) -> dict[str, float]:
    """The pieces that merging can make, each with its rank (low merges first).

    Raises if a piece holds a space mark after another character or a line feed, for then
    texts could not be cut into segments.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ranks = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        ranks[model.id_to_piece(i)] = -model.get_score(i)
    if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in ranks):
        raise ValueError("Pieces of this vocabulary cross words")
    return ranks


def count_merged(segment: str, ranks: dict[str, float]) -> int:
    """Initial symbols minus merges, after all merges of one segment.

    The pair of lowest rank merges first, the leftmost of equals. A heap holds the pairs, a linked
    list the symbols. A character that is no piece starts as its UTF-8 bytes, each a symbol.
    """
    symbols: list[str | None] = list(segment)
    weight = [1 if c in ranks else len(c.encode()) for c in segment]
    total, last = sum(weight), len(symbols) - 1
    following, before = list(range(1, last + 2)), list(range(-1, last))
    heap = []
    for i in range(last):
        pair = segment[i : i + 2]
        if pair in ranks:
            heap.append((ranks[pair], i, pair))
    heapify(heap)
    while heap:
        _, i, pair = heappop(heap)
        j = following[i]
        if symbols[i] is None or j > last or symbols[i] + symbols[j] != pair:
            continue  # one side has merged since
        total -= weight[i] + weight[j] - 1
        symbols[i], symbols[j], weight[i] = pair, None, 1
        following[i] = k = following[j]
        if k <= last:
            before[k] = i
            right = pair + symbols[k]
            if right in ranks:
                heappush(heap, (ranks[right], i, right))
        if (k := before[i]) >= 0:
            left = symbols[k] + pair
            if left in ranks:
                heappush(heap, (ranks[left], k, left))
    return total


class SegmentCounts(dict):
    """Counts by segment, made when first asked for and forgotten when there are too many."""

    def __init__(self, ranks: dict[str, float]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, segment: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = count_merged(segment, self.ranks)
        if len(segment) <= 64:
            self[segment] = n
        return n


def count_text(text: str, counts: SegmentCounts) -> int:
    """Tokens of a text. It gets a space in front, as the library's default is; empty: none."""
    if not text:
        return 0
    marked = f"{SPACE}{text}".replace(" ", SPACE)
    return sum(map(counts.__getitem__, SEGMENT.findall(marked)))


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row; no shuffle.

    The vocabulary is read once on the driver and has a fixed size. Null texts count as empty ones
    (0 bytes, 0 tokens), null ids stay null, repeated rows are counted each, an empty table gives
    no rows, further columns are ignored. A text of any length is counted whole; without spaces it
    is one segment, merged in time n log n.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(model_path))
    kept: list[SegmentCounts] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not kept:
            kept.append(SegmentCounts(ranks.value))
        tokens = [count_text(t, kept[0]) for t in texts_of(batch, "text")]
        columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        text.alias("text"),
    )
    counted = by_batch(rows, step, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
