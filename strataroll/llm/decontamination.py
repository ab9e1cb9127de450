"""Benchmark decontamination by the q-gram lemma and banded alignment.

Items are cut into overlapping segments. A segment of m bytes within e edits of some text shares
m - q + 1 - q e q-grams with it at least, and their diagonals (place in the text less place in the
segment) lie within e of each other. So shared q-grams are counted in bands of diagonals
that overlap by half; bands that reach the bound are aligned, and matches within e edits reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataroll.llm.common import text_or_empty, texts_of

Q, EDITS = 8, 0.08
#: The shortest passage of a longer item that is found wherever it begins: half a step is within its edits.
SEGMENT, STEP = 64, 8
#: Shorter items are found whole and exactly only, as words of their own.
LEAST_BYTES = 30
#: Bytes of items that are searched for in one pass and sent to the executors; more take more passes.
PASS_BYTES = 1 << 20
#: White space of any kind is one, as is upper and lower case.
_FOLD = bytes(32 if b in b"\t\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
HASH = np.uint64(0x9E3779B97F4A7C15)


#: Characters that take other bytes in lower case. They stay as they are, so that all places do.
_RESIZED = re.compile(
    "([" + "".join(c for c in map(chr, [*range(0xD800), *range(0xE000, 0x10000)]) if len(c.lower().encode()) != len(c.encode())) + "])"
)


def folded(text: str) -> bytes:
    """Bytes in the places of the text's own, in lower case but for characters that would take others."""
    if not text.isascii() and _RESIZED.search(text):
        parts = _RESIZED.split(text)
        parts[::2] = map(str.lower, parts[::2])
        text = "".join(parts)
    else:
        text = text.lower()
    return text.encode().translate(_FOLD)


def grams(data: bytes) -> np.ndarray:
    """The code of the q-gram at each place."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, padded = np.empty(n, np.uint64), data + bytes(Q)
    for o in range(min(Q, n)):
        out[o::Q] = np.frombuffer(padded, "<u8", (n - o + Q - 1) // Q, o)
    return out


def segments(data: bytes) -> list[tuple[int, int]]:
    """Begin and end of pieces of SEGMENT bytes, each STEP after the last; the last one ends the item."""
    last = max(0, len(data) - SEGMENT)
    return [(a, min(a + SEGMENT, len(data))) for a in [*range(0, last, STEP), last]]


class Index:
    """Segments of the items of a pass, and where their q-grams are."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, d) for i, t in items if (d := folded(t)).strip()]
        self.short = self._short()
        sizes = np.array([len(d) if len(d) >= LEAST_BYTES else 0 for _, d in self.items], np.int64)
        codes = [grams(d if size else b"") for (_, d), size in zip(self.items, sizes, strict=True)]
        lengths = np.array([len(c) for c in codes], np.int64)
        item = np.repeat(np.arange(len(codes)), lengths)
        place = np.concatenate([np.arange(n) for n in lengths]) if codes else item
        code = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(code, kind="stable")
        self.code, self.item, self.place = code[order], item[order], place[order]
        bits = min(26, max(10, int(len(code)).bit_length() + 6))
        self.shift = np.uint64(64 - bits)
        self.there = np.zeros(1 << bits, bool)
        self.there[(code * HASH) >> self.shift] = True
        within = np.minimum(sizes, SEGMENT)  # bytes of a segment of each item
        self.edits = (EDITS * within).astype(np.int64)
        self.least = within - Q + 1 - Q * self.edits
        self.fewest = int(self.least[sizes > 0].min(initial=1 << 30))
        self.widest = int((within - Q + 1 + 2 * self.edits).max(initial=0))
        self.longest = int(sizes.max(initial=0))

    def _short(self) -> list[tuple[np.uint64, np.ndarray, np.ndarray, np.ndarray]]:
        """Of the short items by the length of their beginnings, Q at most: mask, beginnings, items, and which may be."""
        out = []
        for k in range(1, Q + 1):
            mine = [n for n, (_, d) in enumerate(self.items) if len(d) < LEAST_BYTES and min(len(d), Q) == k]
            if mine:
                code = np.array([int.from_bytes(self.items[n][1][:k], "little") for n in mine], np.uint64)
                order, there = np.argsort(code, kind="stable"), np.zeros(1 << 16, bool)
                there[(code * HASH) >> np.uint64(48)] = True
                out.append((np.uint64((1 << 8 * k) - 1), code[order], np.array(mine)[order], there))
        return out

    def search_short(self, data: bytes) -> Iterator[tuple[int, int, int, int]]:
        if not self.short:
            return
        every = grams(data + bytes(Q - 1))
        for mask, codes, items, there in self.short:
            code = every & mask
            hits = np.flatnonzero(there[(code * HASH) >> np.uint64(48)])
            first = np.searchsorted(codes, code[hits], "left")
            last = np.searchsorted(codes, code[hits], "right")
            for at, a, b in zip(hits.tolist(), first.tolist(), last.tolist(), strict=True):
                for n in items[a:b].tolist():
                    if data.startswith(d := self.items[n][1], at) and apart(data, at, at + len(d)):
                        yield n, at, at + len(d), 0

    def search(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """``item, start, end, edits`` in bytes of the text, for each segment and each short item found."""
        data = folded(text)
        yield from self.search_short(data)
        code = grams(data)
        hits = np.flatnonzero(self.there[(code * HASH) >> self.shift])
        # Places with enough hits of any segment within the longest reach to either side.
        if len(hits) < self.fewest:
            return
        m = max(1, self.fewest)
        starts = np.flatnonzero(hits[m - 1 :] - hits[: len(hits) - m + 1] <= self.widest)
        if not len(starts):
            return
        ends = np.searchsorted(hits, hits[starts] + self.widest, "right")
        reach = np.bincount(starts, minlength=len(hits) + 1) - np.bincount(ends, minlength=len(hits) + 1)
        hits = hits[np.cumsum(reach)[:-1] > 0]
        first = np.searchsorted(self.code, code[hits], "left")
        n = np.searchsorted(self.code, code[hits], "right") - first
        if not n.sum():
            return
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        item, place = self.item[at], self.place[at]
        # Bands of whole items hold all that their segments share, so few are left to look at by segment.
        width = self.edits[item] + 1
        band = (np.repeat(hits, n) - place) // width + self.longest  # a band holds two steps, so any range of one width is in one
        both = np.concatenate([band, band - 1]) + (np.concatenate([item, item]) << 40)
        keys, inverse, count = np.unique(both, return_inverse=True, return_counts=True)
        enough = count >= self.least[keys >> 40]
        some = np.flatnonzero(enough[inverse])
        some = some[np.argsort(both[some], kind="stable")]
        ends = np.cumsum(count[enough])
        shared = []
        for key, low, high in zip(keys[enough].tolist(), (ends - count[enough]).tolist(), ends.tolist(), strict=True):
            i, b = key >> 40, (key & ((1 << 40) - 1)) - self.longest
            places = np.sort(place[some[low:high] % len(place)])
            for first_, last_ in segments(self.items[i][1]):
                k = int(np.searchsorted(places, last_ - Q, "right") - np.searchsorted(places, first_, "left"))
                if k >= self.least[i]:
                    shared.append((-k, i, first_, last_, b))
        exact: dict[tuple[int, int], list[int]] = {}
        done: set[tuple[int, int, int]] = set()
        rest: dict[int, list[tuple[int, int, int]]] = {}
        for _, i, first_, last_, b in sorted(shared):
            e, segment, p = int(self.edits[i]), self.items[i][1][first_:last_], (i, first_)
            low, high = b * (e + 1) + first_, (b + 2) * (e + 1) - 1 + first_
            found = find_exact(segment, data, low, high)
            if not found:
                rest.setdefault(i, []).append((first_, last_, low))
                continue
            exact.setdefault(p, []).append(found[0])
            if (*p, found[1]) not in done:
                done.add((*p, found[1]))
                yield i, *found
        for i, bands in rest.items():
            e, wide = int(self.edits[i]), 2 * int(self.edits[i]) + 1
            # A band beside a match without edits is of the same place.
            beside = lambda p, low: any(low - e <= at <= low + wide + e for at in exact.get(p, ()))  # noqa: B023, E731
            bands = [band for band in bands if not beside((i, band[0]), band[2])]
            texts = [self.items[i][1][first_:last_] for first_, last_, _ in bands]
            for (first_, _, _), found in zip(bands, align_all(texts, data, [low for *_, low in bands], wide, e), strict=True):
                if found and (i, first_, found[1]) not in done:
                    done.add((i, first_, found[1]))
                    yield i, *found


def apart(data: bytes, start: int, end: int) -> bool:
    """No word goes on beyond the start or the end."""
    word = lambda b: chr(b).isalnum() or b >= 128
    before = start > 0 and word(data[start - 1]) and word(data[start])
    return not before and not (end < len(data) and word(data[end]) and word(data[end - 1]))


def find_exact(segment: bytes, data: bytes, low: int, high: int) -> tuple[int, int, int] | None:
    at = data.find(segment, max(0, low), max(0, high) + len(segment))
    return (at, at + len(segment), 0) if at >= 0 else None


def align(segment: bytes, data: bytes, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """``start, end, edits`` of the best match whose path keeps to the diagonals low - edits to high + edits.

    Starts and ends in the text are free. None if it takes more than ``edits``.
    """
    return find_exact(segment, data, low, high) or align_all([segment], data, [low], high - low, edits)[0]


def align_all(segments_: list[bytes], data: bytes, lows: list[int], wide: int, edits: int) -> list[tuple[int, int, int] | None]:
    """As ``align``, of segments of one length at once, each from its low diagonal to ``wide`` above."""
    if not segments_:
        return []
    base, width, size = np.array(lows) - edits, wide + 2 * edits + 1, len(segments_[0])
    before, beyond = max(0, -int(base.min())), max(0, int(base.max()) - len(data))
    text = np.frombuffer(bytes(before) + data + bytes(beyond + size + width), np.uint8)
    segment = np.frombuffer(b"".join(segments_), np.uint8).reshape(-1, size)
    steps = np.arange(width)
    places = base[:, None] + before + steps
    cost, origin = np.zeros(places.shape, np.int64), np.broadcast_to(steps, places.shape)
    skip, further = np.full(places.shape, 1 << 30), np.zeros(places.shape, np.int64)
    for i in range(size):
        # Column k is the diagonal base + k: the text goes on to place base + k + i.
        new = cost + (text[places + i] != segment[:, i, None])
        skip[:, :-1] = cost[:, 1:] + 1  # a byte of the segment that the text lacks
        further[:, :-1] = origin[:, 1:]
        came = np.where(skip < new, further, origin)
        new = np.minimum(new, skip) - steps
        run = np.minimum.accumulate(new, 1)  # further bytes in the text
        source = np.maximum.accumulate(np.where(new == run, steps, 0), 1)
        cost, origin = run + steps, np.take_along_axis(came, source, 1)
    out = []
    for b, k, costs, origins in zip(base.tolist(), cost.argmin(1).tolist(), cost, origin, strict=True):
        fine = costs[k] <= edits
        out.append((max(0, b + int(origins[k])), min(len(data), b + k + size), int(costs[k])) if fine else None)
    return out


def merged(found: list[tuple[int, int, int, int]]) -> dict[int, list[tuple[int, int, int]]]:
    """By item, the spans that its segments cover, merged where they touch, with their fewest edits."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    for item, start, end, edits in sorted(found):
        spans = out.setdefault(item, [])
        if spans and start <= spans[-1][1]:
            a, b, e = spans[-1]
            spans[-1] = (a, max(b, end), min(e, edits))
        else:
            spans.append((start, end, edits))
    return out


def passes(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items with a text, in groups of about PASS_BYTES: only one group at a time is in the driver."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-size // PASS_BYTES)
    for group in range(groups):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group)
        yield [(r["item_id"], r["text"]) for r in mine.orderBy("item_id", "text").collect()]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, start, end, n_spans, edits`` for each row of ``docs`` and each item found in it.

    An item is found where one of its segments of 64 bytes (the whole item, if shorter) occurs within 8 edits
    in 100, case and kind of white space aside; a segment begins every 8 bytes, so that a passage of 64 bytes that is copied
    exactly is found wherever it lies. Items under 30 bytes are found where they occur whole and exactly and no word goes on
    beyond their ends. ``start, end`` are code points of the first span that
    its segments cover, ``edits`` the fewest of a segment. Null and empty texts and items match nothing, nor
    do items of white space. Null ids of documents stay null; repeated rows are searched each, items that share an
    id count as one, by their first span. Empty tables give no rows. Texts are searched whole. No shuffle:
    each pass sends a bounded part of the benchmark to the executors.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = "doc_id bigint, item_id bigint, start bigint, end bigint, n_spans bigint, edits bigint"
    found = None
    for items in passes(benchmark):
        one = rows.mapInArrow(_searcher(items, _spans_of), schema)
        found = one if found is None else found.union(one)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, in whose text no item is found; null texts stay."""
    for items in passes(benchmark):
        docs = docs.mapInArrow(_searcher(items, _clean), docs.schema)
    return docs


def _searcher(items: list[tuple[int, str]], of_batch):
    made: list[Index] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Index(items))
        for batch in batches:
            yield of_batch(made[0], batch)

    return run


def _spans_of(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = []
    for at, text in enumerate(texts_of(batch, "text")):
        found = list(index.search(text))
        if not found:
            continue
        data = np.frombuffer(text.encode(), np.uint8)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
        by_id: dict[int, tuple] = {}
        for item, spans in merged(found).items():
            start, end, _ = spans[0]
            edits = min(e for _, _, e in spans)
            row = (int(points[start]), int(points[end]), len(spans), edits)
            by_id[index.items[item][0]] = min(row, by_id.get(index.items[item][0], row))
        rows += [(at, item, *row) for item, row in sorted(by_id.items())]
    columns = list(zip(*rows, strict=True)) if rows else [()] * 6
    ids = batch.column("doc_id").take(pa.array(columns[0], pa.int64()))
    return pa.RecordBatch.from_arrays(
        [ids, *(pa.array(c, pa.int64()) for c in columns[1:])], ["doc_id", "item_id", "start", "end", "n_spans", "edits"]
    )


def _clean(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
    keep = [next(index.search(t or ""), None) is None for t in texts_of(batch, "text")]
    return batch.filter(pa.array(keep, pa.bool_()))
