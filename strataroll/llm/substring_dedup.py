"""Substring deduplication: windows of words that occurred before are removed.

1. Rabin-Karp hashes of every window of 20 words. Repeats within a chunk of documents are settled
   where they are read; only the first of equal windows goes on, so a passage that many documents
   share leaves each chunk once.
2. Windows meet by the smallest hash of six words within them, which equal windows share. Consecutive
   windows with the same smallest hash travel as one row with 40 bits of each window's hash.
   Where such a hash is too common (a short common line in many contexts), windows travel by their own
   hash instead.
3. Sorted by key, all but the first of equal windows are reported as runs.
4. The runs of a document are verified against its hashes and merged into maximal intervals, and
   their words are removed.

Equal means equal in hashes: in 64 bits of the least six-word hash and 40 of the window's own, which alone tell windows
under one such hash apart; in 64 bits of the window's hash where it is the key. Words are not compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from strataroll.llm.common import saved, text_or_empty

WINDOW, GRAM = 20, 6
#: Words handled at once by a task.
CHUNK_WORDS = 1 << 20
#: A key with more than this part of all rows is too common; at most as many keys can be.
COMMON = 1 / 20_000
COMMON_ROWS = 1000
TAG = 5
BASE = np.uint64(0x9E3779B97F4A7C15)
U64 = np.uint64


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def power(n: int) -> np.uint64:
    return U64(pow(int(BASE), n, 1 << 64))


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and how many each text has."""
    split = pc.ascii_split_whitespace(texts)
    flat = split.flatten()
    there = pc.greater(pc.binary_length(flat), 0)
    ends = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    offsets = split.offsets.to_numpy()
    return flat.filter(there), np.diff(ends[offsets])


def word_hashes(words: pa.Array) -> np.ndarray:
    coded = words.dictionary_encode()
    each = np.fromiter(map(xxh64_intdigest, coded.dictionary.to_pylist()), U64, len(coded.dictionary))
    return each[coded.indices.to_numpy()] if len(words) else np.zeros(0, U64)


def rolled(w: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hashes of all runs of n words: sums of w B^(n-1-j), built by doubling."""
    if len(w) < n:
        return np.zeros(0, U64)
    out, have, part, size = None, 0, w, 1
    while True:
        if n & size:
            # The bits of n so far make a run of `have` words; `part` hashes runs of `size` words.
            out = part if out is None else part[: len(out) - size] * power(have) + out[size:]
            have += size
        if have == n:
            return out
        part = part[:-size] * power(size) + part[size:]
        size *= 2


def smallest(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n neighbours."""
    part, size = h, 1
    while size * 2 <= n:
        part, size = np.minimum(part[:-size], part[size:]), size * 2
    rest = n - size
    return np.minimum(part[: len(part) - rest], part[rest:]) if rest else part


@dataclass
class Windows:
    """The windows of a chunk: hash, key, place in their document, and the document's number."""

    hash: np.ndarray
    key: np.ndarray
    start: np.ndarray
    doc: np.ndarray


def windows_of(words: pa.Array, counts: np.ndarray) -> Windows:
    w = word_hashes(words)
    doc = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(w)) - np.repeat(np.cumsum(counts) - counts, counts)
    whole = np.flatnonzero(start + WINDOW <= counts[doc]) if len(w) else np.zeros(0, np.int64)
    if not len(whole):
        return Windows(np.zeros(0, U64), np.zeros(0, U64), whole, whole)
    h = mixed(rolled(w, WINDOW))
    key = smallest(mixed(rolled(w, GRAM) ^ U64(GRAM)), WINDOW - GRAM + 1)
    return Windows(h[whole], key[whole], start[whole], doc[whole])


def run_starts(*same: np.ndarray) -> np.ndarray:
    """Where a run begins, given what its members share and places that go up by one."""
    begins = np.ones(len(same[0]), bool)
    begins[1:] = False
    for column in same:
        begins[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(begins)


def tag_of(h: np.ndarray) -> np.ndarray:
    return h & U64((1 << (8 * TAG)) - 1)


def as_tags(tags: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary value of TAG bytes a window for each run."""
    data = tags.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TAG].tobytes()
    offsets = np.append(starts, len(tags)) * TAG
    return pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    )


def from_tags(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All tags in a row, and how many each value has."""
    lengths = pc.binary_length(values).to_numpy(zero_copy_only=False) // TAG
    data = np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(-1, TAG)
    padded = np.zeros((len(data), 8), np.uint8)
    padded[:, :TAG] = data
    return padded.view("<u8").ravel(), lengths


RUNS = "key bigint, doc_id bigint, lo int, n int, tags binary"


def runs(w: Windows, ids: pa.Array, pick: np.ndarray, settled: bool, common: np.ndarray) -> pa.RecordBatch:
    """Rows of consecutive picked windows. ``settled``: to be removed, with the xor of their tags."""
    h, key, start, doc = w.hash[pick], w.key[pick], w.start[pick], w.doc[pick]
    if settled:
        at = run_starts(doc, start - np.arange(len(start)))
    else:
        if len(common) and len(key):
            place = np.minimum(np.searchsorted(common, key), len(common) - 1)
            key = np.where(common[place] == key, h, key)
        at = run_starts(doc, start - np.arange(len(start)), key)
    if not len(at):
        return pa.RecordBatch.from_pylist([], schema=SCHEMA)
    tags = tag_of(h)
    n = np.diff(np.append(at, len(pick))) if settled else np.zeros(len(at))
    if settled:
        tags = np.bitwise_xor.reduceat(tags, at)
    columns = [
        pa.array(key[at].astype(np.int64)), ids.take(pa.array(doc[at])),
        pa.array(start[at].astype(np.int32)), pa.array(n.astype(np.int32)),
        as_tags(tags, np.arange(len(at)) if settled else at),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


SCHEMA = pa.schema(
    [("key", pa.int64()), ("doc_id", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("tags", pa.binary())]
)


def first_here(w: Windows, ids: np.ndarray) -> np.ndarray:
    """Whether no equal window of the chunk comes before, by id (null last) and start."""
    order = np.argsort(w.hash, kind="stable")  # documents are in the order of their ids
    h = w.hash[order]
    at = run_starts(h)
    first = np.repeat(order[at], np.diff(np.append(at, len(h))))
    same = (ids[w.doc[order]] == ids[w.doc[first]]) & (w.start[order] == w.start[first])
    out = np.empty(len(h), bool)
    out[order] = same
    return out


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut or gathered to about CHUNK_WORDS words, documents whole."""
    held, size = [], 0
    for batch in batches:
        bytes_ = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(bytes_):
            size += int(n)
            if size >= 6 * CHUNK_WORDS:
                held.append(batch.slice(at, i + 1 - at))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, at = [], 0, i + 1
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Windows, pa.Array, np.ndarray]]:
    """Windows, ids and what is first, for each chunk."""
    for chunk in chunks(batches):
        chunk = chunk.take(pc.sort_indices(chunk.column("doc_id")))  # null last
        ids = chunk.column("doc_id")
        w = windows_of(*words_of(chunk.column("text")))
        rank = np.cumsum(np.r_[0, np.diff(ids.fill_null(0).to_numpy()) != 0] | np.r_[0, np.diff(ids.is_null().to_numpy(zero_copy_only=False).astype(int)) != 0])
        yield w, ids, first_here(w, rank)


def common_keys(rows: DataFrame) -> np.ndarray:
    """Keys that more than the part COMMON of all rows have, sorted; at most 1 / COMMON.

    A key that common overall has half that part in the rows of chunks where it has half that part;
    only from those it is reported, and counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, _, first in hashed(batches):
            key = w.key[np.flatnonzero(first)]
            at = run_starts(key)
            keys, n = np.unique(key[at], return_counts=True)
            often = n > max(4, len(at) * COMMON / 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *keys[often].astype(np.int64)], pa.int64()), pa.array([len(at), *n[often]], pa.int64())],
                ["key", "n"],
            )

    counted = rows.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    counted = saved(counted, "window-keys")
    total = counted.filter("key IS NULL").select("n").first()
    least = max(COMMON_ROWS, (total["n"] if total else 0) * COMMON / 2)
    found = counted.filter(F.col("key").isNotNull() & (F.col("n") > least)).select("key").collect()
    return np.sort(np.array([r["key"] for r in found], np.int64).astype(U64))


def later_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: runs of windows that are not the first of their kind, settled."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        start = int(np.searchsorted(key, key[-1]))
        if start == 0 and held and held[-1].column("key")[-1].as_py() == key[0]:
            held.append(batch)
            continue
        yield from _later([*held, batch.slice(0, start)])
        held = [batch.slice(start)]
    yield from _later(held)


def _later(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    done = pc.greater(table.column("n"), 0)
    yield from table.filter(done).to_batches()
    table = table.filter(pc.invert(done))
    key = table.column("key").to_numpy()
    same = np.r_[key[1:] == key[:-1], False] if len(key) else np.zeros(0, bool)
    some = np.flatnonzero(same | np.r_[False, same[:-1]]) if len(key) else same
    if not len(some):
        return
    table = table.take(pa.array(some)).combine_chunks()
    tags, n = from_tags(table.column("tags").combine_chunks())
    row = np.repeat(np.arange(len(some)), n)
    within = np.arange(len(tags)) - np.repeat(np.cumsum(n) - n, n)
    start = table.column("lo").to_numpy()[row] + within
    ids = table.column("doc_id")
    doc, null = ids.fill_null(0).to_numpy()[row], ids.is_null().to_numpy()[row]
    key = table.column("key").to_numpy()[row]
    order = np.lexsort((start, doc, null, tags, key))
    at = run_starts(key[order], tags[order])
    first = np.repeat(order[at], np.diff(np.append(at, len(order))))
    later = np.zeros(len(order), bool)
    later[order] = (doc[order] != doc[first]) | (null[order] != null[first]) | (start[order] != start[first])
    pick = np.flatnonzero(later)
    if not len(pick):
        return
    at = run_starts(row[pick], within[pick] - np.arange(len(pick)))
    xor = np.bitwise_xor.reduceat(tags[pick], at)
    columns = [
        pa.array(key[pick[at]]), ids.combine_chunks().take(pa.array(row[pick[at]])),
        pa.array(start[pick[at]].astype(np.int32)), pa.array(np.diff(np.append(at, len(pick))).astype(np.int32)),
        as_tags(xor, np.arange(len(at))),
    ]
    yield pa.RecordBatch.from_arrays(columns, schema=SCHEMA)


def remove(batch: pa.RecordBatch) -> Iterator[tuple[int, int, str]]:
    """Words, words removed, and the text that is left, for each row with its ``runs``."""
    for text, runs_ in zip(batch.column("text"), batch.column("runs"), strict=True):
        words = text.as_py().encode().split()
        found = runs_.as_py() or []
        gone = np.zeros(len(words) + 1, np.int64)
        if found:
            flat, counts = words_of(pa.array([text.as_py()]))
            tags = tag_of(windows_of(flat, counts).hash)
            xors = np.r_[U64(0), np.bitwise_xor.accumulate(tags)] if len(tags) else np.zeros(1, U64)
            for r in found:
                lo, n = r["lo"], r["n"]
                # Rows that share an id share their runs; each takes those of its own windows.
                if lo + n <= len(tags) and int(xors[lo + n] ^ xors[lo]) == int.from_bytes(r["tags"], "little"):
                    gone[lo] += 1
                    gone[lo + n - 1 + WINDOW] -= 1
        removed = np.cumsum(gone)[:-1] > 0
        kept = [w for w, r in zip(words, removed, strict=True) if not r] if found else words
        yield len(words), len(words) - len(kept), b" ".join(kept).decode()


def remove_repeats(docs: DataFrame, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for each row of ``docs``; with ``digest``,
    ``kept_sha256`` of the text in its place.

    Words of any window of 20 words whose words also start earlier, by id or in the same document,
    are removed; kept words are joined by one space. Windows are judged on the input. Null and
    empty texts have no words. Null ids come last and count as one id. Rows with the same id are one
    document in places: of equal windows at the same start both stay, later starts go. Texts
    under 20 words stay whole. An empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    common = common_keys(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, ids, first in hashed(batches):
            yield runs(w, ids, np.flatnonzero(first), False, common)
            yield runs(w, ids, np.flatnonzero(~first), True, common)

    keyed = rows.mapInArrow(cut, RUNS).repartition("key").sortWithinPartitions("key")
    later = keyed.mapInArrow(later_windows, RUNS)
    of_doc = later.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "n", "tags")).alias("runs"))
    of_doc = saved(of_doc, "repeats")
    joined = rows.join(of_doc, rows["doc_id"].eqNullSafe(of_doc["doc_id"]), "left")
    last = "kept_sha256" if digest else "kept_text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, texts = zip(*remove(batch), strict=True) if batch.num_rows else ((), (), ())
            if digest:
                texts = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], ["doc_id", "n_words", "n_removed", last])

    schema = f"doc_id bigint, n_words bigint, n_removed bigint, {last} string"
    return joined.select(rows["doc_id"], "text", "runs").mapInArrow(run, schema)
