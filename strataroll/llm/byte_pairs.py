"""Byte-pair encoding by an index of pair occurrences, and decoding.

The distinct words of a batch lie behind one another in one array of symbols. An index maps the rank of
each pair to all places of the pair. The active ranks are taken in ascending order; all places of
a pair merge at once, and the places of the pairs that this makes are added to the lists of
those. Places that are no longer such a pair are left out when their list is taken.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataroll.llm.common import by_batch, text_or_empty, texts_of

#: How the byte-level vocabularies cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A character that is neither letter, number nor space.
OTHER = "\u2603"
#: Characters of words that a Python worker remembers the ids of. It bounds memory, not results.
REMEMBERED = 6_000_000
GONE, BREAK = -1, -2


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte: itself if it is printed in Latin 1, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(c): b for c, b in [*zip(plain, plain), *zip(range(256, 512), others)]}


def unlike_characters() -> frozenset[str]:
    """Characters that are letters or numbers here and neither in the tokenizers library.

    Its Unicode version is another, so each letter and number is put to it once.
    """
    from tokenizers import pre_tokenizers

    cut = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    unlike: set[str] = set()
    for name, one in (("L", "a"), ("N", "1")):
        members = regex.findall(rf"\p{{{name}}}", every)
        whole = {a for _, (a, b) in cut("\n".join(one + c for c in members)) if b - a == 2}
        unlike.update(c for i, c in enumerate(members) if 3 * i not in whole)
    return frozenset(unlike)


@dataclass
class Vocabulary:
    """What encoding and decoding need of a tokenizer file; its size is fixed by the file."""

    unlike: frozenset[str]
    specials: dict[str, int]
    tokens: list[bytes]
    byte_ids: np.ndarray
    #: By rank: the key of the pair and the id that it becomes.
    pairs: np.ndarray
    merged: np.ndarray

    @cached_property
    def by_key(self) -> tuple[np.ndarray, np.ndarray]:
        ranks = np.argsort(self.pairs)
        return self.pairs[ranks], ranks

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for pairs that don't merge."""
        keys, ranks = self.by_key
        wanted = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        known = (keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(known, ranks[at], -1)


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level BPE file of the tokenizers library, read on the driver as that library reads it.

    Raises for files that ask for more than this module does: a normaliser, another way to cut words,
    special tokens that take in white space, or pairs that come before one of the pairs they are made of.
    """
    with open(path, encoding="utf-8") as text:
        file = json.load(text)
    model, cut = file["model"], file["pre_tokenizer"]
    plain = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")]
    if any(plain) or model.get("byte_fallback") or model.get("ignore_merges") or file["normalizer"] or model["type"] != "BPE":
        raise ValueError(f"{path} is no plain byte-pair vocabulary")
    if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or file["decoder"]["type"] != "ByteLevel":
        raise ValueError(f"{path} does not cut words at byte level")
    added = file["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"{path} has special tokens that take in their surroundings")
    ids, byte_of = model["vocab"], byte_characters()
    specials = {t["content"]: t["id"] for t in added}
    tokens = [b""] * (max([*ids.values(), *specials.values()]) + 1)
    for token, i in (ids | specials).items():
        known = all(c in byte_of for c in token)
        tokens[i] = bytes(byte_of[c] for c in token) if known else token.encode()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    pairs = np.array([ids[a] << 32 | ids[b] for a, b in merges], np.int64)
    merged = np.array([ids[a + b] for a, b in merges], np.int64)
    made = np.full(len(tokens), -1)
    made[merged] = np.arange(len(merged))  # the last rank that makes a token
    if (np.maximum(made[pairs >> 32], made[pairs & 0xFFFFFFFF]) >= np.arange(len(pairs))).any():
        raise ValueError(f"{path} ranks a pair before the pairs that it is made of")
    byte_ids = np.zeros(256, np.int64)
    for c, b in byte_of.items():
        byte_ids[b] = ids[c]
    return Vocabulary(unlike_characters(), specials, tokens, byte_ids, pairs, merged)


class PairIndex:
    """All places of each active pair in an array of symbols, and the merging of them."""

    def __init__(self, symbols: np.ndarray, vocabulary: Vocabulary):
        n = len(symbols)
        self.vocabulary, self.symbols = vocabulary, symbols
        self.after, self.before = np.arange(1, n + 1), np.arange(-1, n - 1)
        self.places: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self.add(np.arange(n - 1), symbols[:-1], symbols[1:])
        heapify(self.active)

    def add(self, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Enter pairs that have a rank; ranks without a list become active."""
        rank = self.vocabulary.rank_of(left, right)
        at, rank = at[rank >= 0], rank[rank >= 0]
        if not len(at):
            return
        if len(at) > 1:
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.r_[0, cuts]].tolist(), np.split(at, cuts) if len(cuts) else [at]):
            if r in self.places:
                self.places[r].append(part)
            else:
                self.places[r] = [part]
                heappush(self.active, r)

    def merge_all(self) -> None:
        while self.active:
            rank = heappop(self.active)
            lists = self.places.pop(rank)
            self.merge(rank, np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0])

    def merge(self, rank: int, at: np.ndarray) -> None:
        symbols, after, before = self.symbols, self.after, self.before
        pair, new = int(self.vocabulary.pairs[rank]), int(self.vocabulary.merged[rank])
        left, right = pair >> 32, pair & 0xFFFFFFFF
        at = at[symbols[at] == left]
        second = after[at]
        still = symbols[second] == right
        at, second = at[still], second[still]
        if left == right and len(at) > 1:  # a run of one symbol merges two by two from its start
            place = np.arange(len(at))
            starts = np.r_[True, second[:-1] != at[1:]]
            even = (place - np.maximum.accumulate(np.where(starts, place, 0))) % 2 == 0
            at, second = at[even], second[even]
        if not len(at):
            return
        symbols[at], symbols[second] = new, GONE
        follow = after[second]
        after[at], before[follow] = follow, at
        lead = before[at]
        self.add(
            np.concatenate([at, lead]),
            np.concatenate([symbols[at], symbols[lead]]),
            np.concatenate([symbols[follow], symbols[at]]),
        )


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words behind one another, and how many each word has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1)
    symbols = np.full(int(ends[-1]) + 1 if len(words) else 1, BREAK, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[0] = False
    inside[ends] = False  # a break before the first word, and one behind each
    symbols[inside] = vocabulary.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    PairIndex(symbols, vocabulary).merge_all()
    left = symbols[symbols != GONE]
    breaks = np.flatnonzero(left == BREAK)
    return left[left != BREAK], np.diff(breaks) - 1


@dataclass
class Encoder:
    """Encodes batches of texts; remembers the ids of words up to a bound of memory."""

    vocabulary: Vocabulary
    numbers: dict[str, int] = field(default_factory=dict)
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    held: int = 0

    def __post_init__(self) -> None:
        pattern = regex.compile(WORDS)
        self.find_words, self.find_spans = pattern.findall, pattern.finditer
        self.as_other = {ord(c): OTHER for c in self.vocabulary.unlike}
        specials = sorted(self.vocabulary.specials, key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(map(regex.escape, specials))})").split if specials else None

    def words_of(self, text: str) -> list[str]:
        if text.isascii() or self.vocabulary.unlike.isdisjoint(text):
            return self.find_words(text)
        return [text[m.start() : m.end()] for m in self.find_spans(text.translate(self.as_other))]

    def words(self, text: str) -> list[str | int]:
        parts = self.cut(text) if self.cut else [text]
        if len(parts) == 1:
            return self.words_of(text)
        found: list[str | int] = []
        for i, part in enumerate(parts):
            found += [self.vocabulary.specials[part]] if i % 2 else self.words_of(part)
        return found

    def learn(self, words: dict[str | int, None]) -> None:
        """Give numbers and ids to words that have none yet."""
        new = [w for w in words if w not in self.numbers]
        plain = [w for w in new if isinstance(w, str)]
        ids, counts = encode_words([w.encode() for w in plain], self.vocabulary)
        special = [w for w in new if not isinstance(w, str)]
        self.held += sum(map(len, plain))
        self.numbers.update(zip([*plain, *special], range(len(self.numbers), len(self.numbers) + len(new))))
        ends = self.starts[-1] + np.cumsum(np.concatenate([counts, np.ones(len(special), np.int64)]))
        self.ids = np.concatenate([self.ids, ids, np.array(special, np.int64)])
        self.starts = np.concatenate([self.starts, ends])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another, and the offset of each text in them."""
        cut = [self.words(text) for text in texts]
        distinct = dict.fromkeys(w for words in cut for w in words)
        if self.held > REMEMBERED:
            self.numbers, self.ids, self.starts, self.held = {}, self.ids[:0], self.starts[:1], 0
        self.learn(distinct)
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        numbers = np.fromiter((self.numbers[w] for words in cut for w in words), np.int64, int(sizes.sum()))
        begin, counts = self.starts[numbers], np.diff(self.starts)[numbers]
        ends = np.cumsum(counts)
        flat = self.ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - counts), counts)]
        return flat, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]


#: Rows of a batch that are encoded at once.
ROWS = 512


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>`` for each row; no shuffle.

    The same ids as the tokenizers library gives without adding special tokens: strings of special tokens inside a
    text become these. Null and empty texts have no ids, null document ids stay null, repeated rows are
    encoded each, an empty table gives no rows, further columns are ignored. Texts are encoded whole;
    a word of any length, such as a run of one letter, is merged in time n log n.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept: list[Encoder] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not kept:
            kept.append(Encoder(shared.value))
        parts = []
        for at in range(0, batch.num_rows, ROWS):
            ids, offsets = kept[0].encode(list(texts_of(batch.slice(at, ROWS), "text")))
            parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.concat_arrays(parts)], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return by_batch(rows, step, "doc_id bigint, ids array<int>")


class TokenBytes:
    """The bytes of all tokens behind one another, to look up many ids at once."""

    def __init__(self, tokens: list[bytes]):
        self.counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.counts) - self.counts
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def text(self, ids: np.ndarray) -> str:
        if ids.min(initial=0) < 0:
            raise IndexError("A negative number is no id")
        counts = self.counts[ids]
        at = np.repeat(self.starts[ids] - (np.cumsum(counts) - counts), counts)
        return self.flat[at + np.arange(len(at))].tobytes().decode("utf-8", "replace")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded``: the text of each row's ``ids``, special tokens included.

    Bytes that are no UTF-8 become replacement characters, as in the library. Null ids of tokens count as none;
    a number that is no id raises an error. Other rules as in ``encode``.
    """
    tokens = encoded.sparkSession.sparkContext.broadcast(vocabulary.tokens)
    kept: list[TokenBytes] = []

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not kept:
            kept.append(TokenBytes(tokens.value))
        ids = batch.column("ids")
        texts = (kept[0].text(x.values.to_numpy()) if len(x) else "" for x in ids)
        columns = [*batch.columns[:-1], pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "decoded"])

    ids = F.filter(F.coalesce("ids", F.array().cast("array<int>")), lambda i: i.isNotNull())
    digest = F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
    rows = encoded.select("doc_id", F.size(ids).cast("bigint").alias("n_tokens"), digest.alias("ids_sha256"), ids.alias("ids"))
    return by_batch(rows, step, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded string")
