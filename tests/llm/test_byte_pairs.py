"""Byte-pair encoding and decoding against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import pytest

from strataroll.llm import byte_pairs, queries
from strataroll.llm.common import table

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
ODD = ["", None, "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "a" * 50_001, " " * 3001 + "x", "\n" * 100, "՘x1ᇞ", "-" * 777]


def random_texts(n):
    rng = random.Random(7)
    pool = [chr(c) for c in [*range(0x300), 0x558, 0x11DE0, 0x323B0, 0x4E00, 0x1F600, 0x200D, 0x2028, 0x3000]]
    pool += ["<|endoftext|>", "'s", "'ll", "  ", "\n\n", "aaaa", "Hello", "the"]
    return ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return byte_pairs.read_vocabulary(PATH)


def digests(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(decoded)


def test_odd_texts_as_the_library(spark, library, vocabulary):
    texts = [*ODD, *random_texts(3000)]
    rows = [(i if i % 50 else None, t, "en", i) for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    encoded = byte_pairs.encode(docs, vocabulary)
    got = encoded.collect()
    want = [(r[0], library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(want, key=key)
    back = [(r.doc_id, r.decoded) for r in byte_pairs.decode(encoded, vocabulary).collect()]
    texts_back = [(i, library.decode(ids, skip_special_tokens=False)) for i, ids in want]
    assert sorted(back, key=key) == sorted(texts_back, key=key)
    none = docs.filter("false")
    assert byte_pairs.decode(byte_pairs.encode(none, vocabulary), vocabulary).count() == 0


def test_ids_that_are_no_text(spark, library, vocabulary):
    rows = [(1, [200, 255, 50256, None, 3]), (2, None), (3, [])]
    encoded = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = {r.doc_id: (r.n_tokens, r.decoded) for r in byte_pairs.decode(encoded, vocabulary).collect()}
    want = library.decode([200, 255, 50256, 3], skip_special_tokens=False)
    assert got == {1: (4, want), 2: (0, ""), 3: (0, "")}


def test_query_over_the_table(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    want = sorted((r.doc_id, *digests(library, r.text)) for r in table(spark, sf_dir, "documents").collect())
    assert sorted(map(tuple, queries.op11_byte_pairs(spark, sf_dir).collect())) == want


def test_words_are_forgotten_without_loss(vocabulary, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "REMEMBERED", 20)
    encoder = byte_pairs.Encoder(vocabulary)
    for text in random_texts(50):
        ids, offsets = encoder.encode([text, "", text])
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want * 2 and offsets.tolist() == [0, len(want), len(want), 2 * len(want)]


def test_every_place_merges_once(vocabulary):
    ids, counts = byte_pairs.encode_words([b"aaaaa", b"", b"aa"], vocabulary)
    assert counts.sum() == len(ids) and counts[1] == 0
    assert b"".join(vocabulary.tokens[i] for i in ids) == b"aaaaaaa"
    none = byte_pairs.encode_words([], vocabulary)
    assert [len(x) for x in none] == [0, 0] and isinstance(none[0], np.ndarray)


@pytest.mark.parametrize("change", [{"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace", "add_prefix_space": False}}, "order"])
def test_other_vocabularies_are_refused(tmp_path, change):
    with open(PATH) as file:
        content = json.load(file)
    if change == "order":
        merges = content["model"]["merges"]
        merges[0], merges[-1] = merges[-1], merges[0]
    else:
        content |= change
    path = tmp_path / "other.json"
    path.write_text(json.dumps(content))
    with pytest.raises(ValueError):
        byte_pairs.read_vocabulary(str(path))
