"""Byte-level BPE against the library that defines it, and a round trip."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from shelfmark.llm import bpe, queries


@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def both(request):
    ranks = bpe.read_ranks(public_tokenizers.path(request.param))
    return bpe.Vocabulary(ranks), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_as_the_library(both):
    own, library = both
    rng = random.Random(4)
    parts = ["a", "aa", "the", "é", "ß", "😀", "\n", " ", "  ", "中", "1", "23", "!", "'s", "'S", "\t", "\U00018da7", "՘", "ᲀ", "http", "://", "ab", "ba", "\x1c", "　", "ନ", "½", "_"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randrange(60)))
        assert own.encode(text).tolist() == library.encode_ordinary(text), repr(text)
        assert own.decode(own.encode(text).tolist()) == text.encode()
    for letters in ("ab", "aé", "中文字", "abcdefghijklmnopqrstuvwxyz"):
        word = "".join(rng.choices(letters, k=3000))
        assert own.encode(word).tolist() == library.encode_ordinary(word)


def test_all_letters_as_the_library(both):
    own, library = both
    for at in range(0x21, 0x30000, 64):
        text = "a".join(chr(c) for c in range(at, at + 64) if not 0xD800 <= c < 0xE000)
        assert own.encode(text).tolist() == library.encode_ordinary(text), hex(at)


def by_merges(word, ranks):
    """The definition: the pair of lowest rank merges, the leftmost first."""
    parts = [bytes([b]) for b in word]
    while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_small_vocabularies():
    """Of random merges, so that backtracking and ties are common; a merge joins what stands side by side, as in training."""
    rng = random.Random(5)
    for _ in range(40):
        ranks = {bytes([b]): b for b in range(256)}
        while len(ranks) < 256 + 25:
            tokens = list(ranks)
            a, b = (tokens[rng.choice([*range(97, 100), *range(256, len(ranks))])] for _ in range(2))
            if a + b not in ranks and by_merges(a + b, ranks) == [ranks[a], ranks[b]]:
                ranks[a + b] = len(ranks)
        own = bpe.Vocabulary(ranks)
        for _ in range(60):
            word = bytes(rng.choices(b"abc", k=rng.randrange(1, 40)))
            assert own.encode_piece(word) == by_merges(word, ranks)


def test_cuts_of_long_texts_change_nothing(both, monkeypatch):
    own, library = both
    text = "".join(random.Random(6).choices(["word", " ", "  ", "\n", "é", "'s", "12", "."], k=5000))
    monkeypatch.setattr(bpe, "STRETCH", 7)
    assert len(list(bpe.stretches(text))) > 100
    assert own.encode(text).tolist() == library.encode_ordinary(text)


def test_odd_rows(spark):
    long = "words without end " * 50_000
    rows = [(1, "plain"), (1, "plain"), (2, None), (3, ""), (None, "no id 😀"), (4, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit("mine"), "_source": F.lit("mine"), "decoded": F.lit("mine")})
    encoded = bpe.encode_texts(docs)
    assert encoded.columns == ["doc_id", "text", "_source", "decoded", "ids"]
    found = bpe.decode_ids(encoded).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in found) == sorted((d or 0, t or "") for d, t in rows)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in found)
    assert bpe.encode_texts(docs.limit(0)).count() == 0 and bpe.decode_ids(bpe.encode_texts(docs.limit(0))).count() == 0
    none = spark.createDataFrame([(None,), ([],), ([1, None],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode_ids(none).collect()] == [None, b"", None]


def test_query_as_the_library(spark, sf_dir):
    ranks = bpe.read_ranks(bpe.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = set()
    for row in pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        text = row["text"] or ""
        ids = library.encode_ordinary(text)
        want.add((row["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in queries.QUERIES["op11_bpe"](spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()} == want
