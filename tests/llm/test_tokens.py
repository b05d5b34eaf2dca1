"""Byte-level BPE and token counts against the libraries themselves."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from meritrix.llm import bpe, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None, "", " ", "\n\n  \n", "Hello world's  end", "don't DON'T we'll 's", "aaaa" * 3000, "x" * 50_000,
    "Größe 12345 ½ Ⅷ 漢字 שלום", "é ΑΣ ΣΑΣ. İstanbul Å", "<|endoftext|> a <|startoftext|><|endoftext|>b <|im_end|>",
    "tab\tsep\x1cfs\x85nel nbsp ls", "😀👩‍👩‍👧 \U0001e900\U0001f1e9", "!!!---***$$$ #%&", "Hello world's  end",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", "x", 2), (4, TEXTS[4], "again", 3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int").repartition(3)


def test_perfect_hash_is_minimal_and_recognises_strangers():
    entries = {f"key{i}".encode(): i for i in range(3000)}
    hashed = bpe.PerfectHash(entries)
    assert all(hashed.get(k) == v for k, v in entries.items())
    assert sorted(hashed.keys) == sorted(entries) and len(hashed.keys) == len(entries)
    assert all(hashed.get(f"other{i}".encode()) is None for i in range(3000))
    assert bpe.PerfectHash({b"a": 7}).get(b"a") == 7 and bpe.PerfectHash({}).get(b"a") is None


def test_merges_equal_the_library():
    ranks = bpe.load_ranks(RANKS)
    encoder = bpe.Encoder(ranks)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(5)
    for _ in range(1500):
        piece = bytes(draw.choice(b"aabcethnio \n\xc3\xa9\xff") for _ in range(draw.randint(1, 40)))
        assert encoder.encode_piece(piece) == library._encode_single_piece(piece)


def test_round_trip_equals_the_library(docs):
    ranks = bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.round_trip_digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == len(TEXTS) + 2
    for row in got:
        text = "no id" if row.doc_id is None else TEXTS[row.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_token_counts_equal_the_library(docs):
    library = Tokenizer.from_file(WORDS)
    got = token_counts.count_tokens(docs, WORDS).collect()
    assert len(got) == len(TEXTS) + 2
    for row in got:
        text = "no id" if row.doc_id is None else TEXTS[row.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 2048), text[:40]


def test_counts_of_every_character_equal_the_library():
    """Each code point between two letters: categories, case and NFC agree."""
    with open(WORDS, encoding="utf-8") as file:
        splitter = token_counts.PreTokens(file.read())
    library = Tokenizer.from_file(WORDS)
    texts = [f"a{chr(c)}b 1{chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    expected = [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]
    cache = token_counts._Cache(splitter.length)
    found = [sum(map(cache.__getitem__, splitter.of(t)[0])) for t in texts]
    assert [t for t, a, b in zip(texts, expected, found) if a != b] == []


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.round_trip_digests(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert token_counts.count_tokens(none, WORDS).count() == 0


def test_whole_documents(spark):
    """Every row of a given table, against both libraries."""
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    ranks = bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {k: library.encode_ordinary(t) for k, t in texts.items()}
    got = bpe.round_trip_digests(documents, RANKS, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in got} == {
        k: (len(v), hashlib.sha256(" ".join(map(str, v)).encode()).hexdigest()) for k, v in ids.items()}
    words = Tokenizer.from_file(WORDS)
    counted = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents, WORDS).collect()}
    assert counted == {k: len(words.encode(t, add_special_tokens=False)) for k, t in texts.items()}
