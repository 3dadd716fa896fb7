"""Token counts and byte-level BPE against the libraries."""

import base64
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer as Library

from recordloom.llm import byte_bpe, token_counts
from tests.llm.conftest import ODD, odd_rows

LETTERS = "ab  \n\t'stre,.!é漢 \u0085\x1c　ſK 12٣ß́İΣ<|>endoftext"


def fuzz(n):
    rng = random.Random(7)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path(byte_bpe.RANKS)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return byte_bpe.Tokenizer()


def test_perfect_hash(tokenizer):
    table = tokenizer.table
    assert sorted(table.slots) == list(range(table.size))  # minimal: every slot has one key
    assert all(table.find(key) == i for i, key in enumerate(table.keys))
    assert table.find(b"no such token anywhere") == -1
    assert byte_bpe.PerfectHash([]).find(b"a") == -1


def test_encoding_is_the_librarys(tokenizer, reference):
    codec = tokenizer.codec()
    for text in [*fuzz(5000), "a" * 5000, "ab" * 3000, " " * 999, *filter(None, ODD)]:
        ids = np.frombuffer(codec.encode(text), np.int32).tolist()
        assert ids == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode("utf-8")


def test_full_caches_change_nothing(tokenizer, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED", 3)
    codec = byte_bpe.Codec(tokenizer.table, tokenizer.ranks, tokenizer.pattern)
    for text in fuzz(500):
        assert np.frombuffer(codec.encode(text), np.int32).tolist() == reference.encode_ordinary(text)


def test_bpe_tables(odd, nothing, tokenizer, reference):
    got = byte_bpe.round_trip(odd, tokenizer).collect()
    key = lambda row: (row[0] is None, row[0], row[1])
    want = [(i, reference.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in odd_rows()]
    assert sorted([(r.doc_id, r.ids, bytes(r.decoded)) for r in got], key=key) == sorted(want, key=key)
    assert byte_bpe.round_trip(nothing, tokenizer).collect() == []
    encoded = byte_bpe.encode(odd, tokenizer)
    back = byte_bpe.decode(encoded, tokenizer).collect()
    assert sorted(bytes(r.decoded) for r in back) == sorted(w[2] for w in want)
    assert all(r.round_trip for r in byte_bpe.checked(odd, tokenizer).collect())


def test_counts_are_the_librarys(odd, nothing):
    library = Library.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    count = lambda text: len(library.encode(text or "", add_special_tokens=False).ids)
    got = token_counts.token_counts(odd).collect()
    want = [(i, len((t or "").encode()), count(t)) for i, t, _ in odd_rows()]
    key = lambda row: (row[0] is None, *row)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert token_counts.token_counts(nothing).collect() == []


@pytest.mark.parametrize("pieces", [[], [b"a", "é漢".encode(), b"<|endoftext|>", b"12"]])
def test_counting_odd_letters(monkeypatch, pieces):
    definition = open(public_tokenizers.path(token_counts.VOCABULARY), encoding="utf-8").read()
    library = Library.from_str(definition)
    monkeypatch.setattr(token_counts, "CACHED", 50)
    counter = token_counts.Counter(definition, token_counts.Table.of(pieces, definition))
    for text in [*fuzz(3000), "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>"]:
        assert counter.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)


def test_table_is_counted_from_the_texts(spark, make):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pieces = token_counts.frequent_pieces(docs, "doc_id", "text")
    counts = Counter(piece for r in docs.collect() for piece in (r.text or "").encode().split() if len(piece) <= 64)
    want = sorted(counts, key=lambda piece: (-counts[piece], piece))[: token_counts.FREQUENT]
    assert pieces == want
    assert any(not piece.isascii() for piece in pieces[:1000])
    definition = open(public_tokenizers.path(token_counts.VOCABULARY), encoding="utf-8").read()
    table = token_counts.Table.of(pieces[:5000], definition)
    library = Library.from_str(definition)
    for piece, n in table.lookup().items():
        assert n == len(library.encode(piece.decode(), add_special_tokens=False).ids)
    assert max(table.lookup().values()) > 1
    share = sum(counts[piece] for piece in pieces[:20_000]) / sum(counts.values())
    assert share > 0.6  # the table resolves most words, of all scripts


def test_a_small_sample_changes_no_count(odd, monkeypatch):
    whole = sorted(map(tuple, token_counts.token_counts(odd).collect()), key=repr)
    monkeypatch.setattr(token_counts, "SAMPLE_DOCS", 2)
    monkeypatch.setattr(token_counts, "FREQUENT", 1)
    assert sorted(map(tuple, token_counts.token_counts(odd).collect()), key=repr) == whole
