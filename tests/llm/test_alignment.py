"""Token alignment against the libraries and a plain version."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from recordloom.llm import alignment
from tests.llm.conftest import ODD, odd_rows

LETTERS = "ab  \n\t'stre,.!é漢 \u0085\x1c　ſK 12٣ß́İΣ▁<|>endoftext"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def fuzz(n):
    rng = random.Random(11)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def loaded():
    return alignment.Tokenizers.of(alignment.Definitions.read())


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path(alignment.A_DEFINITION))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.B_MODEL))


def plain_groups(text, libraries, loaded):
    """Groups of ids between ends that both token lists have, one token after the other."""
    a = libraries[0].encode(f" {text}", add_special_tokens=False).ids
    b = libraries[1].encode(text)
    whole = f" {text}".encode()
    if not text or not b"".join(loaded.a_bytes[i] for i in a) == whole == b"".join(loaded.b_bytes[i] for i in b):
        return []
    groups, left, right, i, j, a_end, b_end = [], [], [], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if j == len(b) or (i < len(a) and a_end <= b_end):
            left.append(a[i])
            a_end += len(loaded.a_bytes[a[i]])
            i += 1
        else:
            right.append(b[j])
            b_end += len(loaded.b_bytes[b[j]])
            j += 1
        if a_end == b_end:
            groups.append((left, right))
            left, right = [], []
    return groups


def plain_rows(rows, libraries, loaded):
    found = [(i, plain_groups(text or "", libraries, loaded)) for i, text in rows]
    counts = Counter((a[-1], b[-1]) for _, groups in found for a, b in groups)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for i, groups in found:
        pairs = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(groups),
            sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return sorted(out, key=repr)


def collected(frame):
    return sorted((tuple(r) for r in frame.select(COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("stride", [1, 3, 16])
def test_gallop_is_a_binary_search(stride, monkeypatch):
    monkeypatch.setattr(alignment, "STRIDE", stride)
    rng = np.random.default_rng(5)
    for size in (1, 2, 17, 400):
        values = np.unique(rng.integers(0, 3 * size, size))
        targets = np.unique(rng.integers(0, 3 * size + 5, max(1, size // 3)))
        low, high = np.zeros(len(targets), np.int64), np.full(len(targets), len(values))
        want = [bisect_left(values.tolist(), t) for t in targets.tolist()]
        assert alignment.gallop(values, targets, low, high).tolist() == want
        assert alignment.search(values, targets, low, high).tolist() == want


def test_groups_are_those_of_the_libraries(libraries, loaded):
    texts = [*fuzz(3000), *(t or "" for t in ODD), "▁", "a▁b c", "<s> </s> <|endoftext|>", "x" * 3000]
    written = alignment.align_texts(texts, loaded).written(loaded.written)
    for text, got in zip(texts, written, strict=True):
        groups = plain_groups(text, libraries, loaded)
        assert got == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def test_pieces_are_cut_where_no_token_goes_across(loaded):
    assert loaded.cuts
    for text in [*fuzz(2000), "a b  c d", " a", "a ", "a\n b", "a \nb"]:
        assert alignment.split(text) == alignment.CUT.split(text)


def test_every_letter_between_pieces(libraries, loaded):
    letters = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts = [f"x{c} {c}y {c} 1{c}1" for c in letters]
    written = alignment.align_texts(texts, loaded).written(loaded.written)
    for text, got in zip(texts, written, strict=True):
        groups = plain_groups(text, libraries, loaded)
        assert got == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups), repr(text)


def test_a_full_cache_changes_nothing(loaded, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "CACHED_IDS", 5)
    for _ in range(2):
        for text in ("some words here", "and others", "some words here"):
            got = "".join(alignment.align_texts([text], loaded).written(loaded.written))
            groups = plain_groups(text, libraries, loaded)
            assert got == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


@pytest.mark.parametrize("frequent", [0, 7, 200_000])
def test_statistics(odd, libraries, loaded, frequent, monkeypatch):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    want = plain_rows([(row[0], row[1]) for row in odd_rows()], libraries, loaded)
    assert collected(alignment.link_statistics(odd)) == want


def test_partial_counts_passed_on_early(make, libraries, loaded, monkeypatch):
    monkeypatch.setattr(alignment, "FLUSH", 3)
    rows = [(i, f"word {i % 5} and the same words again", "s") for i in range(60)]
    want = plain_rows([(i, t) for i, t, _ in rows], libraries, loaded)
    assert collected(alignment.link_statistics(make(rows))) == want


@pytest.mark.parametrize("together", [1, 30, 10_000])
def test_parts_of_a_batch(loaded, together, monkeypatch):
    monkeypatch.setattr(alignment, "TOGETHER", together)
    texts = [None, "", "some words", "more words than that here", "", "漢字 かな", "x" * 50]
    parts = list(alignment.aligned_parts(pa.RecordBatch.from_pydict({"text": texts}), loaded))
    got = [text for part in parts for text in part.written(loaded.written)]
    whole = alignment.align_texts([text or "" for text in texts], loaded)
    assert got == list(whole.written(loaded.written))
    assert np.concatenate([part.groups for part in parts]).tolist() == whole.groups.tolist()


def test_no_rows(nothing):
    assert alignment.link_statistics(nothing).collect() == []
    assert alignment.alignments(nothing).collect() == []


def test_full_lists(odd, libraries, loaded):
    for row in alignment.alignments(odd).collect():
        a_from = b_from = 0
        for a_cut, b_cut in zip(row.a_cuts, row.b_cuts, strict=True):
            a = b"".join(loaded.a_bytes[i] for i in row.a_ids[a_from : a_cut + 1])
            b = b"".join(loaded.b_bytes[i] for i in row.b_ids[b_from : b_cut + 1])
            assert a == b
            a_from, b_from = a_cut + 1, b_cut + 1
        assert (a_from, b_from) == (len(row.a_ids), len(row.b_ids))


def test_other_id_types(spark, make):
    named = make([(1, "a text", "s")]).selectExpr("'k' AS name", "text AS body", "doc_id")
    row = alignment.link_statistics(named, "name", "body").first()
    assert (row.name, row.n_links > 0) == ("k", True)
