"""The Merkle manifest against a plain tree in memory."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from recordloom.llm import merkle
from tests.llm.conftest import odd_rows


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def small(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def plain_way(levels, rank):
    for level in levels[:-1]:
        run = rank // 16 * 16
        yield level[run:rank], level[rank + 1 : run + 16]
        rank //= 16


def plain_proofs(rows):
    """Rows of ``id, text, source`` (no lang, no length) to the columns of the query."""
    by = defaultdict(list)
    for i, text, source in rows:
        made = [sha(*map(written, (i, source, None, None, t))) for t in (text, small(text))]
        tampered = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        by[source].append((i is not None, i or 0, made[0], made[tampered], i))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_levels([leaf for _, _, leaf, _, _ in sorted(by[s])]) for s in sources}
    top = plain_levels([trees[s][-1][0] for s in sources])
    out = []
    for place, source in enumerate(sources):
        for rank, (*_, own, given, i) in enumerate(sorted(by[source])):
            way = [*plain_way(trees[source], rank), *plain_way(top, place)]
            proof = sha(*(d for left, right in way for d in (*left, *right)))
            folded = given
            for left, right in way:
                folded = sha(*left, folded, *right)
            root = top[-1][0]
            out.append((i, own, trees[source][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def proven(docs, **how):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in merkle.audit(docs, **how).select(names).collect()), key=repr)


def test_positions_are_the_order_of_completion():
    for n in [*range(1, 40), 255, 256, 257, 300, 4096, 4097, 5000]:
        order, waiting = [], defaultdict(list)

        def complete(level, index):
            order.append((level, index))
            if level == merkle.height(n):
                return
            waiting[level].append(index)
            if len(waiting[level]) == 16 or ((index + 1) << (4 * level)) >= n:
                waiting[level].clear()
                complete(level + 1, index >> 4)

        for i in range(n):
            complete(0, i)
        assert [merkle.position(level, index, n) for level, index in order] == list(range(len(order)))


@pytest.mark.parametrize(
    "rows",
    [
        odd_rows(),
        [(7, "Only one", None)],
        [(i, f"Text {i}", "one") for i in range(17)],
        [(i, f"Text {i}", f"s{i % 40:03d}") for i in range(500)],  # more groups than one run
        [(i % 90, f"T{i % 3}", "big" if i % 3 else None) for i in range(700)],  # repeated rows and ids
        [(i, None, "ä" if i % 2 else "z") for i in range(300)],
    ],
)
def test_proofs(make, rows):
    assert proven(make(rows)) == plain_proofs(rows)


def test_more_tiers(make):
    """Builders of one level, so that a few hundred rows take three tiers."""
    rows = [(i, f"Text {i}", "big" if i < 700 else f"s{i % 30}") for i in range(1000)]
    assert proven(make(rows), tier=1) == plain_proofs(rows)


def test_several_builders(make):
    rows = [(i, f"T{i}", "big" if i < 9000 else f"s{i % 5}") for i in range(9100)]
    assert proven(make(rows)) == plain_proofs(rows)


@pytest.mark.parametrize("tier", [1, 3])
def test_log_is_dense_and_complete(make, tier):
    rows = [(i, f"Text {i}", "big" if i % 4 else None) for i in range(1200)]
    found = merkle.Manifest(make(rows), tier=tier).log().orderBy("source", "position").collect()
    for source in (None, "big"):
        own = [r for r in found if r.source == source]
        assert [r.position for r in own] == list(range(len(own)))
        leaves = [sha(*map(written, (i, s, None, None, t))) for i, t, s in rows if s == source]
        levels = plain_levels(leaves)
        assert {(r.level, r.idx): r.digest for r in own} == {
            (level, i): d for level, digests in enumerate(levels) for i, d in enumerate(digests)
        }


def test_no_rows(nothing):
    assert merkle.audit(nothing).collect() == []
    assert merkle.Manifest(nothing).root().collect() == []


def test_root_changes_with_any_column(make):
    def root(rows, **other):
        return merkle.Manifest(make(rows).withColumns(other)).root().first().digest

    rows = [(i, f"text {i}", "s") for i in range(40)]
    first = root(rows)
    assert first == root(list(reversed(rows)))
    assert first != root(rows[:-1])
    assert first != root([*rows[:-1], (39, "text 39.", "s")])
    assert first != root(rows, lang=F.lit("en"))
    assert first != root(rows, n_chars=F.lit(1).cast("bigint"))
