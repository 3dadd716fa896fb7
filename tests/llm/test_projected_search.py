"""Projected nearest neighbours against all inner products."""

import math

import numpy as np
import pytest

from recordloom.llm import projected_search as ps
from recordloom.llm.texts import prepare, read

SCHEMA = "vec_id bigint, embedding array<float>, label int, row bigint, id bigint, score double, cell bigint"


@pytest.fixture
def vectors(spark):
    prepare(spark)

    def build(rows):
        full = [(i, None if v is None else [None if x is None else float(x) for x in v], *[None] * 5) for i, v in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


def brute(rows, every=20, k=20):
    """All products of every query with every other row; ties by id."""
    sound = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
             if i is not None and v and None not in v and np.isfinite(np.array(v, np.float32)).all() and any(v)]
    out = []
    for at, (q, query) in enumerate(sound):
        if q % every == 0:
            scored = sorted((-ps.exact(query[None], v[None])[0], i) for n, (i, v) in enumerate(sound) if n != at)[:k]
            out += [(q, rank, i, -score) for rank, (score, i) in enumerate(scored, 1)]
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect())


def recall(got, want):
    pairs = {(q, i) for q, _, i, _ in want}
    return len(pairs & {(q, i) for q, _, i, _ in got}) / len(pairs)


def test_quantile_is_that_of_the_distribution():
    draws = (np.random.default_rng(1).standard_normal((200_000, 12)) ** 2).sum(axis=1)
    for share in (0.5, 0.9, 0.98):
        assert abs((draws <= ps.quantile(share, 12)).mean() - share) < 0.005


def test_projected_distances_follow_the_distribution(monkeypatch):
    """Over many draws of the directions, for one query and vectors of different norms."""
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((20, 30)) * rng.uniform(0.1, 3, (20, 1))
    norms = np.sqrt(ps.exact(vectors, vectors))
    space = ps.Space(30, float(norms.max()))
    query = rng.standard_normal((1, 30))
    norm = np.sqrt(ps.exact(query, query))
    true = 2 * space.largest * (space.largest - ps.exact(vectors, query) / norm)
    ratios = []
    for seed in range(400):
        monkeypatch.setattr(ps, "SEED", seed)
        ratios.append(((space.project(vectors, norms) - space.project_queries(query, norm)) ** 2).sum(axis=1) / true)
    for share in (0.5, 0.9, 0.98):
        assert abs((np.array(ratios) <= ps.quantile(share, ps.DIRECTIONS)).mean() - share) < 0.03


@pytest.mark.parametrize("dimension", [1, 2, 7, 64])
def test_small_tables_are_exact(vectors, dimension):
    rng = np.random.default_rng(dimension)
    rows = [(i, rng.standard_normal(dimension) * rng.uniform(0.2, 5)) for i in range(300)]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in rows]
    got, want = found(ps.nearest(vectors(rows))), brute(rows)
    assert recall(got, want) >= 0.99
    assert all(math.isclose(g[3], dict(((q, r), s) for q, r, _, s in want)[g[0], g[1]], rel_tol=0.2, abs_tol=0.2) for g in got)


def test_ties_and_copies_go_to_the_smaller_id(vectors):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(0, 120, 2)] + [(i, [0.0, 1.0, 0.0]) for i in range(1, 60, 2)]
    assert found(ps.nearest(vectors(rows))) == brute(rows)


def test_odd_rows(vectors):
    sound = [(i, [math.sin(i), math.cos(i), 1 + i % 3]) for i in range(100)]
    odd = [(None, [1, 2, 3]), (20, None), (40, []), (60, [0, 0, 0]), (200, [math.nan, 1, 1]), (220, [math.inf, 1, 1]),
           (240, [1, None, 2]), (260, [1, 2]), (-20, [0.5, -0.0, 2]), (40, [0.1, 0.2, 0.3])]
    rows = [*sound, *odd]
    three = [(i, v) for i, v in rows if v is not None and len(v) == 3]
    assert found(ps.nearest(vectors(rows))) == brute(three)


def test_few_or_no_rows(vectors):
    assert found(ps.nearest(vectors([]))) == []
    assert found(ps.nearest(vectors([(20, [1.0, 1.0])]))) == []
    assert found(ps.nearest(vectors([(7, [1.0, 1.0])]))) == []
    few = [(20, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, -1.0])]
    assert found(ps.nearest(vectors(few))) == brute(few)


def test_many_blocks_and_rounds(vectors, monkeypatch):
    """Cells of few vectors, two chunks, a large group of copies; the test for the end must hold across blocks."""
    monkeypatch.setattr(ps, "BLOCK_VALUES", 1)
    monkeypatch.setattr(ps, "CHUNK", 50)
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((40, 16)) * 3
    rows = [(i, (centres[i % 40] + rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(6000)]
    rows += [(i, [1.0] * 16) for i in range(6000, 9000)]
    index = ps.Index.build(vectors(rows))
    assert len(index.low) > 4 and index.blocks.max() > 1 and index.rows.count() == 9000
    got, want = found(ps.nearest(vectors(rows))), brute(rows)
    assert len(got) == len(want)
    assert recall(got, want) >= 0.95
    assert all(q != i for q, _, i, _ in got)
    best = {(q, rank): s for q, rank, _, s in want}
    assert all(s <= best[q, rank] + 1e-9 for q, rank, _, s in got)


def test_recall_of_the_query_on_the_table(spark):
    table = read(spark, "/root/testdata/sf0.1", "embeddings")
    got = found(ps.nearest(table))
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    vectors, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        products = vectors @ vectors[q]
        products[q] = -np.inf
        mine = {i for a, _, i, _ in got if a == ids[q]}
        hits += len(mine & set(ids[np.argsort(-products)[:20]].tolist()))
        total += 20
    assert hits / total >= 0.95
