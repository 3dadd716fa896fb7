"""The similarity join, the pipeline and the registered queries."""

import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from recordloom.llm import byte_bpe, ngram_join, quality_ranker, texts
from recordloom.llm.components import components
from recordloom.llm.queries import QUERIES, SQL
from tests.compare import check, connect
from tests.llm.conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


def gram_set(text, n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def plain_join(rows, n=4, percent=85):
    """Every pair, by definition."""
    sets = [gram_set(t, n) for _, t, _ in rows]
    lead = list(range(len(rows)))

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lead[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    lowest = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), lowest[find(i)]) for i in range(len(rows))), key=repr)


def near_rows(seed, copies=60, edits=4):
    """Chains and stars of near copies, common passages and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(5))
    passage = [word() for _ in range(30)]
    rows = []
    for _ in range(4):
        base = [word() for _ in range(rng.randint(8, 150))]
        for _ in range(copies // 4):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = word()
            rows.append(" ".join(text))
            base = text if rng.random() < 0.3 else base
    rows += [" ".join(passage + [word() for _ in range(rng.randint(0, 60))]) for _ in range(20)]
    rows += [rows[rng.randrange(len(rows))].upper() for _ in range(10)]
    rows += ["one two", "One  two", "one two three four", "one two three four five"]
    return [(i, t, "s") for i, t in enumerate(rows)]


def joined(found):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)


@pytest.mark.parametrize(("seed", "n", "percent"), [(1, 4, 85), (2, 4, 85), (3, 5, 80), (4, 2, 60)])
def test_join_is_the_definition(make, seed, n, percent):
    rows = near_rows(seed)
    assert joined(ngram_join.similar_groups(make(rows), n, percent)) == plain_join(rows, n, percent)


def test_join_over_small_blocks_and_parts(make, monkeypatch):
    monkeypatch.setattr(ngram_join, "PART_ENTRIES", 300)
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", 500)
    rows = near_rows(5)
    docs = make(rows).repartition(7)
    found = ngram_join.sets(docs, 4, "doc_id", "text")
    parts = -(-found.where("key is not null").groupBy("key").agg(F.max("n_shingles").alias("n")).agg(F.sum("n")).first()[0] // 300)
    assert parts > 10
    assert joined(ngram_join.similar_groups(docs)) == plain_join(rows)


def test_join_of_odd_rows(make, nothing):
    assert joined(ngram_join.similar_groups(make(odd_rows()))) == plain_join(odd_rows())
    assert joined(ngram_join.similar_groups(nothing)) == []


def plain_links(rows, n=4, percent=85):
    """All links between different sets with their overlaps, and to how many other rows every row links."""
    sets = [gram_set(t, n) for _, t, _ in rows]
    similar = lambda a, b: a and b and 100 * len(a & b) >= percent * len(a | b)
    different = sorted({s for s in sets if s}, key=sorted)
    links = {(a, b): len(a & b) for i, b in enumerate(different) for a in different[:i] if similar(a, b)}
    counts = [sum(1 for j, b in enumerate(sets) if j != i and similar(a, b)) for i, a in enumerate(sets)]
    return {frozenset(pair): overlap for pair, overlap in links.items()}, counts


@pytest.mark.parametrize(("seed", "n", "percent", "cell"), [(1, 4, 85, None), (4, 2, 60, (400, 3))])
def test_every_link_is_there(make, monkeypatch, seed, n, percent, cell):
    if cell:
        monkeypatch.setattr(ngram_join, "CELL_ENTRIES", cell[0])
        monkeypatch.setattr(ngram_join, "CELL_CLASSES", cell[1])
    rows = near_rows(seed)
    words = [f"w{i}" for i in range(200)]
    star = [" ".join([*words[: 12 * i], f"x{i}", *words[12 * i + 1 :]]) for i in range(12)]
    rows += [(len(rows) + i, text, "s") for i, text in enumerate(star)]  # each pair of these links
    want, counts = plain_links(rows, n, percent)
    members, links = ngram_join.similar_links(make(rows), n, percent)
    set_of = {bytes(r.key): gram_set(rows[r.doc_id][1], n) for r in members.collect() if r.key}
    found = links.collect()
    assert len(found) == len(want) >= 66
    assert all(r.a < r.b for r in found)
    assert {frozenset((set_of[bytes(r.a)], set_of[bytes(r.b)])): r.overlap for r in found} == want
    got = ngram_join.link_counts(make(rows), n, percent)
    assert sorted((r.doc_id, r.n_links) for r in got.collect()) == list(enumerate(counts))


def test_links_of_odd_rows(make, nothing):
    counts = plain_links(odd_rows())[1]
    want = sorted(((r[0], c) for r, c in zip(odd_rows(), counts, strict=True)), key=repr)
    got = ngram_join.link_counts(make(odd_rows()))
    assert sorted(((r.doc_id, r.n_links) for r in got.collect()), key=repr) == want
    members, links = ngram_join.similar_links(nothing)
    assert members.collect() == links.collect() == ngram_join.link_counts(nothing).collect() == []


def test_links_of_the_query(spark):
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = {r.doc_id: r.n_links for r in QUERIES["op4_ngram_join"](spark, SF_DIR).collect()}
    assert got == {r[0]: c for r, c in zip(rows, plain_links(rows)[1], strict=True)}


@pytest.mark.parametrize("parts", [1, 40])
def test_long_texts_at_the_threshold(parts):
    common = [f"c{i}" for i in range(289_003)]
    tails = [f"x{i}" for i in range(25_000)], [f"y{i}" for i in range(26_000)]
    found = [ngram_join.shingles(" ".join(common + tail).encode(), 4) for tail in tails]
    rows = []
    for one in found:  # a block each, so that n-grams meet where parts are counted
        rows += list(ngram_join.block_rows({ngram_join.set_key(one): one}, parts))
    counted = []
    for part in range(parts):
        here = pa.Table.from_pylist([row for row in rows if row["part"] == part], ngram_join.ROW)
        counted += ngram_join.count_part(here).to_pylist()
    grams, unshared = [], []
    for block in sorted({row["block"] for row in rows}):
        own = pa.Table.from_pylist([row for row in counted if row["block"] == block], ngram_join.ROW)
        alive = ngram_join.gather_block(own, 85).to_pylist()
        grams += [row["grams"] for row in alive]
        unshared += [row["unshared"] for row in alive]
    assert sorted(unshared) == [25_000, 26_000]
    overlap = len(set(grams[0]) & set(grams[1]))
    assert overlap == 289_000 and 100 * overlap == 85 * (sum(map(len, found)) - overlap)


def test_overlaps_in_small_steps(monkeypatch):
    monkeypatch.setattr(ngram_join, "EXPANDED", 3)
    rng = random.Random(8)
    x, y = ([sorted(rng.sample(range(30), rng.randint(0, 12))) for _ in range(n)] for n in (9, 7))
    got = ngram_join.overlaps(*(pa.array(s, pa.list_(pa.int64())) for s in (x, y)))
    assert got.tolist() == [[len(set(a) & set(b)) for b in y] for a in x]


def test_keep_one(make):
    rows = near_rows(6)
    docs = make(rows)
    kept = ngram_join.keep_one(docs, ngram_join.similar_groups(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in plain_join(rows)})


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 200), (300, 299)]
    random.Random(1).shuffle(chain)
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 300: 299, 299: 299}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_hub_components(spark):
    star = [(0, i) for i in range(1, 300)] + [(i, i + 1000) for i in range(300)]
    got = components(spark.createDataFrame(star, "a bigint, b bigint"))
    assert {r.root for r in got.collect()} == {0}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_is_its_sql(spark, duck, name):
    assert check(QUERIES[name](spark, SF_DIR), duck, SQL[name]) > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op12_nearest_vectors"}))
def test_query_has_a_row_for_every_document(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert sorted(r.doc_id for r in QUERIES[name](spark, SF_DIR).collect()) == sorted(r.doc_id for r in docs.collect())


def test_join_query(spark):
    rows = [(r.doc_id, r.text, None) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert joined(QUERIES["op4_ngram_join"](spark, SF_DIR)) == plain_join(rows)


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = texts.read(spark, SF_DIR, "documents")
    tables = [docs]
    for name, function in corpus_pipeline.STAGES:
        tables.append(texts.stage(function(spark, tables[-1], SF_DIR), name))
        if name != "encode":
            assert tables[-1].columns == docs.columns
    rows = [[r.asDict() for r in t.collect()] for t in tables]
    ids = [[r["doc_id"] for r in t] for t in rows]
    ranker = quality_ranker.fit(docs, texts.read(spark, SF_DIR, "labels"))
    x = quality_ranker.matrix([(r["text"] or "").encode() for r in rows[0]])
    assert sorted(ids[1]) == sorted(i for i, s in zip(ids[0], ranker.score(x), strict=True) if s >= 0.3)
    longest = {}
    for r in rows[1]:
        bare = re.sub(r"[\x20\x09-\x0D]", "", r["text"])
        longest[bare] = min(longest.get(bare, (1, 0)), (-len(r["text"]), r["doc_id"]))
    assert sorted(ids[2]) == sorted(i for _, i in longest.values())
    near = plain_join([(r["doc_id"], r["text"], None) for r in rows[2]], corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
    assert sorted(ids[3]) == sorted(i for i, _, c in near if i == c)
    assert set(ids[4]) <= set(ids[3]) and max(map(ids[4].count, ids[4])) <= 3
    assert sorted(ids[5]) == sorted(ids[4])
    codec, text_of = byte_bpe.Tokenizer().codec(), {r["doc_id"]: r["text"] for r in rows[4]}
    for r in rows[5]:
        assert r["round_trip"] and r["n_tokens"] == len(r["ids"])
        assert codec.decode(r["ids"]) == text_of[r["doc_id"]].encode("utf-8")


def test_pipeline_stages_on_odd_rows(spark, make, nothing):
    """NULL and repeated ids, NULL and equal texts: every stage keeps what is no copy, and nothing is taken four times."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = odd_rows()
    for docs, expected in ((make(rows).select(*columns), rows), (nothing.select(*columns), [])):
        for name, function in corpus_pipeline.STAGES:
            before, docs = docs, texts.stage(function(spark, docs, SF_DIR), name)
            if name in ("quality", "exact_dedup", "near_dedup"):
                assert docs.count() <= before.count()
                assert docs.exceptAll(before).isEmpty()
            elif name == "mix":
                taken = docs.groupBy(*columns).count().withColumnRenamed("count", "taken")
                had = before.groupBy(*columns).count().withColumnRenamed("count", "had")
                both = taken.join(had, [taken[c].eqNullSafe(had[c]) for c in columns])
                assert both.count() == taken.count()
                assert both.where("taken > 3 * had").isEmpty()
        assert (docs.count() > 0) == bool(expected)


def near_copies(n, words=40):
    """Texts that are linked with each other by five-word n-grams at 0.8."""
    return [" ".join([*(f"word{i}" for i in range(words)), f"end{i}"]) for i in range(n)]


@pytest.mark.parametrize("ids", [[1, 2, 3], [None, None, None], [7, 7, 7], [5, None, 5], [None, 9, 2], [4, 4, 1]])
def test_one_near_copy_stays_whatever_the_ids(make, ids):
    rows = [(i, text, "s") for i, text in zip(ids, near_copies(3), strict=True)]
    other = " ".join(f"other{i}" for i in range(30))
    rows += [(ids[0], other, "s"), (None, "", "s"), (None, None, "s"), (ids[0], "  ", "s")]
    docs = make(rows)
    kept = ngram_join.keep_one(docs, ngram_join.similar_groups(docs, 5, 80))
    texts_ = [r.text for r in kept.collect()]
    assert kept.columns == docs.columns
    assert sorted(t or "" for t in texts_ if not (t or "").startswith("word")) == ["", "", "  ", other]
    near = [r for r in kept.collect() if (r.text or "").startswith("word")]
    assert len(near) == 1
    known = [i for i in ids if i is not None]
    assert near[0].doc_id == (min(known) if known else None)


def test_equal_rows_of_one_id_stay_once(make):
    docs = make([(1, near_copies(1)[0], "s")] * 5 + [(2, near_copies(2)[1], "s")] * 2)
    assert ngram_join.keep_one(docs, ngram_join.similar_groups(docs, 5, 80)).count() == 1
