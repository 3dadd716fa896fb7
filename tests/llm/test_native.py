"""Mixing, exact duplicates and sharding against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from recordloom.llm import exact_dedup, mixing, sharding
from recordloom.llm.queries import readable
from recordloom.llm.texts import word_count
from tests.llm.conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = re.compile(r"[\x20\x09-\x0D]")


def plain_targets(sizes: dict, weights=(5, 2, 1), most=3):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    left = sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return {**target, **{s: level * weight[s] for s in open_}}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= most * sizes[s]
        open_ -= full
    return target


def plain_mix(rows):
    sized = [(i, s, len(WORD.findall(t or "")), len(t or "")) for i, t, s in rows]
    sizes = Counter()
    for _, s, n, _ in sized:
        sizes[s] += n
    target, out, by = plain_targets(sizes), [], defaultdict(list)
    for i, s, n, chars in sized:
        name = f"0:{'' if i is None else i}"
        u = (int(hashlib.md5(name.encode()).hexdigest()[:13], 16) + 1) / 16**13
        quality = max(0.1, 1 - abs(chars / max(n, 1) - 6) / 10)
        by[s].append((-math.log(u) / quality, i is None, i, n))
    for s, docs in by.items():
        epochs = min(3, int(target[s] / sizes[s])) if sizes[s] else 0
        rest, until = target[s] - epochs * sizes[s], 0
        for _, _, i, n in sorted(docs, key=lambda d: (d[0], d[1], d[2] or 0, d[3])):
            until += n
            copies = epochs + (2 * until - n <= 2 * rest)
            out.append((i, n, sizes[s], round(target[s], 6), copies * n))
    return sorted(out, key=repr)


def mixed(docs):
    return mixing.mix(docs.withColumn("_words", word_count("text")), F.col("_words"), readable(F.col("_words")))


@pytest.mark.parametrize("rows", [odd_rows(), [(i, "word " * (1 + i % 7), f"s{i % 9}") for i in range(300)],
                                  [(1, "only one", None)], [(1, "", "a"), (2, None, "a")]])
def test_mix(make, rows):
    got = [(r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixed(make(rows)).collect()]
    assert sorted(got, key=repr) == plain_mix(rows)


def test_mix_without_rows(nothing):
    assert mixed(nothing).collect() == []


def test_mix_stays_within_limits(make):
    rows = [(i, "w " * (1 + i % 50), "big" if i % 3 else f"small{i % 5}") for i in range(600)]
    taken, target = Counter(), {}
    for r in mixed(make(rows)).collect():
        assert r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 50 for s in target)


@pytest.mark.parametrize("weight", [0.01, 0.1, 0.5, 1.0])
def test_cells_are_small_at_any_weight(spark, weight):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    drawn = mixing.draws(F.lit(1), F.lit(weight), 0, "doc_id", "source")
    rows = docs.withColumns(drawn).withColumn("cell", mixing.cell_of("key"))
    cells = rows.groupBy("cell").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
    assert max(r.n for r in cells) <= 8
    cells.sort(key=lambda r: r.cell)
    assert 0 <= cells[0].cell and cells[-1].cell <= mixing.CELLS**2
    assert all(a.high < b.low for a, b in zip(cells, cells[1:]))


def test_extreme_keys_have_cells(spark):
    keys = [0.0, -0.0, 1e-300, 2.0**-26, 1.0, mixing.MOST_KEY, 2 * mixing.MOST_KEY]
    rows = spark.createDataFrame([(k,) for k in keys], "key double").withColumn("cell", mixing.cell_of("key"))
    cells = [r.cell for r in rows.collect()]
    assert cells[:4] == [0] * 4 and cells == sorted(cells) and cells[-1] == cells[-2] <= mixing.CELLS**2


@pytest.mark.parametrize("n", [0, 1, 60, 400])
def test_repeat(make, n):
    docs = make([(i, "word " * (i % 5), f"s{i % 4}") for i in range(n)])
    counts = {r.doc_id: r.copies for r in mixed(docs).collect()}
    size = word_count("text")
    out = mixing.repeat(docs, size, readable(size))
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == +Counter(counts)


def plain_groups(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for bare, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        out += [(m[2], keep[2], len(members), hashlib.sha256(bare.encode()).hexdigest()) for m in members]
    return sorted(out, key=repr)


def few_names(chunk):
    """An identifier that different chunks often share."""
    return F.length(chunk) % 5


@pytest.mark.parametrize("identify", [F.xxhash64, few_names])
def test_exact_groups(make, identify):
    body = "A sentence that goes on for a while. " * 120
    copies = [(100 + i, body.replace(" ", "  " if i % 2 else " ") + "x" * (i // 3), "s") for i in range(9)]
    rows = odd_rows() + copies
    found = exact_dedup.exact_groups(make(rows), identify=lambda chunk: identify(chunk)).collect()
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found]
    assert sorted(got, key=repr) == plain_groups(rows)
    assert sum(r.kept for r in found) == len({r.text_sha256 for r in found})


def test_chunks_hold_the_whole_text(spark, make):
    docs = make([(1, "a. " * 5000, "s"), (2, "b" * 40_000, "s"), (3, "", "s")])
    for row in exact_dedup.chunked(docs, "text").collect():
        assert "".join(row["_chunks"]) == row["_bare"]
        assert all(len(c) <= 8193 for c in row["_chunks"])


def test_keep_first(make, nothing):
    docs = make(odd_rows())
    kept = exact_dedup.keep_first(docs, exact_dedup.exact_groups(docs))
    assert kept.columns == docs.columns
    bare = [BLANK.sub("", r.text or "") for r in kept.collect()]
    assert len(bare) == len(set(bare)) == len({BLANK.sub("", t or "") for _, t, _ in odd_rows()})
    assert exact_dedup.exact_groups(nothing).collect() == []


def test_keep_first_by_text(make):
    rows = [(None, "a copy", "s"), (1, "a copy", "s"), (2, "other", "s"), (2, "a  copy", "s"), (2, "a copy", "s"),
            (3, "other text", "s"), (3, "a copy", "s"), (None, "only here", "s"), (None, "only here", "s"),
            (4, "only here", "s"), (None, "two", "s"), (None, "two ", "s")]
    docs = make(rows)
    kept = exact_dedup.keep_first(docs, exact_dedup.exact_groups(docs))
    assert kept.columns == docs.columns
    want = [(2, "a  copy"), (2, "other"), (3, "other text"), (4, "only here"), (None, "two ")]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def plain_table(shards, slots):
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16)
    orders = [((number(f"start:{n}") % slots), number(f"step:{n}") % (slots - 1) + 1) for n in shards]
    table, at, turn = {}, [0] * len(shards), 0
    while len(table) < slots:
        shard = turn % len(shards)
        start, step = orders[shard]
        while (start + at[shard] * step) % slots in table:
            at[shard] += 1
        table[(start + at[shard] * step) % slots] = shards[shard]
        turn += 1
    return table


@pytest.mark.parametrize(("n", "slots"), [(1, 13), (3, 101), (16, 499)])
def test_lookup_table(spark, n, slots):
    shards = [f"n{i}" for i in range(n)]
    got = {r.slot: r.shard for r in sharding.lookup_table(spark, shards, slots).collect()}
    assert got == plain_table(shards, slots)
    counts = Counter(got.values())
    assert max(counts.values()) - min(counts.values()) <= 1


def test_a_new_shard_moves_little(spark):
    old = plain_table([f"n{i}" for i in range(9)], 499)
    new = {r.slot: r.shard for r in sharding.lookup_table(spark, [f"n{i}" for i in range(10)], 499).collect()}
    assert sum(old[s] != new[s] for s in old) < 0.3 * len(old)


def test_place(odd, nothing):
    rows = sharding.place(odd, F.col("doc_id"), ["a", "b"], 101).collect()
    table = plain_table(["a", "b"], 101)
    assert len(rows) == len(odd_rows())
    for r in rows:
        name = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(name.encode()).hexdigest()[:8], 16) % 101
        assert (r.slot, r.shard) == (slot, table[slot])
    assert sharding.place(nothing, F.col("doc_id"), ["a"], 13).collect() == []


@pytest.mark.parametrize(("shards", "slots"), [([], 13), (["a", "a"], 13), (["a"], 12), (list("abcd"), 3)])
def test_bad_tables(spark, shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, shards, slots)


@pytest.mark.parametrize("ids", [[3] * 6, [None] * 6, list(range(6)), [1, 1, None, None, 2, 2]])
def test_rows_of_one_id_are_taken_each_for_itself(make, ids):
    """Words near the target, no row more often than three times, whether ids repeat or not."""
    rows = [(i, " ".join(["word"] * (20 + 7 * (n % 3))) + f" {n}", "a") for n, i in enumerate(ids)]
    rows += [(100 + n, "other words " * 40, f"s{n % 2}") for n in range(30)]
    docs = make(rows)
    size = word_count("text")
    mixed_rows = mixing.repeat(docs, size, readable(size))
    assert mixed_rows.columns == docs.columns
    taken = Counter(r.text for r in mixed_rows.collect() if r.source == "a")
    assert max(taken.values(), default=0) <= 3
    words = sum(len(WORD.findall(t)) * n for t, n in taken.items())
    plan = {r.source: r.target for r in mixed(docs).collect()}
    assert abs(words - plan["a"]) <= 40
    counted = Counter()
    for r in mixed(docs).collect():
        assert r.taken <= 3 * r.size
        counted[r.source] += r.taken
    assert counted["a"] == words


@pytest.mark.parametrize("salts", [1, 2, 1024])
def test_many_rows_of_one_id_at_the_end_of_a_budget(make, salts, monkeypatch):
    monkeypatch.setattr(mixing, "SALTS", salts)
    rows = [(None, f"one two three {n}", "a") for n in range(300)] + [(n, "w " * 50, "b") for n in range(20)]
    docs = make(rows)
    taken = [r.copies for r in mixed(docs).where("source = 'a'").collect()]
    target = mixed(docs).where("source = 'a'").first().target
    assert max(taken) - min(taken) <= 1 and abs(4 * sum(taken) - target) <= 4
    size = word_count("text")
    spread = Counter(r.text for r in mixing.repeat(docs, size, readable(size)).collect() if r.source == "a")
    assert sum(spread.values()) == sum(taken)
