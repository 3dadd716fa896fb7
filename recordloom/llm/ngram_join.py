"""Similarity join of documents on word n-grams, by vertical partitioning.

All n-grams have one global order, rarest first. It is cut into fragments; every document's set falls into one segment per
fragment, overlaps of candidate pairs are counted per fragment, and the counts are summed per pair.

What keeps this small:

* Equal sets are one class. Only classes are compared, and membership brings their documents back.
* N-grams of a single class cannot be shared. They are counted but never sent on, and a class that has too many of
  them can have no partner and leaves at once.
* A pair that is similar enough shares one of each side's rarest n-grams (its prefix), and all n-grams before the first
  shared one are unmatched on both sides, which bounds how late that may come.
* Groups are found in two turns. First every class of a bucket is compared with one member only, so a
  group of near copies joins up in linear work. Then the pairs whose sides are still apart are compared. Two classes that are
  already connected need not be, so these turns give the groups but not all links.
* Every link lies within a group. ``similar_links`` and ``link_counts`` then compare all classes of a group, which is cut into
  cells of bounded size: a task gets two cells and counts the overlaps of all their pairs at once.

Counting how many classes hold an n-gram takes one exchange of packed blocks: sorted hashes with the place of their
document in the block. N-grams that repeat within a block are sent once, so a very frequent one brings one entry per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.llm.components import components
from recordloom.llm.texts import batches, stage

FRAGMENTS = 4
PART_ENTRIES = 2_000_000  # n-grams one task counts
BLOCK_ENTRIES = 1_000_000  # n-grams in a block
BLOCK_SETS = 60_000  # sets in a block, numbered in 16 bits
SEVERAL = 0xFFFF
KNOWN_WORDS = 100_000
HASH_BYTES = 6
CELL_ENTRIES = 250_000  # n-grams in a cell of classes, about
CELL_CLASSES = 1_000
EXPANDED = 2_000_000  # shared n-grams of pairs, counted at once
MIX = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = found
        return found


WORDS = Words()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads neighbouring numbers over the whole range."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text, A-Z lower-cased; one for a text of fewer words."""
    words = text.lower().split()  # bytes: only A-Z change, and only the six ASCII blanks cut
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    width = min(n, len(codes))
    found = np.full(len(codes) - width + 1, width, np.uint64)
    for at in range(width):
        found = mixed(found * MIX + codes[at : at + len(found)])
    return np.unique(found)


def set_key(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def sets(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, digest, n_shingles, key``: a hash of the text, and the key that names the set, NULL for an empty one."""

    def run(part: pa.RecordBatch) -> dict:
        found = [shingles(text or b"", n) for text in part.column("text").cast(pa.binary()).to_pylist()]
        return {
            "doc_id": part.column("doc_id"),
            "digest": part.column("digest"),
            "n_shingles": pa.array([len(s) for s in found], pa.int64()),
            "key": pa.array([set_key(s) if len(s) else None for s in found], pa.binary()),
        }

    known = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    known = known.withColumn("digest", text_digest("text"))
    columns = {name: name for name in ("doc_id", "text", "digest")}
    return batches(known, columns, run, "doc_id {id}, digest bigint, n_shingles bigint, key binary")


def text_digest(column: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{column}`"), F.lit("")))


# --- which n-grams are shared -----------------------------------------------------------

ROW = pa.schema([("part", pa.int32()), ("block", pa.binary()), ("head", pa.bool_())] + [(c, pa.binary()) for c in "abc"])
ROW_SQL = "part int, block binary, head boolean, a binary, b binary, c binary"


def packed(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // HASH_BYTES, 8), np.uint8)
    out[:, :HASH_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, HASH_BYTES)
    return out.view("<u8").ravel()


def named(low: np.ndarray, part: np.ndarray | int) -> np.ndarray:
    """One number for an n-gram from its part and the bits that are sent."""
    return low ^ np.asarray(part).astype(np.uint64).reshape(-1) * MIX  # of one part too: arrays wrap without a warning


def block_rows(chosen: dict[bytes, np.ndarray], parts: int) -> Iterator[dict]:
    """A block as one row per part, and a head with its keys, sizes and what repeats within it."""
    keys = b"".join(chosen)
    block = xxhash.xxh3_128_digest(keys)  # the same block has the same name whenever it is made again
    sizes = np.array([len(s) for s in chosen.values()], np.int32)
    hashes = np.concatenate(list(chosen.values()))
    owners = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order]
    first = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    counts = np.diff(np.append(first, len(hashes))).astype(np.uint32)
    part_of = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    low = hashes & np.uint64((1 << 8 * HASH_BYTES) - 1)
    again = np.repeat(counts > 1, counts)
    yield {
        "part": int.from_bytes(block[:4], "big") % parts,
        "block": block,
        "head": True,
        "a": keys + sizes.tobytes(),
        "b": named(low[again], part_of[again]).tobytes(),
        "c": owners[again].tobytes(),
    }
    place = np.where(counts > 1, SEVERAL, owners[first]).astype(np.uint16)
    bounds = np.searchsorted(part_of[first], np.arange(parts + 1))
    for part in np.flatnonzero(np.diff(bounds)):
        here = slice(bounds[part], bounds[part + 1])
        yield {
            "part": int(part),
            "block": block,
            "head": False,
            "a": packed(low[first[here]]),
            "b": place[here].tobytes(),
            "c": counts[here][counts[here] > 1].tobytes(),
        }


def blocks(docs: DataFrame, n: int, parts: int, text_col: str) -> DataFrame:
    def task(batch_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen: dict[bytes, np.ndarray] = {}
        held = 0

        def full() -> Iterator[pa.RecordBatch]:
            rows = list(block_rows(chosen, parts))
            for at in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[at : at + 64], ROW)

        for part in batch_rows:
            for text in part.column(0).cast(pa.binary()).to_pylist():
                found = shingles(text or b"", n)
                if len(found) and (key := set_key(found)) not in chosen:
                    chosen[key] = found
                    held += len(found)
                    if held >= BLOCK_ENTRIES or len(chosen) >= BLOCK_SETS:
                        yield from full()
                        chosen.clear()
                        held = 0
        if chosen:
            yield from full()

    return docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(task, ROW_SQL)


def count_part(table: pa.Table) -> pa.Table:
    """The entries of a part that more than one set holds, with how many do; heads pass through."""
    rows = table.to_pylist()
    out = [row for row in rows if row["head"]]
    rows = [row for row in rows if not row["head"]]
    if rows:
        hashes = [unpacked(row["a"]) for row in rows]
        places = [np.frombuffer(row["b"], np.uint16) for row in rows]
        weights = []
        for row, place in zip(rows, places, strict=True):
            weight = np.ones(len(place), np.int64)
            weight[place == SEVERAL] = np.frombuffer(row["c"], np.uint32)
            weights.append(weight)
        _, which = np.unique(np.concatenate(hashes), return_inverse=True)
        held = np.bincount(which, np.concatenate(weights)).astype(np.int64)[which]
        at = 0
        for row, low, place in zip(rows, hashes, places, strict=True):
            count = held[at : at + len(low)]
            at += len(low)
            shared = count > 1
            if shared.any():
                out.append(
                    {
                        **row,
                        "a": named(low[shared], row["part"]).tobytes(),
                        "b": place[shared].tobytes(),
                        "c": np.minimum(count[shared], 0xFFFF).astype(np.uint16).tobytes(),
                    }
                )
    return pa.Table.from_pylist(out, ROW)


SURVIVOR = pa.schema(
    [("key", pa.binary()), ("n", pa.int32()), ("unshared", pa.int32()), ("grams", pa.list_(pa.int64()))]
)
SURVIVOR_SQL = "key binary, n int, unshared int, grams array<bigint>"


def gather_block(table: pa.Table, percent: int) -> pa.Table:
    """Sets of a block that could have a partner: their shared n-grams as numbers in the global order."""
    rows = table.to_pylist()
    heads = [row for row in rows if row["head"]]
    rows = [row for row in rows if not row["head"]]
    if not heads or not rows:
        return SURVIVOR.empty_table()
    head = heads[0]  # equal blocks have equal heads
    m = len(head["a"]) // 20
    sizes = np.frombuffer(head["a"][16 * m :], np.int32)
    grams = np.concatenate([np.frombuffer(row["a"], np.uint64) for row in rows])
    places = np.concatenate([np.frombuffer(row["b"], np.uint16) for row in rows])
    counts = np.concatenate([np.frombuffer(row["c"], np.uint16) for row in rows]).astype(np.int64)
    several = places == SEVERAL
    known, first = np.unique(grams[several], return_index=True)
    known_counts = counts[several][first]
    again = np.frombuffer(head["b"], np.uint64)
    grams = np.concatenate((grams[~several], again))
    owners = np.concatenate((places[~several], np.frombuffer(head["c"], np.uint16))).astype(np.int64)
    counts = np.concatenate((counts[~several], known_counts[np.searchsorted(known, again)]))
    # rarest first, then by hash: one number whose order is the global order; mixed, as the top bits of a name are its part's
    ordered = counts << 47 | (mixed(grams) >> np.uint64(17)).astype(np.int64)
    order = np.lexsort((ordered, owners))
    owners, ordered = owners[order], ordered[order]
    once = np.concatenate(([True], (owners[1:] != owners[:-1]) | (ordered[1:] != ordered[:-1])))
    owners, ordered = owners[once], ordered[once]
    bounds = np.searchsorted(owners, np.arange(m + 1))
    shared = np.diff(bounds)
    alive = np.flatnonzero(100 * shared >= percent * sizes)
    return pa.table(
        {
            "key": pa.array([head["a"][16 * i : 16 * i + 16] for i in alive], pa.binary()),
            "n": pa.array(sizes[alive], pa.int32()),
            "unshared": pa.array((sizes - shared)[alive], pa.int32()),
            "grams": pa.array([ordered[bounds[i] : bounds[i + 1]] for i in alive], pa.list_(pa.int64())),
        },
        SURVIVOR,
    )


def survivors(docs: DataFrame, found: DataFrame, n: int, percent: int, text_col: str) -> DataFrame:
    """``key, n, unshared, grams`` of the classes that could have a partner."""
    distinct = found.where("key is not null").groupBy("key").agg(F.max("n_shingles").alias("n"))
    total = distinct.agg(F.sum("n")).first()[0] or 0
    parts = max(1, math.ceil(total / PART_ENTRIES))
    counted = blocks(docs, n, parts, text_col).groupBy("part").applyInArrow(count_part, ROW_SQL)
    gathered = counted.groupBy("block").applyInArrow(lambda table: gather_block(table, percent), SURVIVOR_SQL)
    once = [F.first(c).alias(c) for c in ("n", "unshared", "grams")]  # a class may lie in several blocks
    return gathered.groupBy("key").agg(*once)


# --- which classes link ---------------------------------------------------------------


def least_overlap(n: Column, other: Column, percent: int) -> Column:
    """The smallest overlap at which two sets of these sizes are similar enough."""
    return F.ceil((n + other) * percent / F.lit(100 + percent))


def buckets(alive: DataFrame, percent: int) -> DataFrame:
    """``gram, key, n, unshared, place`` for the shared n-grams in every class's prefix."""
    prefix = F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1 - F.col("unshared")
    heads = alive.select("key", "n", "unshared", F.slice("grams", 1, F.greatest(prefix, F.lit(0)).cast("int")).alias("g"))
    return heads.select("key", "n", "unshared", F.posexplode("g").alias("at", "gram")).select(
        "gram", "key", "n", "unshared", (F.col("at") + F.col("unshared")).alias("place")
    )


def possible(percent: int) -> Column:
    """Whether the bucket entries ``x`` and ``y`` may be a link whose first shared n-gram this is."""
    n, other, place, other_place = (F.col(c) for c in ("x.n", "y.n", "x.place", "y.place"))
    needed = least_overlap(n, other, percent)
    return (place + other_place <= n + other - 2 * needed) & (F.least(n - place, other - other_place) >= needed)


def joined(x: DataFrame, y: DataFrame, which: Column, percent: int) -> DataFrame:
    """``a, b, n_a, n_b``: distinct pairs of classes in a common bucket that may link."""
    same = (F.col("x.gram") == F.col("y.gram")) & which & possible(percent)
    swap = F.col("x.key") > F.col("y.key")
    pairs = x.alias("x").join(y.alias("y"), same).select(
        F.least("x.key", "y.key").alias("a"),
        F.greatest("x.key", "y.key").alias("b"),
        F.when(swap, F.col("y.n")).otherwise(F.col("x.n")).alias("n_a"),
        F.when(swap, F.col("x.n")).otherwise(F.col("y.n")).alias("n_b"),
    )
    return stage(pairs.distinct(), "pairs")


def segments(alive: DataFrame, fragments: int) -> DataFrame:
    """``key, fragment, segment``: the global order cut where equal shares of all n-grams lie."""
    shares = [i / fragments for i in range(1, fragments)]
    all_grams = alive.select(F.explode("grams").alias("gram"))
    pivots = all_grams.agg(F.percentile_approx("gram", shares, 1000)).first()[0] or []
    edges = [None, *sorted(set(pivots)), None]

    def inside(low, high):
        def test(gram: Column) -> Column:
            return (F.lit(True) if low is None else gram >= low) & (F.lit(True) if high is None else gram < high)

        return test

    cut = F.array(*[F.filter("grams", inside(low, high)) for low, high in zip(edges, edges[1:])])
    parts = alive.select("key", F.posexplode(cut).alias("fragment", "segment"))
    return stage(parts.where(F.size("segment") > 0), "segments")


def verified(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs that link. ``pairs`` has ``a, b, n_a, n_b``; overlaps are counted per fragment and summed per pair."""
    left = parts.select(F.col("key").alias("a"), "fragment", F.col("segment").alias("segment_a"))
    right = parts.select(F.col("key").alias("b"), "fragment", F.col("segment").alias("segment_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"])
    overlap = F.size(F.array_intersect("segment_a", "segment_b")).cast("bigint")
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum(overlap).alias("overlap"))
    return summed.where(F.col("overlap") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("overlap")) * percent).select("a", "b")


def class_links(alive: DataFrame, percent: int, fragments: int) -> DataFrame:
    """``a, b``: links that connect the classes as all links would."""
    indexed = stage(buckets(alive, percent), "index")
    hub = F.min(F.struct("unshared", "key", "n", "place")).alias("hub")
    shared = indexed.groupBy("gram").agg(F.count("*").alias("members"), hub).where("members > 1")
    hubs = stage(shared.select("gram", "hub.key", "hub.n", "hub.place"), "hubs")
    parts = segments(alive, fragments)
    near = joined(indexed, hubs, F.col("x.key") != F.col("y.key"), percent)
    first = stage(verified(near, parts, percent), "links")
    roots = components(first)
    kept = indexed.join(hubs.select("gram"), "gram", "left_semi")
    rooted = kept.join(roots, kept["key"] == roots["node"], "left")
    index = stage(rooted.select(kept["*"], F.coalesce("root", "key").alias("root")), "index")
    apart = (F.col("x.key") < F.col("y.key")) & (F.col("x.root") != F.col("y.root"))
    rest = joined(index, index, apart, percent)
    return first.union(stage(verified(rest, parts, percent), "links"))


# --- all links --------------------------------------------------------------------------

LINK = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("overlap", pa.int64())])
COUNT = pa.schema([("key", pa.binary()), ("links", pa.int64())])


def cells(alive: DataFrame, roots: DataFrame, sizes: DataFrame) -> DataFrame:
    """``low, high, cell, key, n, copies, grams``: the classes of groups, once for each pair of cells they are compared in.

    A group that fits one cell shares it with others; a larger one has cells of its own. Either way a hash deals them
    out, and every pair of classes of a group meets in exactly one pair of cells.
    """
    nodes = roots.select(F.col("node").alias("key"), "root").join(sizes, "key")
    held = nodes.groupBy("root").agg(F.sum("n_shingles").alias("entries"), F.count("*").alias("classes"))
    enough = F.greatest(F.ceil(F.col("entries") / CELL_ENTRIES), F.ceil(F.col("classes") / CELL_CLASSES))
    held = stage(held.withColumn("cut", enough.cast("int")), "groups")
    small = held.where("cut = 1").agg(F.sum("entries"), F.sum("classes")).first()
    bundles = max(1, math.ceil((small[0] or 0) / CELL_ENTRIES), math.ceil((small[1] or 0) / CELL_CLASSES))
    placed = nodes.join(held.select("root", "cut"), "root")
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("root"), F.lit(bundles)))
    own = F.pmod(F.xxhash64("key"), F.col("cut")).cast("int")
    placed = placed.select(
        "key",
        "copies",
        "cut",
        F.when(F.col("cut") == 1, bundle.cast("binary")).otherwise(F.col("root")).alias("cell_group"),
        own.alias("cell"),
    )
    known = alive.select("key", "n", "grams").join(placed, "key")
    other = F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("other")
    return known.select("cell_group", "cell", other, "key", "n", "copies", "grams").select(
        "cell_group",
        F.least("cell", "other").alias("low"),
        F.greatest("cell", "other").alias("high"),
        "cell",
        "key",
        "n",
        "copies",
        "grams",
    )


def entries(sets: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of some sets in order, and the sets that hold them."""
    sizes = pa.compute.list_value_length(sets).to_numpy(zero_copy_only=False)
    grams = pa.compute.list_flatten(sets).to_numpy(zero_copy_only=False)
    order = np.argsort(grams, kind="stable")
    return grams[order], np.repeat(np.arange(len(sizes)), sizes)[order]


def overlaps(x: pa.Array, y: pa.Array) -> np.ndarray:
    """How many n-grams every set of ``x`` shares with every set of ``y``."""
    grams, owners = entries(x)
    others, holders = entries(y)
    first = np.searchsorted(others, grams, "left")
    held = np.searchsorted(others, grams, "right") - first
    owners, first, held = owners[held > 0], first[held > 0], held[held > 0]
    counts = np.zeros(len(x) * len(y), np.int64)
    until = np.cumsum(held)
    at = 0
    while at < len(held):
        done = until[at] - held[at]
        end = max(at + 1, int(np.searchsorted(until, done + EXPANDED, "right")))
        many = held[at:end]
        start = np.repeat(first[at:end] - (until[at:end] - many - done), many)
        found = holders[start + np.arange(len(start))]
        counts += np.bincount(np.repeat(owners[at:end], many) * len(y) + found, minlength=len(counts))
        at = end
    return counts.reshape(len(x), len(y))


def linked(table: pa.Table, percent: int) -> tuple[pa.Table, pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """The classes of both cells, the places of those that link, and their overlaps; each pair once."""
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    x = table.filter(pa.compute.equal(table["cell"], low))
    y = table.filter(pa.compute.equal(table["cell"], high))
    overlap = overlaps(x["grams"].combine_chunks(), y["grams"].combine_chunks())
    total = np.add.outer(*(t["n"].to_numpy().astype(np.int64) for t in (x, y)))
    similar = overlap * 100 >= (total - overlap) * percent
    i, j = np.nonzero(np.triu(similar, 1) if low == high else similar)
    return x, y, i, j, overlap[i, j]


def links_of_cells(table: pa.Table, percent: int) -> pa.Table:
    x, y, i, j, overlap = linked(table, percent)
    a, b = x["key"].combine_chunks().take(pa.array(i)), y["key"].combine_chunks().take(pa.array(j))
    ordered = pa.compute.less(a, b)
    ends = pa.compute.if_else(ordered, a, b), pa.compute.if_else(ordered, b, a)
    return pa.table([*ends, pa.array(overlap, pa.int64())], schema=LINK)


def counts_of_cells(table: pa.Table, percent: int) -> pa.Table:
    """To how many documents of the other classes every class links here."""
    x, y, i, j, _ = linked(table, percent)
    sums = []
    for own, other, at, partner in ((x, y, i, j), (y, x, j, i)):
        found = np.zeros(own.num_rows, np.int64)
        np.add.at(found, at, other["copies"].to_numpy()[partner])
        sums.append(pa.table([own["key"], pa.array(found)], schema=COUNT))
    return pa.concat_tables(sums)


class Join(NamedTuple):
    sets: DataFrame
    alive: DataFrame
    roots: DataFrame
    sizes: DataFrame  # ``key, n_shingles, copies, class_id`` of the classes


def join(docs: DataFrame, n: int, percent: int, fragments: int, id_col: str, text_col: str) -> Join:
    found = stage(sets(docs, n, id_col, text_col), "sets")
    alive = stage(survivors(docs, found, n, percent, text_col), "survivors")
    roots = components(class_links(alive, percent, fragments))
    sizes = found.where("key is not null").groupBy("key").agg(
        F.max("n_shingles").alias("n_shingles"), F.count("*").alias("copies"), F.min("doc_id").alias("class_id")
    )
    return Join(found, alive, roots, sizes)


def in_cells(found: Join, run: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    dealt = cells(found.alive, found.roots, found.sizes.select("key", "n_shingles", "copies"))
    return dealt.groupBy("cell_group", "low", "high").applyInArrow(run, schema)


def members(found: Join) -> DataFrame:
    """``doc_id, digest, n_shingles, key, class_id, component_id, component, copies`` of every row.

    ``component`` names the group also where no row of it has an id; it is NULL where the set is empty.
    """
    classes, roots = found.sizes.drop("n_shingles"), found.roots
    rooted = classes.join(roots, classes["key"] == roots["node"], "left")
    rooted = rooted.select("key", "class_id", "copies", F.coalesce("root", "key").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("class_id").alias("component_id"))
    known = rooted.join(lowest, "root").select(
        F.col("key").alias("_key"), "class_id", "component_id", F.col("root").alias("component"), "copies"
    )
    out = found.sets.join(known, found.sets["key"] == known["_key"], "left")
    return out.select(
        "doc_id",
        "digest",
        "n_shingles",
        "key",
        "component",
        F.coalesce("class_id", F.when(F.col("key").isNull(), F.col("doc_id"))).alias("class_id"),
        F.coalesce("component_id", F.when(F.col("key").isNull(), F.col("doc_id"))).alias("component_id"),
        "copies",
    )


def similar_groups(
    docs: DataFrame,
    n: int = 4,
    percent: int = 85,
    fragments: int = FRAGMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every document with the group it is linked to, for callers that need no links.

    Two documents link when their sets of word n-grams overlap by ``percent`` of their union or more. Returns one row
    per input row, ``doc_id, n_shingles, class_id, component_id``: the size of its set, the smallest id with an equal set and the
    smallest id reachable by links. A-Z count as a-z; a text of fewer than ``n`` words is one n-gram; one without words
    (or NULL) links with nothing, so its class and component are its own id. A NULL id is never the
    smallest; rows that repeat an id are each a document. Pairs that are connected already are not compared.
    ``digest``, a hash of the text, and ``component``, a name of the group, tell rows apart that have no id of their own.
    """
    found = join(docs, n, percent, fragments, id_col, text_col)
    return members(found).select("doc_id", "n_shingles", "class_id", "component_id", "digest", "component")


def similar_links(
    docs: DataFrame,
    n: int = 4,
    percent: int = 85,
    fragments: int = FRAGMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The whole join, as members and links.

    Members are the rows of ``similar_groups`` with ``key``, the name of the set (NULL for an empty one): documents of equal
    keys link. Links are all pairs of different sets that are similar enough, ``a, b, overlap``: their keys, a < b, and
    how many n-grams they share. Their number grows with the square of a group of near copies.
    """
    found = join(docs, n, percent, fragments, id_col, text_col)
    links = in_cells(found, lambda table: links_of_cells(table, percent), "a binary, b binary, overlap bigint")
    return members(found).select("doc_id", "n_shingles", "key", "class_id", "component_id"), links


def link_counts(
    docs: DataFrame,
    n: int = 4,
    percent: int = 85,
    fragments: int = FRAGMENTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``similar_groups`` with ``n_links``: to how many other rows a document links, equal sets included.

    All links are verified; their rows are summed where they are found.
    """
    found = join(docs, n, percent, fragments, id_col, text_col)
    partial = in_cells(found, lambda table: counts_of_cells(table, percent), "key binary, links bigint")
    counted = partial.groupBy(F.col("key").alias("_key")).agg(F.sum("links").alias("links"))
    rows = members(found)
    rows = rows.join(counted, rows["key"] == counted["_key"], "left")
    n_links = F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))
    return rows.select("doc_id", "n_shingles", "class_id", "component_id", n_links.alias("n_links"))


def keep_one(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns: one of each group, and all without words.

    The row of the smallest id stays, NULL after all others, then the one of the smallest text digest. Ids of which there is one
    row decide by themselves, and only those that go are joined; rows of a NULL or repeated id are told apart by their text, and
    of rows that agree in both one stays.
    """
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    leaders = groups.where("component is not null").groupBy("component").agg(F.min(order).alias("first"))
    led = groups.join(leaders.withColumnRenamed("component", "_component"), F.col("component") == F.col("_component"), "left")
    stays = F.coalesce(F.col("first") == order, F.lit(True))  # an empty set has no group
    decided = stage(led.select("doc_id", "digest", stays.alias("stays"), F.col("component").isNull().alias("empty")), "decided")
    ids = decided.groupBy("doc_id").agg(F.count("*").alias("rows"), F.bool_or("stays").alias("any"))
    ids = stage(ids.where("rows > 1 or doc_id is null or not any"), "ids")
    several = F.col("doc_id").isNull() | (F.col("rows") > 1)
    gone = ids.where(~several).select(F.col("doc_id").alias("_gone"))
    left = docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    unclear = ids.where(several).select(F.col("doc_id").alias("_again"))
    if unclear.isEmpty():
        return left
    again = docs[id_col].eqNullSafe(unclear["_again"])
    chosen = decided.join(unclear, decided["doc_id"].eqNullSafe(unclear["_again"]), "left_semi").where("stays")
    chosen = stage(chosen.groupBy("doc_id", "digest").agg(F.bool_or("empty").alias("_empty")), "chosen")
    chosen = chosen.withColumnsRenamed({"doc_id": "_chosen", "digest": "_digest"})
    rows = left.join(unclear, again, "left_semi").withColumn("_text_digest", text_digest(text_col))
    found = rows.join(chosen, rows[id_col].eqNullSafe(chosen["_chosen"]) & (F.col("_text_digest") == F.col("_digest")))
    turn = F.row_number().over(W.partitionBy(F.col(f"`{id_col}`"), "_digest").orderBy(F.lit(0)))
    first = found.where("not _empty").withColumn("_turn", turn).where("_turn = 1").select(docs.columns)
    return left.join(unclear, again, "left_anti").unionByName(first).unionByName(found.where("_empty").select(docs.columns))
