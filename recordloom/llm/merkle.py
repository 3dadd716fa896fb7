"""A Merkle manifest of a dataset, kept as an append log in postorder.

Every row is a leaf: the digest of its columns. The leaves of a group ascend by id and form a tree in which a node is the digest
of up to 16 digests below it; the roots of all groups, in group order, are the leaves of one more tree, whose root names
the whole dataset.

A tree is written as a log: a node is appended as soon as all below it are complete, so a subtree is one stretch of the log and
its place follows from the sizes of the subtrees before it. ``position`` gives that place in closed form. Builders are
aligned: each takes the 4,096 nodes under one node three levels up, builds what lies above them in memory and appends its
stretch on its own. The nodes they end in are the input of the next tier of builders, so a tree takes one tier for each
factor of 4,096 in its leaves, and no task ever holds more than one builder's nodes, however many rows a group has.

A proof is the siblings on the way up. They are read from the log by their positions: each builder's stretch gives the siblings
within it, and the way above it is handed down from the tier above, once per builder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.llm.texts import stage
from recordloom.session import shuffle_partitions

BITS = 4  # a node is made of up to 16
TIER = 3  # levels a builder makes
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves; a lone leaf is its own root."""
    levels = 0
    while n > 1:
        n, levels = (n + 15) >> BITS, levels + 1
    return levels


def position(level: int, index: int, n: int) -> int:
    """Place of a node in the log of a tree of ``n`` leaves: how many nodes are complete before it.

    Up to its last leaf, its own level and those below have as many nodes as begun there, the levels above as many as
    ended before that leaf.
    """
    end = min((index + 1) << (BITS * level), n)
    place, last = end - 1, end - 1
    for k in range(1, level + 1):
        place += ((end - 1) >> (BITS * k)) + 1
    k = level + 1
    while last >> (BITS * k):
        place += last >> (BITS * k)
        k += 1
    return place


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with its length in bytes, so that no two rows are written the same; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(column) for column in columns]), 256)


def ordered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` and ``n``: place among the rows of the same ``tree`` in ``order``, and how many there are.

    Rows that agree in ``order`` must be interchangeable, or ``order`` unique. A window per tree would pull a large one
    through a single task. Here sorted ranges of all rows number their own, and only counts per range and tree are added up.
    """
    keys = ["tree", *order]
    ranges = rows.repartitionByRange(shuffle_partitions(rows), *keys).sortWithinPartitions(*keys)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    kept = stage(ranges.select("*", F.spark_partition_id().alias("_range"), within.alias("_within")), "merkle-ranges")
    counts = kept.groupBy("tree", "_range").agg(F.count("*").alias("_rows"), F.min("_within").alias("_first"))
    earlier = W.partitionBy("tree").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        "tree",
        "_range",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_start"),
        F.sum("_rows").over(W.partitionBy("tree")).alias("n"),
    )
    placed = kept.join(starts, ["tree", "_range"])
    return placed.withColumn("rank", F.col("_start") + F.col("_within")).drop("_range", "_within", "_start", "_first")


NODES = "tree string, n bigint, block bigint, level int, idx bigint, position bigint, digest string"


def builder(base: int, tier: int):
    """One builder: nodes of level ``base`` under one node ``tier`` levels up, to all between, in order of completion."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tree, n, block = (value.as_py() for value in key)
        first = block << (BITS * tier)
        given = [""] * table.num_rows
        for i, found in zip(table.column("idx").to_pylist(), table.column("digest").to_pylist(), strict=True):
            given[i - first] = found
        top = min(base + tier, height(n))
        levels, indexes, digests = [], [], []

        def append(level: int, index: int, found: str) -> None:
            levels.append(level)
            indexes.append(index)
            digests.append(found)

        open_: list[list[str]] = [[] for _ in range(tier + 1)]  # digests waiting for their parent, per level
        for i, found in enumerate(given):
            append(base, first + i, found)
            last = i + 1 == len(given)
            for step in range(1, top - base + 1):
                open_[step].append(found)
                if not last and (i + 1) & ((1 << BITS * step) - 1):
                    break
                found = digest(open_[step])
                open_[step] = []
                append(base + step, (first + i) >> (BITS * step), found)
        return pa.Table.from_pydict(
            {
                "tree": pa.array([tree] * len(levels), pa.string()),
                "n": pa.array([n] * len(levels), pa.int64()),
                "block": pa.array([block] * len(levels), pa.int64()),
                "level": pa.array(levels, pa.int32()),
                "idx": pa.array(indexes, pa.int64()),
                "position": pa.array([position(*at, n) for at in zip(levels, indexes, strict=True)], pa.int64()),
                "digest": digests,
            }
        )

    return run


def build(leaves: DataFrame, tier: int) -> list[DataFrame]:
    """Tiers of the trees of ``tree, n, rank, digest``: each the nodes its builders read and made, by builder.

    The number of tiers follows from the largest tree, which is one number.
    """
    most = leaves.agg(F.max("n")).first()[0]
    nodes = leaves.select("tree", "n", F.col("rank").alias("idx"), "digest")
    tiers = []
    for base in range(0, max(1, height(most or 0)), tier):
        blocks = nodes.withColumn("block", F.shiftright("idx", BITS * tier)).groupBy("tree", "n", "block")
        tiers.append(stage(blocks.applyInArrow(builder(base, tier), NODES), "merkle-tier"))
        unfinished = F.col("n") > F.lit(1 << (BITS * (base + tier)))
        nodes = tiers[-1].where((F.col("level") == base + tier) & unfinished).select("tree", "n", "idx", "digest")
    return tiers


def log(tiers: Sequence[DataFrame], tier: int) -> DataFrame:
    """``tree, position, level, idx, digest`` of every node, each once; ordered by position it is the append log."""
    own = [nodes.where(F.col("level") > tier * i) if i else nodes for i, nodes in enumerate(tiers)]
    return reduce(DataFrame.unionByName, own).select("tree", "position", "level", "idx", "digest")


def roots(tiers: Sequence[DataFrame]) -> DataFrame:
    """``tree, n, digest`` of the root of every tree: the node that is alone on its level."""
    alone = [nodes.where("shiftright(n - 1, 4 * level) = 0").select("tree", "n", "digest") for nodes in tiers]
    return reduce(DataFrame.unionByName, alone)


STEPS = "array<struct<left:string,right:string>>"  # siblings before and after the way up, level by level
WAY = f"tree string, block bigint, steps {STEPS}, subroot string, root string"
WAY_ROW = -1  # position of the row that brings a builder the way above it


class Stretch:
    """One builder's part of the log and the way above it."""

    def __init__(self, base: int, tier: int, table: pa.Table):
        rows = table.select(["position", "n", "digest", "steps", "subroot", "root"]).to_pylist()
        self.base = base
        above = next(row for row in rows if row["position"] == WAY_ROW)
        self.above, self.subroot, self.root = above["steps"], above["subroot"], above["root"]
        self.n = next(row["n"] for row in rows if row["position"] != WAY_ROW)
        self.at = {row["position"]: row["digest"] for row in rows}
        self.top = min(base + tier, height(self.n))
        self.known: dict[tuple[int, int], list[dict]] = {}

    def step(self, level: int, index: int) -> dict:
        """Siblings of a node, read from the log by position."""
        run = index >> BITS << BITS
        width = ((self.n - 1) >> (BITS * level)) + 1
        at = [self.at[position(level, i, self.n)] for i in range(run, min(run + 16, width))]
        return {"left": "".join(at[: index - run]), "right": "".join(at[index - run + 1 :])}

    def way(self, level: int, index: int) -> list[dict]:
        """The siblings from a node to the root of all; shared by all nodes of a run from their parent on."""
        if level == self.top:
            return self.above
        if (level, index) not in self.known:
            self.known[level, index] = self.way(level + 1, index >> BITS)
        return [self.step(level, index), *self.known[level, index]]


def hand_down(base: int, tier: int):
    """The way from each node a builder started with."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        stretch, first = Stretch(base, tier, table), key[1].as_py() << (BITS * tier)
        width = ((stretch.n - 1) >> (BITS * base)) + 1
        nodes = range(first, min(first + (1 << (BITS * tier)), width))
        steps = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        return pa.Table.from_pydict(
            {
                "tree": pa.array([key[0].as_py()] * len(nodes), pa.string()),
                "block": pa.array(nodes, pa.int64()),
                "steps": pa.array([stretch.way(base, i) for i in nodes], steps),
                "subroot": pa.array([stretch.subroot] * len(nodes), pa.string()),
                "root": pa.array([stretch.root] * len(nodes), pa.string()),
            }
        )

    return run


def with_way(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """A tier's nodes and, for each builder, a row with the way above it."""
    nothing = [F.lit(None).cast(STEPS).alias("steps"), F.lit(None).cast("string").alias("subroot"),
               F.lit(None).cast("string").alias("root")]
    nodes = nodes.select("tree", "block", "position", "n", "digest", *nothing)
    ways = above.select(
        "tree", "block", F.lit(WAY_ROW).cast("bigint").alias("position"), F.lit(None).cast("bigint").alias("n"),
        F.lit(None).cast("string").alias("digest"), "steps", "subroot", "root",
    )
    return nodes.unionByName(ways)


def ways_to_builders(tiers: Sequence[DataFrame], tops: DataFrame, tier: int) -> DataFrame:
    """``tree, block, steps, subroot, root`` for the builders of the lowest tier, handed down from ``tops``.

    ``tops`` has one row per tree, ``tree, n, steps, subroot, root``; it enters at the tier that ends in the tree's root.
    """
    ways = None
    for i in range(len(tiers) - 1, -1, -1):
        if ways is not None:
            grouped = with_way(tiers[i + 1], ways).groupBy("tree", "block")
            ways = grouped.applyInArrow(hand_down(tier * (i + 1), tier), WAY)
        least = 1 << (BITS * tier * i) if i else 0
        ends_here = (F.col("n") > F.lit(least)) & (F.col("n") <= F.lit(1 << (BITS * tier * (i + 1))))
        own = tops.where(ends_here).select("tree", F.lit(0).cast("bigint").alias("block"), "steps", "subroot", "root")
        ways = stage(own if ways is None else ways.unionByName(own), "merkle-ways")
    return ways


def ways_to_leaves(tiers: Sequence[DataFrame], tops: DataFrame, tier: int) -> DataFrame:
    """The same for every leaf, with its rank as ``block``."""
    grouped = with_way(tiers[0], ways_to_builders(tiers, tops, tier)).groupBy("tree", "block")
    return stage(grouped.applyInArrow(hand_down(0, tier), WAY), "merkle-ways")


PROVEN = "id {id}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def prove(tier: int):
    """Proofs of one builder's leaves, and the root each one's given leaf leads to."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, table: pa.Table) -> pa.Table:
        stretch = Stretch(0, tier, table)
        out: dict[str, list] = {name: [] for name in ("proof_sha256", "folded_root")}
        for rank, given in zip(rows.column("rank").to_pylist(), rows.column("given").to_pylist(), strict=True):
            steps = stretch.way(0, rank)
            out["proof_sha256"].append(digest([step["left"] + step["right"] for step in steps]))
            for step in steps:
                given = digest([step["left"], given, step["right"]])
            out["folded_root"].append(given)
        return pa.Table.from_pydict(
            {
                "id": rows.column("id"),
                "leaf": rows.column("leaf"),
                "subroot": pa.array([stretch.subroot] * rows.num_rows, pa.string()),
                "root": pa.array([stretch.root] * rows.num_rows, pa.string()),
                **out,
                "verified": [folded == stretch.root for folded in out["folded_root"]],
            }
        )

    return run


class Manifest:
    """Trees over the rows of a table, one per value of ``group_col``, and the tree over their roots.

    ``columns`` make the leaf; ``given`` is the leaf a proof is checked with, by default the row's own. Rows of a group ascend
    by id, NULL first, then by leaf; rows equal in both are equal in all their columns and may change places. A
    NULL group is a group of its own and the first one. A table without rows has no root. ``tier`` says how many levels a
    builder makes; it changes no digest and no position.
    """

    def __init__(
        self,
        docs: DataFrame,
        columns: Sequence[Column] | None = None,
        given: Column | None = None,
        id_col: str = "doc_id",
        group_col: str = "source",
        tier: int = TIER,
    ):
        own = leaf([F.col(name) for name in COLUMNS] if columns is None else columns)
        rows = docs.select(
            F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).alias("tree"),
            F.col(id_col).alias("id"),
            own.alias("leaf"),
            (own if given is None else given).alias("given"),
            F.monotonically_increasing_id().alias("row"),
        )
        self.id_col, self.tier = id_col, tier
        hashed = stage(rows, "merkle-leaves")
        self.leaves = stage(ordered(hashed, ["id", "leaf", "row"]), "merkle-ranked")
        self.tiers = build(self.leaves.select("tree", "n", "rank", F.col("leaf").alias("digest")), tier)
        self.subroots = roots(self.tiers)
        top = self.subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "n", "digest")
        self.groups = stage(ordered(top.withColumnRenamed("n", "size"), ["group"]), "merkle-groups")
        self.top_tiers = build(self.groups.select("tree", "n", "rank", "digest"), tier)

    def root(self) -> DataFrame:
        """``digest`` of the whole dataset, one row (none without rows)."""
        return roots(self.top_tiers).select("digest")

    def log(self) -> DataFrame:
        """``source, position, level, idx, digest`` of all nodes of the trees of rows."""
        name = F.when(F.col("tree") != "0", F.substring("tree", 2, (1 << 31) - 1))
        return log(self.tiers, self.tier).select(name.alias("source"), "position", "level", "idx", "digest")

    def proofs(self) -> DataFrame:
        """Per row: its id, ``leaf, subroot, root, proof_sha256, folded_root, verified``.

        The proof is all siblings from the leaf to the root of its group and on to the root of all, left to right; its digest is
        that of no text where a row has none. ``folded_root`` is what the given leaf leads to with these siblings.
        """
        nowhere = F.array().cast(STEPS)
        start = roots(self.top_tiers).select(
            "tree", "n", nowhere.alias("steps"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root")
        )
        above = ways_to_leaves(self.top_tiers, start, self.tier).select(F.col("block").alias("rank"), "steps", "root")
        tops = self.groups.join(above, "rank").select(
            F.col("group").alias("tree"), F.col("size").alias("n"), "steps", F.col("digest").alias("subroot"), "root"
        )
        ways = ways_to_builders(self.tiers, stage(tops, "merkle-tops"), self.tier)
        block = F.shiftright("rank", BITS * self.tier).alias("block")
        rows = self.leaves.select("tree", block, "rank", "id", "leaf", "given").groupBy("tree", "block")
        stretches = with_way(self.tiers[0], ways).groupBy("tree", "block")
        schema = PROVEN.format(id=self.leaves.schema["id"].dataType.simpleString())
        return rows.cogroup(stretches).applyInArrow(prove(self.tier), schema).withColumnRenamed("id", self.id_col)


def lowered(column: str) -> Column:
    """A text with its capital letters A to Z made small."""
    return F.translate(F.col(column), UPPER, LOWER)


def chosen(id_col: str, every: int) -> Column:
    """Rows whose id, written in decimal, has a CRC-32 divisible by ``every``; not those without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % every == 0, F.lit(False))


def audit(docs: DataFrame, every: int = 5, tier: int = TIER) -> DataFrame:
    """Proofs of all rows, checked against a dataset whose chosen rows had their texts put into small letters."""
    own = [F.col(name) for name in COLUMNS]
    changed = leaf([*own[:-1], lowered("text")])
    given = F.when(chosen("doc_id", every), changed).otherwise(leaf(own))
    return Manifest(docs, own, given, tier=tier).proofs()
