"""Approximate nearest neighbours by a few stable projections, a kd-tree over them, and a chi-square stopping test.

Vectors are projected on few Gaussian directions. A Gaussian is stable: the projected squared distance of two points is their true
squared distance times a chi-square variable of as many degrees of freedom as directions. Neighbours are met in the order of
their projected distance and verified on the whole vectors; with d the distance of the k-th best so far and p the projected
distance reached, the search ends once p² / d² exceeds the chi-square quantile of ``CONFIDENCE``: a point that is nearer than d
but still not met would have to be projected further than it is with all but 1 - ``CONFIDENCE`` of the directions.

Largest inner products become smallest distances by one more coordinate: with M the largest norm, a vector x goes to
(x, sqrt(M² - |x|²)) and a query q to (q M / |q|, 0). Their squared distance is 2 M² - 2 M q·x / |q|, and orders as q·x does.

The index is a kd-tree in two storeys. The upper one, fitted on a bounded sample, cuts the projected space into cells; every
vector is put into its cell, and a cell of many vectors, however alike, is dealt into several blocks of bounded size. Within a block the
lower storey is built in memory. Queries go to the nearest blocks first, a few more each round with the bound found so far,
until the test ends them; within a block they take its leaves in order of distance, until the same test. No cap
ends a search.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.llm.texts import batches, stage

DIRECTIONS = 12  # projections; even, which gives the chi-square distribution a closed form
CONFIDENCE = 0.98
SEED = 20_240_607
SAMPLE = 16_384  # vectors of lowest hash the cells are fitted on
BLOCK_VALUES = 1 << 20  # components a block is meant for, 8 MB
MAX_CELLS = 4_096  # of the upper storey; cells of more vectors have more blocks
LEAF_ROWS = 512  # vectors in a leaf of the lower storey
CHUNK = 16_384  # queries a block takes at once
GROWTH = 4  # blocks a query has seen after a round, in blocks seen before
SPARE = 9  # distinct vectors kept beyond the k asked for: one for the query's own, the others for rounding
SLACK = 1e-12  # rounding of an inner product, in products of the norms

RESULT = "query_id bigint, rank int, vec_id bigint, score double"
FOUND_FIELDS = pa.schema([("query_row", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def chi_square(x: float, degrees: int) -> float:
    """Probability that a chi-square variable of an even number of degrees is at most ``x``."""
    term = total = math.exp(-x / 2)
    for j in range(1, degrees // 2):
        term *= x / 2 / j
        total += term
    return 1 - total


def quantile(confidence: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, degrees) < confidence:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < confidence else (low, middle)
    return high


@dataclass(frozen=True)
class Space:
    """What all tasks need to project: the dimension, the largest norm, the number of directions and the stopping factor."""

    dimension: int
    largest: float
    directions: int = DIRECTIONS
    confidence: float = CONFIDENCE

    @cached_property
    def stop(self) -> float:
        return quantile(self.confidence, self.directions)

    def gaussians(self) -> np.ndarray:
        return np.random.default_rng(SEED).standard_normal((self.dimension + 1, self.directions))

    def project(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        last = np.sqrt(np.maximum(self.largest**2 - norms**2, 0))
        directions = self.gaussians()
        return vectors @ directions[:-1] + last[:, None] * directions[-1]

    def project_queries(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return (vectors * (self.largest / norms)[:, None]) @ self.gaussians()[:-1]

    def limit(self, products: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Squared projected distance at which the search ends, with the k-th best inner product so far.

        Infinite where there is none yet; a little more than the test says, so that rounding never leaves out a copy.
        """
        distance = 2 * self.largest * (self.largest - products / norms)
        return np.where(np.isneginf(products), np.inf, self.stop * distance + 1e-9 * self.largest**2)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row, always added in the same order, so that equal vectors score the same."""
    return (a * b).sum(axis=1)


# ---- the upper storey: cells ----


@dataclass(frozen=True)
class Cells:
    """Splits of the upper storey, level by level as in a heap: node i has the children 2 i + 1 and 2 i + 2."""

    levels: int
    axes: np.ndarray
    values: np.ndarray

    @staticmethod
    def fit(points: np.ndarray, levels: int) -> Cells:
        axes, values = np.zeros((1 << levels) - 1, np.int64), np.zeros((1 << levels) - 1)
        parts = [points]
        for node in range(len(axes)):
            part = parts[node]
            if len(part):
                axes[node] = np.argmax(part.max(axis=0) - part.min(axis=0))
                values[node] = np.median(part[:, axes[node]])
            right = part[:, axes[node]] > values[node]
            parts += [part[~right], part[right]]
        return Cells(levels, axes, values)

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        for _ in range(self.levels):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axes[node]] > self.values[node])
        return node - len(self.axes)


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every box; a loop over few axes keeps it in memory."""
    total = np.zeros((len(points), len(low)))
    for axis in range(points.shape[1]):
        x = points[:, axis, None]
        total += np.maximum(np.maximum(low[:, axis] - x, x - high[:, axis]), 0) ** 2
    return total


# ---- the lower storey: a kd-tree within a block ----


def leaves_of(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows of each leaf: halves at the median of the widest axis until they are small."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        rows = open_.pop()
        own = points[rows]
        spread = own.max(axis=0) - own.min(axis=0)
        if len(rows) <= size or not spread.any():
            done.append(np.sort(rows))
            continue
        order = np.argsort(own[:, np.argmax(spread)], kind="stable")
        open_ += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return done


@dataclass
class Best:
    """The best rows of each query so far, as flat lists in order of query, falling score and rising row."""

    query: np.ndarray
    score: np.ndarray
    row: np.ndarray

    @staticmethod
    def none() -> Best:
        return Best(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))

    def merged(self, others: list[Best], k: int) -> Best:
        query = np.concatenate([self.query, *[o.query for o in others]])
        score = np.concatenate([self.score, *[o.score for o in others]])
        row = np.concatenate([self.row, *[o.row for o in others]])
        order = np.lexsort((row, -score, query))
        query, score, row = query[order], score[order], row[order]
        kept = place_in_run(query) < k
        return Best(query[kept], score[kept], row[kept])

    def bound(self, queries: int, k: int) -> np.ndarray:
        """The k-th score of each query, minus infinity where there are fewer."""
        bound = np.full(queries, -np.inf)
        last = place_in_run(self.query) == k - 1
        bound[self.query[last]] = self.score[last]
        return bound


def place_in_run(sorted_: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each run of equal values."""
    begins = np.flatnonzero(np.diff(sorted_, prepend=sorted_[:1] - 1)) if len(sorted_) else np.zeros(0, np.int64)
    sizes = np.diff(begins, append=len(sorted_))
    return np.arange(len(sorted_)) - np.repeat(begins, sizes)


class Block:
    """Vectors of one block, equal ones as one, in rising order of their smallest id."""

    def __init__(self, space: Space, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        order = np.lexsort((rows, ids))
        self.ids, self.rows, vectors = ids[order], rows[order], vectors[order] + 0.0  # no negative zeros
        as_bytes = np.ascontiguousarray(vectors).view(f"V{8 * vectors.shape[1]}").ravel()
        _, first, member = np.unique(as_bytes, return_index=True, return_inverse=True)
        rank = np.argsort(np.argsort(first))
        self.vectors = vectors[np.sort(first)]
        self.distinct = rank[member]  # which vector each row has
        self.members = np.argsort(self.distinct, kind="stable")  # by distinct vector, then by id
        self.begins = np.searchsorted(self.distinct[self.members], np.arange(len(first) + 1))
        self.space = space
        points = space.project(self.vectors, np.sqrt(exact(self.vectors, self.vectors)))
        self.leaves = leaves_of(points, LEAF_ROWS)
        self.low = np.array([points[leaf].min(axis=0) for leaf in self.leaves])
        self.high = np.array([points[leaf].max(axis=0) for leaf in self.leaves])

    def search(self, vectors: np.ndarray, norms: np.ndarray, bounds: np.ndarray, k: int) -> Best:
        """The best ``k`` distinct vectors of each query that are not below its bound, leaf by leaf until the test ends it."""
        reach = box_distance(self.space.project_queries(vectors, norms), self.low, self.high)
        turns = np.argsort(reach, axis=1, kind="stable")
        best, everyone, bounds = Best.none(), np.arange(len(vectors)), bounds.copy()
        slack = SLACK * self.space.largest * norms
        for turn in range(len(self.leaves)):
            leaf = turns[everyone, turn]
            going = reach[everyone, leaf] <= self.space.limit(bounds[everyone], norms[everyone])
            everyone, leaf = everyone[going], leaf[going]
            if not len(everyone):
                break
            found = []
            for at in np.unique(leaf):
                asked, rows = everyone[leaf == at], self.leaves[at]
                scores = vectors[asked] @ self.vectors[rows].T
                least = bounds[asked] - slack[asked]
                if len(rows) > k:
                    least = np.maximum(least, np.partition(scores, len(rows) - k, axis=1)[:, len(rows) - k])
                query, hit = np.nonzero(scores >= least[:, None])
                found.append(Best(asked[query], scores[query, hit], rows[hit]))
            best = best.merged(found, k)
            bounds = np.maximum(bounds, best.bound(len(vectors), k))
        return best

    def expanded(self, best: Best, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and place in ``ids`` of the first ``k`` rows that hold each vector found."""
        copies = np.minimum(self.begins[best.row + 1] - self.begins[best.row], k)
        before = np.cumsum(copies) - copies
        place = np.repeat(self.begins[best.row] - before, copies) + np.arange(int(copies.sum()))
        return np.repeat(best.query, copies), self.members[place]


# ---- Spark jobs ----


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``row, id, vector, norm`` of the rows that take part, components as doubles."""
    values = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("id"), values.alias("vector")
    )
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite).withColumn("norm", F.sqrt(squares))
    return rows.where((F.col("norm") > 0) & (F.col("norm") < F.lit(math.inf)))


@dataclass
class Index:
    """Every vector in its block, and where the cells lie."""

    space: Space
    rows: DataFrame  # row, id, vector, norm, block
    low: np.ndarray  # box of each cell that has vectors
    high: np.ndarray
    blocks: np.ndarray  # of each cell
    first: np.ndarray  # block of each cell

    @staticmethod
    def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Index | None:
        """Fit the cells on a sample and put every vector into a block; None without vectors that take part."""
        rows = stage(usable(vectors, id_col, vector_col), "vectors")
        sizes = rows.groupBy(F.size("vector").alias("dimension"))
        counted = sizes.agg(F.count("*").alias("n"), F.max("norm").alias("largest"))
        common = counted.orderBy(F.desc("n"), F.desc("dimension")).first()
        if common is None:
            return None
        space = Space(common.dimension, common.largest)
        rows = rows.where(F.size("vector") == common.dimension)
        block_rows = max(1024, BLOCK_VALUES // common.dimension)
        levels = max(0, math.ceil(math.log2(common.n / block_rows)))
        levels = min(levels, int(math.log2(MAX_CELLS)))

        def project(part: pa.RecordBatch) -> dict:
            points = space.project(matrix(part.column("vector")), part.column("norm").to_numpy())
            return {"point": pa.array(list(points), pa.list_(pa.float64()))}

        lowest = rows.orderBy(F.xxhash64("id", "row"), "row").limit(SAMPLE)
        sample = batches(lowest, {"vector": "vector", "norm": "norm"}, project, "point array<double>").toArrow()
        cells = Cells.fit(matrix(sample.column("point").combine_chunks()), levels)

        def put(part: pa.RecordBatch) -> dict:
            points = space.project(matrix(part.column("vector")), part.column("norm").to_numpy())
            return {
                **{name: part.column(name) for name in ("row", "id", "vector", "norm")},
                "cell": cells.of(points),
                "point": pa.array(list(points), pa.list_(pa.float64())),
            }

        columns = {name: name for name in ("row", "id", "vector", "norm")}
        schema = "row bigint, id bigint, vector array<double>, norm double, cell bigint, point array<double>"
        placed = stage(batches(rows, columns, put, schema), "cells")
        sides = [f(F.get("point", F.lit(i))) for f in (F.min, F.max) for i in range(space.directions)]
        boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.array(*sides).alias("sides"))
        found = boxes.orderBy("cell").collect()  # at most MAX_CELLS
        sides_ = np.array([row.sides for row in found])
        blocks = np.array([math.ceil(row.n / (1.5 * block_rows)) for row in found], np.int64)
        first = np.cumsum(blocks) - blocks
        numbers = rows.sparkSession.createDataFrame(
            [(row.cell, int(b), int(f)) for row, b, f in zip(found, blocks, first, strict=True)],
            "cell bigint, blocks bigint, first bigint",
        )
        block = F.col("first") + F.pmod(F.xxhash64("row"), F.col("blocks"))
        dealt = placed.drop("point").join(F.broadcast(numbers), "cell")  # a row per cell
        dealt = dealt.select("row", "id", "vector", "norm", block.alias("block"))
        half = space.directions
        return Index(space, dealt, sides_[:, :half], sides_[:, half:], blocks, first)

    def nearest(self, queries: DataFrame, k: int) -> DataFrame:
        """``query_row, query_id, rank, id, score``: the ``k`` best rows found for each query, but not its own row.

        ``queries`` are rows of the index. Each round a query goes on to the next nearest blocks, ``GROWTH`` times
        as many as before, as far as the stopping test allows with the best found so far.
        """
        asked = stage(queries.select(F.col("row").alias("query_row"), F.col("id").alias("query_id"), "vector", "norm"), "queries")
        total, seen, until = int(self.blocks.sum()), 0, 1
        best = None
        while seen < total:
            known = asked.withColumn("bound", F.lit(-math.inf))
            if best is not None:
                bounds = best.where(F.col("rank") == k).select("query_row", F.col("score").alias("bound"))
                known = asked.join(bounds, "query_row", "left").withColumn("bound", F.coalesce("bound", F.lit(-math.inf)))
            routed = stage(self.route(known, seen, until), "routed")
            if best is not None and routed.isEmpty():
                break
            more = self.search(routed, k)
            rows = more if best is None else best.select(more.columns).unionByName(more)
            order = W.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
            ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            best = stage(ranked, "nearest")
            seen, until = until, until * GROWTH
        return best.join(asked.select("query_row", "query_id"), "query_row")

    def route(self, queries: DataFrame, seen: int, until: int) -> DataFrame:
        """Each query with one block a row: those in places ``seen`` to ``until`` by distance that are within its reach."""
        space, low, high, blocks, first = self.space, self.low, self.high, self.blocks, self.first

        def run(part: pa.RecordBatch) -> dict:
            vectors, norms = matrix(part.column("vector")), part.column("norm").to_numpy()
            reach = box_distance(space.project_queries(vectors, norms), low, high)
            limit = space.limit(part.column("bound").to_numpy(), norms)
            lists = []
            for own, most in zip(reach, limit, strict=True):
                cells = np.argsort(own, kind="stable")
                cells = cells[own[cells] <= most]
                ends = np.cumsum(blocks[cells])
                last = np.searchsorted(ends, until) + 1
                cells, begins = cells[:last], (ends - blocks[cells])[:last]
                lists.append([
                    int(first[cell]) + i
                    for cell, begin in zip(cells.tolist(), begins.tolist(), strict=True)
                    for i in range(max(0, seen - begin), min(int(blocks[cell]), until - begin))
                ])
            names = ("query_row", "vector", "norm", "bound")
            return {**{name: part.column(name) for name in names}, "blocks": pa.array(lists, pa.list_(pa.int64()))}

        columns = {name: name for name in ("query_row", "vector", "norm", "bound")}
        schema = "query_row bigint, vector array<double>, norm double, bound double, blocks array<bigint>"
        routed = batches(queries, columns, run, schema)
        return routed.withColumn("block", F.explode("blocks")).drop("blocks")

    def search(self, routed: DataFrame, k: int) -> DataFrame:
        """``query_row, row, id, score``: up to ``k`` rows of each block for each query sent there.

        A block meets its queries in chunks of bounded size, so neither a popular block nor many queries make a large task.
        """
        space = self.space
        chunks = stage(routed.groupBy("block").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "chunks")
        own = chunks.select(F.col("block").alias("_block"), F.col("chunks").alias("_chunks"))
        points = self.rows.join(own, F.col("block") == F.col("_block")).drop("_block")
        points = points.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
        asked = routed.join(chunks, "block").withColumn("chunk", F.pmod(F.xxhash64("query_row"), F.col("chunks"))).drop("chunks")

        def run(points: pa.Table, asked: pa.Table) -> pa.Table:
            if not points.num_rows or not asked.num_rows:
                return pa.Table.from_pylist([], FOUND_FIELDS)
            block = Block(
                space,
                matrix(points.column("vector").combine_chunks()),
                points.column("id").to_numpy(),
                points.column("row").to_numpy(),
            )
            own_rows, bounds = asked.column("query_row").to_numpy(), asked.column("bound").to_numpy()
            vectors = matrix(asked.column("vector").combine_chunks())
            found = block.search(vectors, asked.column("norm").to_numpy(), bounds, k + SPARE)
            query, place = block.expanded(found, k + 1)
            other = block.rows[place] != own_rows[query]
            query, place = query[other], place[other]
            score = exact(vectors[query], block.vectors[block.distinct[place]])
            near = score >= bounds[query]
            best = Best(query[near], score[near], place[near]).merged([], k)
            return pa.Table.from_pydict(
                {
                    "query_row": own_rows[best.query],
                    "row": block.rows[best.row],
                    "id": block.ids[best.row],
                    "score": best.score,
                },
                FOUND_FIELDS,
            )

        both = points.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk"))
        return both.applyInArrow(run, "query_row bigint, row bigint, id bigint, score double")


def nearest(
    vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` the ``k`` rows of largest inner product.

    A query's own row is no candidate; all others are, also of the same id. Fewer rows come where there are fewer candidates.
    Nearest first, ties by smaller id. Rows with a NULL id or vector, a NULL or non-finite component, no component, no length
    or one that overflows take no part, nor do those of another dimension than most (of several, the largest).
    """
    spark = vectors.sparkSession
    index = Index.build(vectors, id_col, vector_col)
    if index is None:
        return spark.createDataFrame([], RESULT)
    found = index.nearest(index.rows.where(F.col("id") % every == 0), k)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
