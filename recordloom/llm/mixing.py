"""Mixing sources to target weights.

Sources get shares of the words in the table by weight; no source is repeated
more than ``most`` times, and what it cannot take goes to the others. Within a
source, whole epochs come first; the rest is a weighted sample without
replacement (Efraimidis-Spirakis): every document draws an exponential key
divided by its quality weight, and documents are taken in key order until the
running sum of their sizes reaches the rest.

The running sum never sorts a source in one task. Keys are mapped to a fixed grid
of cells in key order, even in the logarithm of the key: whatever the weights are, a
cell is expected to hold at most a hundred-thousandth of a source. Only the documents of
the one cell the budget ends in are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.llm.texts import stage

DIGITS = 13  # hexadecimal digits of the hash, 52 bits: exact in a double
CELLS = 1024  # cells per level; two levels
LEAST_QUALITY = 0.01
LEAST_KEY = 2.0**-26  # the first cell has all smaller keys
MOST_KEY = 4 * DIGITS * math.log(2) / LEAST_QUALITY


def uniform(id_col: str, seed: int) -> Column:
    """A number in (0, 1] that depends on the id and the seed only."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    head = F.conv(F.substring(F.md5(name), 1, DIGITS), 16, 10).cast("bigint")
    return (head + 1) / F.lit(float(16**DIGITS))


def mix(
    docs: DataFrame,
    size: Column,
    quality: Column,
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    share: float = 1.0,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """How often the mix takes every document.

    Returns ``doc_id, source, size, source_size, target, copies, taken``: one row per
    input row; ``copies`` counts whole epochs plus one if the sample has it, and
    ``taken`` is ``copies * size``. Sources in code point order, NULL last, take
    ``weights`` in turn. A document is in the sample if at least half of it lies within
    the budget, so each source ends within half a document of its target.

    A NULL or negative size counts as 0, a quality that is NULL or below
    0.01 as 0.01, and one above 1 as 1. Rows with equal ids draw equal keys and are told apart
    by size. Documents without words cost nothing and are never repeated. An empty
    table gives an empty mix.
    """
    drawn = draws(size, quality, seed, id_col, source_col)
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        *[column.alias(name) for name, column in drawn.items()],
        F.monotonically_increasing_id().alias("row"),
    )
    rows, plan = planned(narrow, weights, most, share)
    return select(rows, plan)


def draws(size: Column, quality: Column, seed: int, id_col: str, source_col: str) -> dict[str, Column]:
    """What the mix needs of a document: where its source stands, its size and its key."""
    weight = F.greatest(F.least(F.coalesce(quality.cast("double"), F.lit(0.0)), F.lit(1.0)), F.lit(LEAST_QUALITY))
    return {
        "place": F.coalesce(F.concat(F.lit("0"), F.col(f"`{source_col}`")), F.lit("1")),
        "size": F.greatest(F.coalesce(size.cast("bigint"), F.lit(0)), F.lit(0)),
        "key": -F.log(uniform(id_col, seed)) / weight,
    }


def cell_of(key: str) -> Column:
    height = F.log(F.greatest(F.col(key), F.lit(LEAST_KEY)) / F.lit(LEAST_KEY)) / F.lit(math.log(MOST_KEY / LEAST_KEY))
    return F.floor(F.least(height, F.lit(1.0)) * (CELLS * CELLS)).cast("int")


def planned(
    narrow: DataFrame, weights: Sequence[int], most: int, share: float
) -> tuple[DataFrame, DataFrame]:
    """The rows with their cells, and per source its budget and the cell it ends in; both staged."""
    rows = stage(narrow.withColumn("cell", cell_of("key")), "mix-rows")
    plan = stage(budgets(rows, list(weights), most, share), "mix-plan")
    for level in (CELLS, 1):
        plan = stage(refine(rows, plan, level), "mix-plan")
    return rows, plan


def budgets(rows: DataFrame, weights: list[int], most: int, share: float) -> DataFrame:
    """One row per source: its size, target, whole epochs and what is left for the sample.

    The targets solve ``sum(min(most * size, level * weight)) = total``. Sources are passed in the order in which they
    fill up; the first that does not fill fixes the level.
    """
    sources = rows.groupBy("place").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy("place")) - 1) % len(weights) + 1
    limit = F.col("source_size") * most
    filling = W.orderBy(limit / F.col("weight"), "place")
    everything = W.partitionBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(
        F.sum(limit).over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    weight_left = F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    ranked = (
        sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int")))
        .withColumn("left", left)
        .withColumn("weight_left", weight_left)
        .withColumn("open", limit * F.col("weight_left") >= F.col("left") * F.col("weight"))
        .withColumn("step", F.when(F.col("open"), F.row_number().over(filling)))
    )
    level = F.min(F.when(F.col("open"), F.struct("step", "left", "weight_left"))).over(everything)
    target = F.coalesce(
        F.when(F.col("step").isNull(), F.lit(None)).otherwise(
            F.col("weight") * F.col("level.left") / F.col("level.weight_left")
        ),
        limit.cast("double"),
    )
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most)))
    return (
        ranked.withColumn("level", level)
        .withColumn("target", F.least(target, limit.cast("double")))
        .withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("bigint"))
        .select(
            "place",
            "source_size",
            "target",
            "epochs",
            (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"),
            F.lit(0).alias("cell_from"),
            F.lit(CELLS * CELLS + 1).alias("cell_to"),
            F.lit(0).cast("bigint").alias("before"),
        )
    )


def refine(rows: DataFrame, plan: DataFrame, width: int) -> DataFrame:
    """Narrow ``[cell_from, cell_to)``, the cells in which the budget of a source ends, to one of ``width`` cells.

    ``before`` is what all earlier cells hold. If the budget lasts for all documents, the range stays empty.
    """
    inside = rows.join(plan, "place").where("cell >= cell_from and cell < cell_to")
    held = inside.groupBy("place", F.floor(F.col("cell") / width).cast("int").alias("part")).agg(
        F.sum("size").alias("held")
    )
    running = F.sum("held").over(W.partitionBy("place").orderBy("part"))
    summed = held.withColumn("until", running).join(plan.select("place", "rest", F.col("before").alias("start")), "place")
    ends = (
        summed.where("start + until > rest")
        .groupBy("place")
        .agg(F.min(F.struct("part", "until", "held")).alias("end"))
        .select(
            "place",
            (F.col("end.part") * width).alias("new_from"),
            ((F.col("end.part") + 1) * width).alias("new_to"),
            (F.col("end.until") - F.col("end.held")).alias("passed"),
        )
    )
    none = CELLS * CELLS + 1
    return plan.join(ends, "place", "left").select(
        "place",
        "source_size",
        "target",
        "epochs",
        "rest",
        F.coalesce("new_from", F.lit(none)).alias("cell_from"),
        F.coalesce("new_to", F.lit(none)).alias("cell_to"),
        (F.col("before") + F.coalesce("passed", F.lit(0))).alias("before"),
    )


SALTS = 1024


def last_cells(known: DataFrame) -> DataFrame:
    """``place, doc_id, size, rows, chosen`` of the cells in which budgets end: how many of the rows the sample has room for.

    Rows of one id, size and key are counted together, so their number, as many as it may be, is one row of the sort.
    """
    inside = known.where(F.col("cell").between(F.col("cell_from"), F.col("cell_to") - 1))
    alike = inside.groupBy("place", "key", "doc_id", "size", "before", "rest").agg(F.count("*").alias("rows"))
    order = W.partitionBy("place").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
    mass = F.col("rows") * F.col("size")
    until = F.col("before") + F.sum(mass).over(order.rowsBetween(W.unboundedPreceding, 0))
    summed = alike.withColumn("until", until).withColumn("start", F.col("until") - mass)
    all_fit = 2 * F.col("until") - F.col("size") <= 2 * F.col("rest")
    some = F.floor((2 * F.col("rest") - 2 * F.col("start") + F.col("size")) / (2 * F.greatest("size", F.lit(1))))
    part = F.least(F.greatest(some, F.lit(0)), F.col("rows") - 1)
    chosen = F.when(all_fit, F.col("rows")).when(F.col("size") > 0, part).otherwise(0).cast("bigint")
    counted = summed.withColumn("chosen", chosen).groupBy("place", "doc_id", "size")
    return counted.agg(F.sum("rows").alias("rows"), F.sum("chosen").alias("chosen"))


def with_extra(rows: DataFrame, decided: DataFrame, place: str, id_col: str, size: str, salt: Column) -> DataFrame:
    """``rows`` of the last cells with ``_extra``: 1 for as many rows of each id and size as ``decided`` has chosen.

    Nearly always all or none are; where it is some, rows are numbered within ``salt``s, so that one id may have any number of rows.
    """
    listed = decided.select(
        F.col("place").alias("_place"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"),
        F.col("rows").alias("_rows"), F.col("chosen").alias("_chosen"), F.monotonically_increasing_id().alias("_group"),
    )
    listed = stage(listed, "mix-decided")
    same = (F.col(place) == F.col("_place")) & F.col(id_col).eqNullSafe(F.col("_id")) & (F.col(size) == F.col("_size"))
    columns = rows.columns
    known = rows.join(listed, same)
    clear = known.where("_chosen = 0 or _chosen = _rows").withColumn("_extra", (F.col("_chosen") > 0).cast("int"))
    clear = clear.select(*columns, "_extra")
    if listed.where("_chosen > 0 and _chosen < _rows").isEmpty():
        return clear
    some = known.where("_chosen > 0 and _chosen < _rows").withColumn("_salt", salt)
    counts = some.groupBy("_group", "_salt").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy("_group").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        F.col("_group").alias("_of"), F.col("_salt").alias("_in"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    starts = stage(starts, "mix-turns")
    turn = F.row_number().over(W.partitionBy("_group", "_salt").orderBy(F.lit(0)))
    numbered = some.withColumn("_turn", turn).join(starts, (F.col("_group") == F.col("_of")) & (F.col("_salt") == F.col("_in")))
    extra = (F.col("_start") + F.col("_turn") <= F.col("_chosen")).cast("int")
    return clear.unionByName(numbered.withColumn("_extra", extra).select(*columns, "_extra"))


def select(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Epochs plus sample for every row; only rows of the last cells are sorted."""
    known = rows.join(plan, "place")
    before = F.col("cell") < F.col("cell_from")
    clear = known.where(before | (F.col("cell") >= F.col("cell_to"))).withColumn("_extra", before.cast("int"))
    inside = known.where(F.col("cell").between(F.col("cell_from"), F.col("cell_to") - 1))
    last = with_extra(inside, last_cells(known), "place", "doc_id", "size", F.pmod(F.col("row"), F.lit(SALTS)))
    both = clear.unionByName(last)
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.col("_extra")).otherwise(F.lit(1).cast("bigint"))
    return both.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def repeat(
    docs: DataFrame,
    size: Column,
    quality: Column,
    weights: Sequence[int] = (5, 2, 1),
    most: int = 3,
    share: float = 1.0,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as ``mix`` takes them, with their own columns.

    A document's cell and its source's budget tell how often it is taken, so texts stay where they are: joined are one row per
    source, and what was decided for the few documents of the cells in which budgets end. Rows that repeat an id, also
    NULL, are taken each for itself, none more than ``most`` times; of such rows of one size any may be the sampled ones.
    """
    drawn = draws(size, quality, seed, id_col, source_col)
    wide = docs.withColumns({f"_mix_{name}": column for name, column in drawn.items()})
    narrow = wide.select(F.col(f"`{id_col}`").alias("doc_id"), *[F.col(f"_mix_{name}").alias(name) for name in drawn])
    rows, plan = planned(narrow, weights, most, share)
    budget = plan.select("place", "epochs", "cell_from", "cell_to")
    budget = budget.select(*[F.col(c).alias(f"_mix_{c}") for c in budget.columns])
    known = wide.withColumn("_mix_cell", cell_of("_mix_key"))
    known = known.join(budget.withColumnRenamed("_mix_place", "_mix_of"), F.col("_mix_place") == F.col("_mix_of"))
    inside = (F.col("_mix_cell") >= F.col("_mix_cell_from")) & (F.col("_mix_cell") < F.col("_mix_cell_to"))
    clear = known.where(~inside).withColumn("_extra", (F.col("_mix_cell") < F.col("_mix_cell_from")).cast("int"))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(SALTS))
    decided = last_cells(rows.join(plan, "place"))
    both = clear.unionByName(with_extra(known.where(inside), decided, "_mix_place", id_col, "_mix_size", salt))
    times = F.when(F.col("_mix_size") > 0, F.col("_mix_epochs") + F.col("_extra")).otherwise(1).cast("int")
    spread = both.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(0), times)))
    return spread.select(*[F.col(f"`{c}`") for c in docs.columns])
