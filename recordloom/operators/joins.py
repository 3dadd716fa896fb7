"""Joins on the lineage and business keys of normalised tables.

Both stream the many side and look up the one side by its unique key. A hot
key piles up rows on the many side only, and that side may be split: Spark does
so at run time for inner and for left joins (adaptive skew join), and it
broadcasts the lookup only below its own size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.upsert import latest, with_key


def line_to_order(
    lines: DataFrame, orders: DataFrame, line_key: str, order_key: str, newest: list[str] | None = None
) -> DataFrame:
    """Every line with the order it came from, NULL where it has none.

    With ``newest``, the columns that order an order's repeats, only its last row counts and these
    columns are dropped; without, ``orders`` must hold each key once. Lines without a key match
    nothing and go around the join, as they would all meet in one task.
    """
    if newest is not None:
        orders = latest(with_key(orders, [order_key]), [order_key], newest).drop(*newest)
    keyed = lines.filter(lines[line_key].isNotNull())
    joined = keyed.join(orders, keyed[line_key] == orders[order_key], "left")
    return joined.unionByName(lines.filter(lines[line_key].isNull()), allowMissingColumns=True)


def child_to_parent(
    children: DataFrame, parents: DataFrame, child_key: str = "parent_id", parent_key: str = "id"
) -> DataFrame:
    """Children with their parent's columns, which get a ``parent_`` prefix."""
    named = parents.select(
        *[F.col(c).alias(child_key if c == parent_key else f"parent_{c}") for c in parents.columns]
    )
    return children.join(named, child_key)
