"""Keyed, non-deleting upsert.

A table holds one row per key. New rows replace old ones whole: a column the new
row lacks becomes NULL. Rows the source no longer has stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from recordloom.operators.drift import align, widened
from recordloom.session import stage


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in ``order``.

    Spark turns the rank filter into a group limit before the shuffle, so each
    task sends at most one row per key, however often one key repeats.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def with_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.dropna("any", subset=keys)


def without_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that cannot be upserted."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return rows.filter(missing)


def upsert(
    existing: DataFrame | None,
    batch: DataFrame,
    keys: list[str],
    order: list[str],
    staged: bool = False,
    batch_keys: DataFrame | None = None,
) -> DataFrame:
    """``existing`` with the latest ``batch`` row of every key put in.

    Only keys are compared: existing rows are read once and not shuffled by this
    operator unless Spark finds the list of untouched keys too big to broadcast.
    ``staged`` writes that list out first, which gives Spark its true size (in
    a full refresh it holds just the keys gone from the source). ``batch_keys``
    are the keys of ``batch`` if they can be read for less than its rows.
    """
    fresh = latest(with_key(batch, keys), keys, order).drop(*order)
    if existing is None:
        return fresh
    batch_keys = batch.select(*keys) if batch_keys is None else batch_keys
    touched = with_key(batch_keys, keys).distinct()
    if not staged:
        old, new = align(existing, fresh)
        return old.join(_like(touched, old, keys), keys, "left_anti").select(old.columns).unionByName(new)
    known = existing.select(*keys)
    common, touched = align(known, touched)
    untouched = stage(common.join(touched, keys, "left_anti"), "untouched")
    old, new = align(existing, fresh)
    kept = old.join(_like(untouched, old, keys), keys, "left_semi").select(old.columns)
    return kept.unionByName(new)


def _like(key_rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """Key rows with the key types of ``table``."""
    types = {k: (key_rows.schema[k].dataType.simpleString(), table.schema[k].dataType.simpleString()) for k in keys}
    return key_rows.select(*[widened(F.col(k), *types[k]).alias(k) for k in keys])
