"""Reports on tables and runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.access import Whole
from recordloom.operators.catalogue import WRAPPED, Merged, discover
from recordloom.operators.drift import align
from recordloom.operators.fanout import Survey, survey
from recordloom.sources.entities import Entity


def count_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count`` of each table; only counts leave a task."""
    counts = [
        table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def freshness(table: DataFrame, synced_at: str = "_synced_at") -> DataFrame:
    return table.agg(F.max(synced_at).alias("last_synced"))


def inventory(tables: dict[tuple[str, str], DataFrame], synced_at: str = "_synced_at") -> DataFrame:
    """Row count and last change of each ``(schema, name)`` table, in name order."""
    parts = [
        table.agg(F.count("*").alias("row_count"), F.max(synced_at).alias("last_altered")).select(
            F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"), "row_count", "last_altered"
        )
        for (schema, name), table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_schema", "table_name")


def changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, change_kind`` between two states of a table.

    Rows are reduced to key and hash before the shuffle. Both sides are aligned
    first, so a new column that is NULL is no change.
    """
    old, new = align(old, new)  # only keys and hashes move, 16 bytes and the key a row
    data = [c for c in old.columns if c not in keys]

    def hashed(table: DataFrame, name: str) -> DataFrame:
        present = [F.when(F.col(c).isNull(), F.lit("n")).otherwise(F.lit("v")) for c in data]
        return table.select(*keys, F.xxhash64(*data, *present).alias(name))

    kind = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "absent")
        .when(F.col("_old") == F.col("_new"), "same")
        .otherwise("changed")
    )
    joined = hashed(old, "_old").join(hashed(new, "_new"), keys, "full")
    return joined.select(*keys, kind.alias("change_kind"))


def change_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return changes(old, new, keys).groupBy("change_kind").agg(F.count("*").alias("row_count"))


OPERATIONS = ("upserts", "updates", "deletes", "truncates", "schema_changes", "checkpoints")


def operation_summary(commits: DataFrame) -> DataFrame:
    """``operation, operations`` of the runs in a commit log.

    Rows are only ever upserted, so updates, deletes and truncates stay zero. Every entity scanned is a
    checkpoint, one whose collection is missing too.
    """
    zero = F.lit(0).cast("bigint")
    done = commits.filter("status IN ('committed', 'missing')")
    sums = done.agg(
        F.coalesce(F.sum("upserts"), zero).alias("upserts"),
        zero.alias("updates"),
        zero.alias("deletes"),
        zero.alias("truncates"),
        F.coalesce(F.sum("schema_changes"), zero).alias("schema_changes"),
        F.count_distinct("run", "family", "entity").alias("checkpoints"),
    )
    return sums.unpivot([], list(OPERATIONS), "operation", "operations")


def entity_profile(
    records: DataFrame, entity: Entity, dialect: str = WRAPPED, merged: Merged | None = None
) -> DataFrame:
    """Records with a key, child elements and flat columns of one entity, in one row."""
    known = survey(records, entity, dialect, merged)
    record = Whole(F.col("v"))
    catalogue = discover(
        lambda wants: (records, record), dialect, known.merged.schema, null_lists=known.null_lists[entity.table]
    )
    tallies = [known.tallies[collection.table] for collection in entity.children]
    own = known.tallies[entity.table]
    return records.sparkSession.range(1).select(
        F.lit(entity.table).alias("entity"),
        F.lit("ok" if own.total else "empty").alias("status"),
        F.lit(own.keyed).cast("bigint").alias("row_count"),
        F.lit(sum(t.total for t in tallies)).cast("bigint").alias("child_count"),
        F.lit(len(catalogue.columns())).alias("column_count"),
    )


def sync_counts(known: Survey) -> list[tuple[str, int]]:
    """``table, rows`` a run emits, parents first."""
    return [(table, tally.keyed) for table, tally in known.tallies.items()]
