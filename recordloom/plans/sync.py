"""Runs: every entity of a family from landed pages into tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from recordloom.operators.catalogue import Merged, stage_records
from recordloom.operators.fanout import Records, normalise, positioned
from recordloom.session import configure, sized_shuffles, stage, staged_until_done
from recordloom.sinks.store import TableStore, Version
from recordloom.sources.entities import Collection, Entity, Family
from recordloom.sources.pages import Unread, decode, read_packed_pages, read_page_files, scan_staged

COMMITTED, MISSING, FAILED = "committed", "missing", "failed"


class SyncFailed(RuntimeError):
    """A run stopped at an entity; the cause is attached."""


# `page, pos, v` records, what is known of their schema, and pages not read; None if not there
Source = Callable[[Entity], tuple[DataFrame, Merged | None, Unread] | None]


def landed(spark: SparkSession, root: str, family: Family, packed: bool = True) -> Source:
    """Reads ``<root>/entity=<collection>``, staged as VARIANT.

    The folder holds the pages of one landing, or several landings in folders ``run_id=<n>``.
    """
    read = read_packed_pages if packed else read_page_files

    def source(entity: Entity):
        pages = read(spark, f"{root}/entity={entity.collection}")
        return None if pages is None else scan_staged(decode(pages, family.paging, entity.collection, family.page_size))

    return source


def given(frames: dict[str, DataFrame], shredded: bool = True) -> Source:
    """Records already at hand, by parent table name; staged when first used, ``shredded`` unless their lists are irregular."""

    def source(entity: Entity):
        frame = frames.get(entity.table)
        return None if frame is None else (*stage_records(frame, entity.table, shredded), Unread())

    return source


def sync(store: TableStore, family: Family, source: Source, at_once: int = 4) -> int:
    """One run over all entities in declared order; returns the run number.

    An entity is committed when all its tables are written. A missing collection
    is recorded and skipped. Any failure is recorded and raised: entities before
    it stay committed, those after it are not started. The tables of one entity
    are independent jobs and run ``at_once`` side by side.
    """
    configure(store.spark)
    run = store.next_run()
    versions = store.versions()
    for position, entity in enumerate(family.entities):
        head = {"run": run, "position": position, "family": family.name, "entity": entity.table}
        with staged_until_done(store.spark):
            try:
                found = source(entity)
                if found is None:
                    entries = [{**head, "table_name": entity.table, "status": MISSING}]
                else:
                    entries = sync_entity(store, family, entity, *found, run, versions, head, at_once)
            except Exception as error:
                note = f"{type(error).__name__}: {error}"
                store.commit([{**head, "table_name": entity.table, "status": FAILED, "error": note}])
                raise SyncFailed(entity.table) from error
            store.commit(entries)
    return run


def sync_entity(
    store: TableStore,
    family: Family,
    entity: Entity,
    records: DataFrame,
    merged: Merged | None,
    unread: Unread,
    run: int,
    versions: dict[tuple[str, str], Version],
    head: dict,
    at_once: int = 4,
    beside: dict | None = None,
) -> list[dict]:
    """Write all tables of one entity and return their commit entries; the parent's gets what is ``beside``."""
    numbered = "run_id" in records.columns
    fixed = entity.requested_columns()
    keeps = entity.keeps if fixed or not family.filtered else None
    tables = list(normalise(positioned(records, run), entity, family.dialect, keeps, merged))
    by_name = {table.table: table for table in tables}
    wrong = {}
    for owner, collection in owned_lists(entity):
        odd = by_name[owner].wrong_lists(collection)
        if odd is not None:
            wrong[collection.table] = stage(odd, "odd")

    def write(table: Records) -> dict:
        name, tally = table.table, table.tally
        folders, odd = [], wrong.get(name)
        if tally.quarantined:
            folders.append(store.quarantine(family.name, name, table.quarantine(), run))
        if odd is not None:
            folders.append(store.quarantine(family.name, name, odd, run))
        current = versions.get((family.name, name))
        if tally.keyed:
            columns = table.columns(True, fixed, current.labels if current else None)
            rows, names = table.rows(columns=columns), {column.name: column.label for column in columns}
            result = store.write(family.name, name, rows, run, current, table.keys(), numbered, names)
        else:
            result = store.keep(current)
        counts = {
            "upserts": tally.keyed,
            "quarantined": tally.quarantined + (0 if odd is None else odd.count()),
            "quarantine": json.dumps(folders) if folders else None,
            "collisions": len(table.catalogue.collisions()),
        }
        if name == entity.table:
            counts |= {"unread_pages": unread.pages, "unread_from": unread.first, **(beside or {})}
            if unread.rows is not None:
                counts["unread"] = store.put("unread", family.name, name, unread.rows, run)
        return {**head, "table_name": name, "status": COMMITTED, **counts, **result}

    stored = sum(versions[key].size for name in entity.tables() if (key := (family.name, name)) in versions)
    with sized_shuffles(records, more=stored), ThreadPoolExecutor(at_once) as pool:
        target = inheritable_thread_target(store.spark)(write)
        contexts = [copy_context() for _ in tables]
        return list(pool.map(lambda context, table: context.run(target, table), contexts, tables))


def owned_lists(entity: Entity) -> list[tuple[str, Collection]]:
    """Every declared list with the table of the records it lies in."""
    found: list[tuple[str, Collection]] = []

    def visit(owner: str, collections: tuple[Collection, ...]) -> None:
        for collection in collections:
            found.append((owner, collection))
            visit(collection.table, collection.children)

    visit(entity.table, entity.children)
    return found
