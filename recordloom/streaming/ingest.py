"""Scheduled runs over newly landed pages with Structured Streaming.

The file source remembers which page files it has read, so each run takes the
new ones only. Every micro-batch is one run of the upsert; with the default
``availableNow`` trigger all waiting files form one batch. Landings lie in folders ``run_id=<n>``. Each is a scan of its own, up
to where a page-by-page reader would stop, however many triggers its pages take to arrive: pages past one that is
still missing wait in the store, in a version the commit names beside how far each landing was read, and
later triggers go on from there. Rows of a later landing win, also over those of an older one that comes after it. Without
such folders every file is a page of the same landing and is read. A batch replayed after a failure finds its pages read or
waiting already; what the failed attempt left is named by no commit and not seen.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordloom.operators.catalogue import stage_records
from recordloom.plans.sync import COMMITTED, sync_entity
from recordloom.session import configure, staged_until_done
from recordloom.sinks.store import TableStore
from recordloom.sources.entities import Entity, Family
from recordloom.sources.pages import PACKED_SCHEMA, Unread, continue_scan, decode, run_id, whole_pages

PENDING = "run_id bigint, page bigint, body string"
PROGRESS = "run_id bigint, next bigint, ended boolean"
LANDINGS = "_landings"  # marks pages that belong to numbered landings


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    """Packed pages landing in ``path``."""
    return spark.readStream.schema(PACKED_SCHEMA).parquet(path)


def landing_stream(spark: SparkSession, path: str) -> DataFrame:
    """Packed pages landing in folders ``run_id=<n>`` of ``path``, each landing in one trigger or in several."""
    return page_stream(spark, path).withColumn(LANDINGS, F.lit(True))


def page_file_stream(spark: SparkSession, path: str) -> DataFrame:
    """Pages landing in ``path`` one file each."""
    return whole_pages(spark.readStream.text(path, wholetext=True))


def ingest(
    pages: DataFrame, store: TableStore, family: Family, entity: Entity, checkpoint: str
) -> StreamingQuery:
    """Upsert one entity's tables from a stream of pages; returns the started query."""
    configure(store.spark)

    def decoded(raw: DataFrame) -> DataFrame:
        return decode(raw, family.paging, entity.collection, family.page_size)

    def take(batch: DataFrame, batch_id: int) -> None:
        with staged_until_done(store.spark):
            run, versions = store.next_run(), store.versions()
            head = {"run": run, "position": 0, "family": family.name, "entity": entity.table}
            if LANDINGS not in batch.columns:
                exploded = decoded(batch).select("run_id", "page", F.posexplode("items").alias("pos", "v"))
                records, merged = stage_records(exploded, entity.table)
                store.commit(sync_entity(store, family, entity, records, merged, Unread(), run, versions, head))
                return
            before = store.landings(family.name, entity.table)
            fresh = batch.select(run_id(batch), "page", "body")
            waiting = store.get(before["pending"], PENDING) if "pending" in before else None
            raw = fresh if waiting is None else fresh.unionByName(waiting)
            progress = store.get(before["progress"], PROGRESS) if "progress" in before else None
            found = continue_scan(raw, progress, decoded)
            frames = {"pending": found.pending, "progress": found.progress}
            folders = {kind: store.put(kind, family.name, entity.table, rows, run) for kind, rows in frames.items()}
            state = {"landings": json.dumps(folders)}
            if found.records.isEmpty():  # nothing but pages that wait, or that no scan reaches
                entry = {**head, "table_name": entity.table, "status": COMMITTED, "upserts": 0, "quarantined": 0, **state}
                unread = {"unread_pages": found.unread.pages, "unread_from": found.unread.first}
                if found.unread.rows is not None:
                    unread["unread"] = store.put("unread", family.name, entity.table, found.unread.rows, run)
                store.commit([{**entry, **unread, **store.keep(versions.get((family.name, entity.table)))}])
                return
            todo = found.records, found.merged, found.unread, run, versions, head
            store.commit(sync_entity(store, family, entity, *todo, beside=state))

    return (
        pages.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(take)
        .start()
    )
