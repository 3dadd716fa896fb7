"""Scheduled runs as streams."""

import json

from recordloom.sinks.store import TableStore
from recordloom.sources.families import BUSINESS, PROJECTS
from recordloom.streaming.ingest import ingest, page_file_stream, page_stream
from tests.conftest import as_dicts


def land(folder, number, body):
    folder.mkdir(exist_ok=True)
    (folder / f"{number}.json").write_text(json.dumps(body))


def test_each_page_file_is_read_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    folder, entity = tmp_path / "pages", BUSINESS.entity("bill")

    def scheduled():
        stream = page_file_stream(spark, str(folder))
        ingest(stream, store, BUSINESS, entity, str(tmp_path / "checkpoint")).awaitTermination()

    land(folder, 0, [{"id": 1, "Amount": {"value": 10}, "Details": [{"id": 11}]}])
    scheduled()
    land(folder, 1, {"value": [{"id": 1, "Amount": {"value": 20}}, {"id": 2, "Details": [{"id": 21}]}]})
    scheduled()
    scheduled()
    bills = as_dicts(store.table("bill").drop("_synced_at"), "id")
    assert [(r["id"], r["amount"]) for r in bills] == [(1, 20), (2, None)]
    assert [r["id"] for r in as_dicts(store.table("bill_detail"), "id")] == [11, 21]
    assert store.commits().select("run").distinct().count() == 2


def test_stream_gives_the_batch_result(spark, tmp_path):
    bodies = [
        {"organization": {"jobs": {"nodes": [{"id": f"{n}-{i}", "name": f"job {i}"} for i in range(3)], "nextPage": str(n)}}}
        for n in range(3)
    ]
    pages = spark.createDataFrame([(n, json.dumps(b)) for n, b in enumerate(bodies)], "page bigint, body string")
    pages.repartition(3).write.parquet(str(tmp_path / "pages"))
    store = TableStore(spark, str(tmp_path / "store"))
    stream = page_stream(spark, str(tmp_path / "pages"))
    ingest(stream, store, PROJECTS, PROJECTS.entity("job"), str(tmp_path / "checkpoint")).awaitTermination()
    jobs = store.table("job")
    assert jobs.count() == 9
    assert [c for c in jobs.columns if c != "_synced_at"] == [
        "id", "name", "number", "status", "description", "created_at", "closed_on",
        "organization_id", "organization_name", "location_id", "location_name",
    ]
