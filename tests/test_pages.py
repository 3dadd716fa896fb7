"""Landed pages (ids as in FIXTURES.md)."""

import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from recordloom.plans.sync import landed
from recordloom.sources import pages
from recordloom.sources.families import BUSINESS
from recordloom.sources.pages import (
    decode,
    head,
    numbered,
    page_lists,
    read_page_files,
    scan_staged,
    write_packed_pages,
)
from recordloom.sources.pages import scan as scan_pages


def records(first, count):
    return [{"id": first + i} for i in range(count)]


def scan(spark, bodies, paging="offset", collection=None, staged=False, numbers=None):
    numbers = numbers or range(len(bodies))
    rows = [(n, b if isinstance(b, str) else json.dumps(b)) for n, b in zip(numbers, bodies)]
    pages = spark.createDataFrame(rows, "page bigint, body string")
    decoded = decode(pages, paging, collection)
    out = scan_staged(decoded)[0] if staged else scan_pages(decoded)
    ids = out.select("page", "pos", F.variant_get("v", "$.id", "bigint")).orderBy("page", "pos")
    return [r[2] for r in ids.collect()]


@pytest.mark.parametrize("staged", [False, True])
class TestOffset:
    def test_list_and_envelope(self, spark, staged):  # G1, G2
        assert scan(spark, [records(0, 2)], staged=staged) == [0, 1]
        assert scan(spark, [{"value": records(0, 2)}], staged=staged) == [0, 1]

    def test_any_other_body_ends_the_scan(self, spark, staged):  # G3
        for body in ({"message": "x"}, "5", '"text"', "null", {"value": None}):
            bodies = [records(0, 100), body, records(200, 100)]
            assert scan(spark, bodies, staged=staged) == list(range(100))

    def test_short_page_is_the_last(self, spark, staged):  # G4, G6
        full = [records(0, 100), {"value": records(100, 100)}, records(200, 37)]
        assert len(scan(spark, full, staged=staged)) == 237
        early = [records(0, 100), records(100, 50), records(200, 100)]
        assert scan(spark, early, staged=staged) == list(range(150))

    def test_empty_page_ends_the_scan(self, spark, staged):  # G5
        assert len(scan(spark, [records(0, 100), records(100, 100), []], staged=staged)) == 200
        assert scan(spark, [[], records(0, 100)], staged=staged) == []

    def test_gap_ends_the_scan(self, spark, staged):
        full = [records(100 * i, 100) for i in range(3)]
        assert len(scan(spark, full, staged=staged, numbers=[0, 1, 3])) == 200
        assert scan(spark, full, staged=staged, numbers=[1, 2, 3]) == []


def cursor_page(nodes, following):
    return {"organization": {"jobs": {"nodes": nodes, "nextPage": following}}}


class TestCursor:
    def test_follows_until_null(self, spark):  # G8
        bodies = [cursor_page(records(0, 2), "c1"), cursor_page(records(2, 1), None), cursor_page(records(9, 1), None)]
        assert scan(spark, bodies, "cursor", "jobs") == [0, 1, 2]

    def test_empty_nodes_end_the_scan(self, spark):  # G9
        bodies = [cursor_page(records(0, 1), "c1"), cursor_page([], "c2"), cursor_page(records(5, 1), None)]
        assert scan(spark, bodies, "cursor", "jobs") == [0]

    def test_missing_levels(self, spark):  # G10
        bodies = ({"organization": None}, {}, {"organization": {"jobs": None}}, cursor_page(None, None))
        for body in bodies:
            assert scan(spark, [body], "cursor", "jobs") == []

    def test_falsy_cursors(self, spark):
        for following in ("", 0, False, {}, []):
            bodies = [cursor_page(records(0, 1), following), cursor_page(records(1, 1), None)]
            assert scan(spark, bodies, "cursor", "jobs") == [0]
        bodies = [cursor_page(records(0, 1), "0"), cursor_page(records(1, 1), None)]
        assert scan(spark, bodies, "cursor", "jobs") == [0, 1]


def test_page_files(spark, tmp_path):
    folder = tmp_path / "entity=Customer"
    folder.mkdir()
    for n, size in enumerate([100, 100, 7]):
        (folder / f"{n}.json").write_text(json.dumps(records(100 * n, size), indent=1))
    found, merged, _ = landed(spark, str(tmp_path), BUSINESS, packed=False)(BUSINESS.entity("customer"))
    assert merged.schema.fieldNames() == ["id"]
    assert found.count() == 207
    assert [r.pos for r in head(found).collect()] == [0, 1, 2]


def test_missing_collection(spark, tmp_path):  # G7
    assert read_page_files(spark, str(tmp_path / "nothing")) is None
    assert landed(spark, str(tmp_path), BUSINESS)(BUSINESS.entity("customer")) is None


def test_cutting_into_pages_and_back(spark, tmp_path):
    ids = list(range(1234))
    random.Random(1).shuffle(ids)
    rows = spark.createDataFrame([(i, json.dumps({"id": i})) for i in ids], "id bigint, record string").repartition(7)
    paged = numbered(rows, ["id"])
    assert [(r.page, r.pos) for r in paged.orderBy("id").collect()] == [divmod(i, 100) for i in range(1234)]
    write_packed_pages(page_lists(paged, "record").withColumnRenamed("list", "body"), f"{tmp_path}/entity=Customer")
    found, *_ = landed(spark, str(tmp_path), BUSINESS)(BUSINESS.entity("customer"))
    got = found.select(F.variant_get("v", "$.id", "bigint").alias("id"), "page", "pos")
    assert sorted(tuple(r) for r in got.collect()) == [(i, *divmod(i, 100)) for i in range(1234)]


def test_schema_of_unreached_pages_is_not_used(spark):
    bodies = [json.dumps(records(0, 5)), json.dumps([{"id": 7, "Stray": 1}])]
    pages = spark.createDataFrame(list(enumerate(bodies)), "page bigint, body string")
    found, merged, _ = scan_staged(decode(pages, "offset"))
    assert merged is None
    assert found.count() == 5


def test_nothing_landed_yet(spark):
    pages = spark.createDataFrame([], "page bigint, body string")
    found, *_ = scan_staged(decode(pages, "offset"))
    assert found.count() == 0


def landing(spark, folder, landing, sizes, start=0):
    rows, at = [], start
    for page, size in enumerate(sizes):
        rows.append((page, json.dumps(records(at, size))))
        at += size
    pages = spark.createDataFrame(rows, "page bigint, body string")
    write_packed_pages(pages, f"{folder}/entity=Customer/run_id={landing}")


def test_landings_are_scans_of_their_own(spark, tmp_path):
    landing(spark, tmp_path, 1, [100, 30, 100])
    landing(spark, tmp_path, 2, [100, 100, 5], start=1000)
    found, _, unread = landed(spark, str(tmp_path), BUSINESS)(BUSINESS.entity("customer"))
    counts = {r.run_id: r["count"] for r in found.groupBy("run_id").count().collect()}
    assert counts == {1: 130, 2: 205}
    assert (unread.pages, unread.first) == (1, "1:2")


def test_page_size_of_the_family(spark, tmp_path):
    landing(spark, tmp_path, 1, [50, 50, 50, 50])
    family = replace(BUSINESS, page_size=50)
    found, _, unread = landed(spark, str(tmp_path), family)(family.entity("customer"))
    assert (found.count(), unread.pages) == (200, 0)
    found, _, unread = landed(spark, str(tmp_path), BUSINESS)(BUSINESS.entity("customer"))
    assert (found.count(), unread.pages, unread.first) == (50, 3, "1:1")


@pytest.mark.parametrize("staged", [False, True])
class TestBigPages:
    """Pages too big for one VARIANT are parsed record by record."""

    @pytest.fixture(autouse=True)
    def small_limit(self, monkeypatch):
        monkeypatch.setattr(pages, "BIG_BODY", 50)

    def test_offset(self, spark, staged):
        full = [records(0, 100), {"value": records(100, 100)}, [{"id": 200}]]
        assert scan(spark, full, staged=staged) == list(range(201))
        assert scan(spark, [{"message": "x" * 60}, records(0, 3)], staged=staged) == []
        assert scan(spark, [{"value": None, "message": "x" * 60}], staged=staged) == []

    def test_cursor(self, spark, staged):
        bodies = [cursor_page(records(0, 9), "c1"), cursor_page(records(9, 20), None), cursor_page(records(50, 20), None)]
        assert scan(spark, bodies, "cursor", "jobs", staged) == list(range(29))
        assert scan(spark, [{"organization": None, "x": "y" * 60}], "cursor", "jobs", staged) == []

    def test_text_that_is_no_json_is_an_error(self, spark, staged):
        with pytest.raises(Exception, match="MALFORMED"):
            scan(spark, [json.dumps(records(0, 30))[:-5]], staged=staged)


def test_records_of_a_big_page_are_those_of_small_ones(spark, monkeypatch):
    odd = [{"id": 1, "a": 1.10, "b": None, "c": {"value": [1, {"x": "y"}]}}, None, "text", 5, [1], {}, {"id": 12345678901234567890123}]
    body = json.dumps(odd) + " " * 40

    def parsed():
        frame = spark.createDataFrame([(0, body)], "page bigint, body string")
        found = decode(frame, "offset").select(F.posexplode("items").alias("pos", "v"))
        return [tuple(r) for r in found.select("pos", F.to_json("v"), F.schema_of_variant("v")).collect()]

    whole = parsed()
    monkeypatch.setattr(pages, "BIG_BODY", 10)
    assert parsed() == whole
