"""Deltas beside bases, splitting, sweeping, landings in any order, names that stay."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from recordloom.functions.naming import labels
from recordloom.operators.audit import changes
from recordloom.plans.sync import given, landed, sync
from recordloom.sinks.store import BASE, DELTA, TOUCH, TableStore, Version, parent, row_hash
from recordloom.sources.entities import Collection, Entity, Family
from recordloom.streaming.ingest import ingest, landing_stream
from tests.conftest import as_dicts

ITEM = Family("items", "wrapped", "offset", (Entity("item", "Item"),), page_size=2)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"), buckets=4)


def texts(ids, value):
    return [json.dumps({"id": i, "a": value}) for i in ids]


def run(store, variants, *rows, family=ITEM):
    return sync(store, family, given({family.entities[0].table: variants(*rows)}))


def rows(store, name="item"):
    return {r["id"]: r["a"] for r in as_dicts(store.table(name).drop("_synced_at"), "id")}


def version(store, name="item"):
    return store.versions()["items", name]


def kinds(store):
    return [[p.kind for p in pieces] for _, pieces in sorted(version(store).parts.items())]


class TestBuckets:
    @pytest.mark.parametrize("key_type", ["bigint", "string"])
    def test_one_more_bit_splits_one_bucket(self, spark, store, key_type):
        ids = spark.range(3000).select(F.col("id").cast(key_type))
        for count in (1, 2, 3, 4, 5, 7, 8, 16, 21):
            both = ids.select(*[store.bucket_of(F.col("id"), key_type, n).alias(f"b{n}") for n in (count, count + 1)])
            pairs = {(r[0], r[1]) for r in both.distinct().collect()}
            assert {b for b, _ in pairs} == set(range(count))
            assert all(new == old or (new == count and old == parent(count, count)) for old, new in pairs)

    def test_bytes_per_bucket_stay_bounded(self, spark, variants, tmp_path):
        store = TableStore(spark, str(tmp_path / "grown"), buckets=1, bucket_bytes=12_000)
        for first, last in ((0, 100), (100, 2_000), (2_000, 10_000)):
            run(store, variants, *[json.dumps({"id": i, "a": f"text {i * 7919}"}) for i in range(first, last)])
            now = version(store)
            assert now.size / now.buckets <= 1.5 * 12_000  # small files do not add up to what they were as one
        assert now.buckets > 8
        assert max(sum(p.size for p in pieces) for pieces in now.parts.values()) <= 4 * 12_000
        assert rows(store) == {i: f"text {i * 7919}" for i in range(10_000)}


class TestDeltas:
    def test_many_buckets_are_listed_and_written_by_some_tasks(self, spark, variants, tmp_path):
        store = TableStore(spark, str(tmp_path / "wide"), buckets=160)
        run(store, variants, *texts(range(4000), "old"))
        run(store, variants, *texts(range(0, 4000, 20), "new"))
        delta = store._pieces(version(store), (DELTA,)).select(F.input_file_name()).distinct().collect()
        assert len({row[0].rsplit("/part-", 1)[1][:5] for row in delta}) > 1
        spark.sparkContext.setJobGroup("read many buckets", "")
        try:
            assert rows(store) == {i: "new" if i % 20 == 0 else "old" for i in range(4000)}
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        tracker = spark.sparkContext.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("read many buckets") for s in tracker.getJobInfo(j).stageIds]
        found = [info for s in stages if (info := tracker.getStageInfo(s)) is not None]  # none is kept of skipped ones
        assert 0 < max(info.numTasks for info in found) <= 64

    def test_a_small_batch_writes_a_small_delta(self, store, variants):
        run(store, variants, *texts(range(2000), "old"))
        before = version(store)
        run(store, variants, *texts(range(0, 2000, 50), "new"))
        after = version(store)
        new = [p for pieces in after.parts.values() for p in pieces if p.folder not in before.folders()]
        assert {p.kind for p in new} == {DELTA}
        assert sum(p.rows for p in new) == 40
        assert sum(p.size for p in new) < before.size
        assert rows(store) == {i: "new" if i % 50 == 0 else "old" for i in range(2000)}
        assert after.row_count == store.table("item").count() == 2000

    def test_unchanged_rows_are_not_written(self, store, variants):
        run(store, variants, *texts(range(100), "same"))
        before, times = version(store), as_dicts(store.table("item").select("id", "_synced_at"), "id")
        run(store, variants, *texts(range(100), "same"))
        assert version(store) == before
        assert as_dicts(store.table("item").select("id", "_synced_at"), "id") == times
        entry = as_dicts(store.commits().filter("run = 2"))[0]
        assert [entry[k] for k in ("upserts", "added", "changed", "same", "stale")] == [100, 0, 0, 100, 0]

    def test_worn_buckets_are_written_anew(self, store, variants):
        run(store, variants, *texts(range(400), 0))
        expected = dict.fromkeys(range(400), 0)
        for step in range(1, 5):
            chosen = range(step, 400, 8)
            run(store, variants, *texts(chosen, step))
            expected |= dict.fromkeys(chosen, step)
            assert rows(store) == expected
        deltas = [sum(k == DELTA for k in pieces) for pieces in kinds(store)]
        assert max(deltas) <= 2  # 50 rows a run beside 400, a quarter at most

    def test_full_refresh_is_one_base(self, store, variants):
        run(store, variants, *texts(range(50), 1))
        run(store, variants, *texts(range(25, 75), 2))
        assert kinds(store) == [[BASE]] * 4
        assert rows(store) == {i: 1 if i < 25 else 2 for i in range(75)}
        entry = as_dicts(store.commits().filter("run = 2"))[0]
        assert (entry["added"], entry["changed"], entry["row_count"]) == (25, 25, 75)

    def test_compaction_changes_no_row(self, store, variants):
        run(store, variants, *texts(range(300), "old"))
        run(store, variants, *texts([3, 5, 900], "new"))
        before = as_dicts(store.table("item"), "id")
        assert any(DELTA in pieces for pieces in kinds(store))
        store.compact("item", "items")
        assert kinds(store) == [[BASE]] * 4
        assert as_dicts(store.table("item"), "id") == before
        run(store, variants, *texts([3], "newer"))
        assert rows(store)[3] == "newer" and len(rows(store)) == 301

    def test_columns_and_types_change_beside_a_base(self, store, variants):
        run(store, variants, *[json.dumps({"id": i, "a": 1, "b": 2.5}) for i in range(200)])
        run(store, variants, '{"id":7,"a":"x","c":true}')
        assert any(DELTA in pieces for pieces in kinds(store))
        found = {r["id"]: r for r in as_dicts(store.table("item").drop("_synced_at"), "id")}
        assert found[7] == {"id": 7, "a": "x", "b": None, "c": True}
        assert found[8] == {"id": 8, "a": "1", "b": 2.5, "c": None}
        run(store, variants, '{"id":"7","a":"y"}')
        assert {r["a"] for r in as_dicts(store.table("item").filter("id = '7'"))} == {"y"}
        assert store.table("item").count() == 200

    def test_counts_equal_the_full_join(self, store, variants):
        run(store, variants, *[json.dumps({"id": i, "a": i % 5, "b": i / 4}) for i in range(200)])
        old = store.table("item", run=1)
        run(store, variants, *[json.dumps({"id": i, "a": i % 4, "b": i / 4, "c": None}) for i in range(100, 260)])
        kinds_ = changes(old.drop("_synced_at"), store.table("item").drop("_synced_at"), ["id"])
        counted = {r["change_kind"]: r["count"] for r in kinds_.groupBy("change_kind").count().collect()}
        entry = as_dicts(store.commits().filter("run = 2"))[0]
        assert (entry["added"], entry["changed"]) == (counted["added"], counted["changed"])
        assert entry["same"] == counted["same"] - 100  # those the second run did not bring


def test_pieces_know_their_rows_and_bytes_without_paths_of_rows(spark, store, variants):
    counted = []
    reading = type(spark.range(1)).groupBy

    def watched(frame, *keys):
        counted.append(keys)
        return reading(frame, *keys)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark.range(1)), "groupBy", watched)
        run(store, variants, *texts(range(300), 1))
    assert ("_bucket",) in counted and not any("file_path" in str(key) for keys in counted for key in keys)
    for bucket, pieces in version(store).parts.items():
        (piece,) = pieces
        files = glob.glob(f"{store.root}/{piece.folder}/_bucket={bucket}/*.parquet")
        assert piece.size == sum(map(os.path.getsize, files))
        assert piece.rows == spark.read.parquet(*files).count()


def test_row_hash_ignores_order_empty_columns_and_widening(spark):
    frames = [
        spark.createDataFrame([(5, "x")], "a bigint, b string"),
        spark.createDataFrame([("x", 5.0, None)], "b string, a double, c string"),
        spark.createDataFrame([("x", "5")], "b string, a string"),
        spark.createDataFrame([("5", "x")], "b string, a string"),
        spark.createDataFrame([("x", None, "5")], "b string, a string, c string"),
    ]
    hashes = [f.select(row_hash({c: t for c, t in f.dtypes})).first()[0] for f in frames]
    assert hashes[0] == hashes[1] == hashes[2]
    assert len(set(hashes)) == 3


def test_the_text_of_a_hashed_number_is_made_once(spark):
    numbers = spark.createDataFrame([(0, 17.0), (1, 0.1), (2, -12345.67), (3, 1e7), (4, 1e-7), (5, None)], "id int, x double")
    shown = {0: "17", 1: "0.1", 2: "-12345.67", 3: "10000000", 4: "0.0000001"}
    for n, text in shown.items():
        as_number = numbers.filter(f"id = {n}").select(row_hash({"x": "double"})).first()[0]
        as_string = spark.sql(f"SELECT '{text}' AS x").select(row_hash({"x": "string"})).first()[0]
        assert as_number == as_string
    assert numbers.filter("id = 5").select(row_hash({"x": "double"})).first()[0] == 0
    # usual numbers take no pattern, and NULL is found without the text
    formula = str(row_hash({"x": "double"}))
    assert formula.lower().count("trim") == 2 and formula.count("xxhash64") == 1


class TestSweep:
    def test_only_the_latest_run_is_kept(self, store, variants):
        for value in range(3):
            run(store, variants, *texts(range(40), value))
        before = as_dicts(store.table("item"), "id")
        swept = store.sweep()
        assert len(swept) == 2
        assert as_dicts(store.table("item"), "id") == before
        assert store.sweep() == []

    def test_a_folder_no_run_touched_for_long_survives(self, store, variants):
        family = Family("items", "wrapped", "offset", (Entity("item", "Item", (Collection("Lines", "line"),)),))
        run(store, variants, '{"id":1,"a":0,"Lines":[{"id":10,"a":"kept"}]}', family=family)
        for value in range(1, 4):
            run(store, variants, json.dumps({"id": 1, "a": value}), family=family)
        store.sweep()
        assert rows(store) == {1: 3} and rows(store, "line") == {10: "kept"}

    def test_kept_runs_can_be_read(self, store, variants):
        for value in range(4):
            run(store, variants, *texts(range(20), value))
        store.sweep(keep_runs=2)
        for value, number in ((2, 3), (3, 4)):
            assert {r["a"] for r in as_dicts(store.table("item", run=number))} == {value}

    def test_what_a_dead_run_left_goes_once_runs_have_passed_it(self, store, variants):
        run(store, variants, *texts([1], 0))
        table = variants('{"id":1}').select(F.lit(1).alias("id"), F.lit(9).alias("a"), F.lit(1).alias("_at"))
        store.write("items", "item", table, 2, version(store))
        assert store.sweep() == []  # it may still be under way
        run(store, variants, *texts([1], 1))
        assert len(store.sweep()) == 2  # of the first run and of the one that died
        assert rows(store) == {1: 1}

    def test_rows_aside_and_other_families_stay(self, store, variants):
        other = Family("others", "plain", "cursor", (Entity("item", "Item"),))
        run(store, variants, '{"id":1,"a":1}', '{"a":5}')
        run(store, variants, '{"id":1,"a":2}', family=other)
        run(store, variants, '{"id":1,"a":3}')
        store.sweep()
        assert store.quarantined().count() == 1
        assert [r["a"] for r in as_dicts(store.table("item", "others"))] == [2]


class Landing:
    """Pages of two records each, landed piece by piece and read by scheduled runs."""

    def __init__(self, spark, store, folder):
        self.spark, self.store, self.folder = spark, store, folder

    def land(self, landing, pages):
        made = [(n, json.dumps([{"id": i, "a": v} for i, v in body.items()])) for n, body in pages.items()]
        frame = self.spark.createDataFrame(made, "page bigint, body string")
        frame.write.mode("append").parquet(f"{self.folder}/entity=Item/run_id={landing}")

    def trigger(self):
        stream = landing_stream(self.spark, f"{self.folder}/entity=Item")
        ingest(stream, self.store, ITEM, ITEM.entities[0], f"{self.folder}/checkpoint").awaitTermination()

    def unread(self):
        found = self.store.unread()
        return [] if found is None else sorted((r.run_id, r.page, r.reason) for r in found.collect())


@pytest.fixture
def landing(spark, store, tmp_path):
    return Landing(spark, store, str(tmp_path / "landed"))


class TestLandings:
    def test_pages_wait_for_those_before_them(self, landing):
        landing.land(1, {0: {1: "a", 2: "a"}})
        landing.trigger()
        landing.land(1, {2: {5: "a", 6: "a"}})
        landing.trigger()
        assert rows(landing.store) == {1: "a", 2: "a"}
        landing.land(1, {1: {3: "a", 4: "a"}, 3: {7: "a"}})
        landing.trigger()
        assert rows(landing.store) == dict.fromkeys(range(1, 8), "a")
        assert landing.unread() == []

    def test_the_first_page_may_come_last(self, landing):
        for pages in ({2: {5: "a"}}, {1: {3: "a", 4: "a"}}):
            landing.land(1, pages)
            landing.trigger()
        assert landing.store.table("item") is None
        landing.land(1, {0: {1: "a", 2: "a"}})
        landing.trigger()
        assert rows(landing.store) == dict.fromkeys(range(1, 6), "a")

    def test_pages_past_the_end_are_registered(self, landing):
        landing.land(1, {0: {1: "a", 2: "a"}, 1: {3: "a"}, 2: {9: "a"}})
        landing.trigger()
        landing.land(1, {5: {8: "a"}, 1: {3: "b"}})
        landing.trigger()
        assert rows(landing.store) == {1: "a", 2: "a", 3: "a"}
        assert landing.unread() == [(1, 1, "read before"), (1, 2, "after the end"), (1, 5, "after the end")]

    def test_an_empty_page_ends_a_landing(self, landing):
        landing.land(1, {0: {1: "a", 2: "a"}, 1: {}})
        landing.trigger()
        landing.land(1, {2: {5: "a"}})
        landing.trigger()
        assert rows(landing.store) == {1: "a", 2: "a"}
        assert landing.unread() == [(1, 2, "after the end")]

    def test_an_older_landing_changes_nothing(self, landing):
        landing.land(2, {0: {1: "new", 2: "new"}, 1: {}})
        landing.trigger()
        landing.land(1, {0: {1: "old", 2: "old"}, 1: {3: "old"}})
        landing.trigger()
        assert rows(landing.store) == {1: "new", 2: "new", 3: "old"}
        entry = as_dicts(landing.store.commits().filter("run = 2"))[0]
        assert (entry["added"], entry["stale"], entry["changed"]) == (1, 2, 0)

    def test_an_unchanged_row_of_a_later_landing_still_outranks_an_older_one(self, landing):
        for number, value in ((1, "x"), (3, "x"), (2, "y")):
            landing.land(number, {0: {1: value}})
            landing.trigger()
        assert rows(landing.store) == {1: "x"}
        assert [TOUCH in pieces for pieces in kinds(landing.store)] == [True]
        landing.store.compact("item", "items")
        landing.land(2, {7: {1: "y"}})
        landing.trigger()
        assert rows(landing.store) == {1: "x"}

    def test_two_landings_in_parts_at_once(self, landing):
        landing.land(1, {1: {3: "old", 4: "old"}, 2: {5: "old"}})
        landing.land(2, {0: {3: "new", 1: "new"}})
        landing.trigger()
        assert rows(landing.store) == {1: "new", 3: "new"}
        landing.land(1, {0: {1: "old", 2: "old"}})
        landing.land(2, {1: {5: "new"}})
        landing.trigger()
        assert rows(landing.store) == {1: "new", 2: "old", 3: "new", 4: "old", 5: "new"}

    def test_waiting_pages_survive_a_sweep(self, landing):
        landing.land(1, {1: {3: "a"}})
        landing.trigger()
        landing.land(2, {0: {9: "b"}})
        landing.trigger()
        landing.store.sweep()
        landing.land(1, {0: {1: "a", 2: "a"}})
        landing.trigger()
        assert rows(landing.store) == {1: "a", 2: "a", 3: "a", 9: "b"}

    def test_stream_in_parts_is_the_batch(self, spark, landing, tmp_path):
        pages = {n: {2 * n: f"v{n}", 2 * n + 1: f"v{n}"} for n in range(9)} | {9: {18: "end"}, 11: {40: "lost"}}
        for part in ((4, 9), (0, 1, 8, 11), (2, 3, 5, 6, 7)):
            landing.land(1, {n: pages[n] for n in part})
            landing.trigger()
        batch = TableStore(spark, str(tmp_path / "batch"))
        sync(batch, ITEM, landed(spark, landing.folder, ITEM))
        assert rows(landing.store) == rows(batch)
        assert [r.page for r in batch.unread().collect()] == [11]
        assert [page for _, page, _ in landing.unread()] == [11]


def test_batch_register_lists_empty_pages_and_every_landing(spark, store, landing):
    landing.land(1, {0: {1: "a"}, 1: {}, 2: {5: "a"}})
    landing.land(2, {1: {6: "a"}})
    landing.land(3, {0: {7: "a", 8: "a"}, 2: {}})
    sync(store, ITEM, landed(spark, landing.folder, ITEM))
    assert landing.unread() == [
        (1, 1, "after the end"), (1, 2, "after the end"), (2, 1, "no first page"), (3, 2, "after a gap"),
    ]
    assert as_dicts(store.commits())[0]["unread_pages"] == 4


def test_labels_stay_with_their_names():
    first = labels(["FooBar", "Foo_Bar"], True)
    assert first == {"FooBar": "foo_bar", "Foo_Bar": "foo_bar_2"}
    assert labels(["Foo_Bar"], True, first) == {"Foo_Bar": "foo_bar_2"}
    assert labels(["foo_bar", "fooBar", "id"], True, first) == {"foo_bar": "foo_bar_3", "fooBar": "foo_bar_4", "id": "id"}


def test_labels_of_a_table_are_kept_in_any_order_of_runs(store, variants):
    run(store, variants, '{"id":1,"Foo_Bar":"a"}')
    run(store, variants, '{"id":2,"FooBar":"b"}')
    run(store, variants, '{"id":3,"FooBar":"c","Foo_Bar":"d"}')
    found = as_dicts(store.table("item").drop("_synced_at"), "id")
    assert [(r["foo_bar"], r["foo_bar_2"]) for r in found] == [("a", None), (None, "b"), ("d", "c")]


def test_version_log_round_trip(store, variants):
    run(store, variants, *texts(range(30), 1))
    run(store, variants, *texts([1], 2))
    now = version(store)
    assert Version.from_json(now.to_json()) == now


def test_inventory_reads_the_log_only(store, variants):
    run(store, variants, *texts(range(30), 1))
    run(store, variants, *texts(range(30), 1))
    run(store, variants, *texts([5, 77], 2))
    found = as_dicts(store.inventory())[0]
    assert (found["table_schema"], found["table_name"], found["row_count"]) == ("items", "item", 31)
    times = [r["at"] for r in as_dicts(store.commits(), "run")]
    assert (found["last_synced"], found["last_changed"]) == (times[2], times[2])
    plan = store.inventory()._jdf.queryExecution().executedPlan().toString()
    assert "version=" not in plan
