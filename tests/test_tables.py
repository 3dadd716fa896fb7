"""Upsert, drift, store and runs (ids as in FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from recordloom.operators.audit import change_counts, operation_summary
from recordloom.operators.drift import renamed, union_drift
from recordloom.operators.flatten import flatten
from recordloom.operators.upsert import latest, upsert, with_key, without_key
from recordloom.plans.sync import SyncFailed, given, sync
from recordloom.session import INITIAL_PARTITIONS, sized_shuffles, stage
from recordloom.sinks.store import TableStore, Version
from recordloom.sources.entities import Collection, Entity, Family
from tests.conftest import as_dicts

ITEM = Family("items", "wrapped", "offset", (Entity("item", "Item"),))


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def run(store, variants, *texts, family=ITEM):
    return sync(store, family, given({"item": variants(*texts)}))


def rows(store, name="item"):
    return as_dicts(store.table(name).drop("_synced_at"), "id")


class TestDrift:
    def test_added_column(self, store, variants):  # D1
        run(store, variants, '{"id":1,"a":1}')
        run(store, variants, '{"id":1,"a":1,"b":2}')
        assert rows(store) == [{"id": 1, "a": 1, "b": 2}]
        assert [r.schema_changes for r in store.commits().orderBy("run").collect()] == [1, 1]

    def test_removed_column(self, store, variants):  # D2
        run(store, variants, '{"id":1,"a":1}', '{"id":2,"a":2}')
        run(store, variants, '{"id":1}')
        assert rows(store) == [{"id": 1, "a": None}, {"id": 2, "a": 2}]

    def test_renamed_column(self, store, variants):  # D3
        run(store, variants, '{"id":1,"old":5}', '{"id":2,"old":6}')
        run(store, variants, '{"id":2,"new":7}')
        both = store.table("item").select("id", renamed("new", "old").alias("v"))
        assert [r["v"] for r in as_dicts(both, "id")] == [5, 7]

    def test_changed_type(self, store, variants):
        run(store, variants, '{"id":1,"a":1}', '{"id":2,"a":2}')
        run(store, variants, '{"id":2,"a":"x"}')
        assert rows(store) == [{"id": 1, "a": "1"}, {"id": 2, "a": "x"}]

    def test_number_that_becomes_text_later(self, spark, store, variants, tmp_path):
        numbers = ['{"id":1,"a":12345678.9}', '{"id":2,"a":0.5}', '{"id":3,"a":-7.25}', '{"id":4,"a":100.0}']
        run(store, variants, *numbers)
        run(store, variants, '{"id":9,"a":"x"}')
        at_once = TableStore(spark, str(tmp_path / "other"))
        run(at_once, variants, *numbers, '{"id":9,"a":"x"}')
        assert rows(store) == rows(at_once)
        assert rows(store)[0]["a"] == "12345678.9"
        assert [r.schema_changes for r in store.commits().orderBy("run").collect()] == [1, 1]

    def test_changed_key_type(self, store, variants):
        run(store, variants, '{"id":1,"a":1}', '{"id":2,"a":2}')
        run(store, variants, '{"id":"2","a":3}', '{"id":"k","a":4}')
        assert rows(store) == [{"id": "1", "a": 1}, {"id": "2", "a": 3}, {"id": "k", "a": 4}]

    def test_union(self, spark):
        a = spark.createDataFrame([(1, 1)], "id bigint, x int")
        b = spark.createDataFrame([(2, 1.5, True)], "id bigint, x double, y boolean")
        out = as_dicts(union_drift(a, b), "id")
        assert out == [{"id": 1, "x": 1.0, "y": None}, {"id": 2, "x": 1.5, "y": True}]


class TestUpsert:
    def test_kept_replaced_inserted(self, store, variants):  # D4
        run(store, variants, '{"id":1,"a":1}', '{"id":2,"a":2}')
        run(store, variants, '{"id":2,"a":20}', '{"id":3,"a":30}')
        assert [(r["id"], r["a"]) for r in rows(store)] == [(1, 1), (2, 20), (3, 30)]

    def test_later_place_wins(self, store, variants):  # D5
        run(store, variants, '{"id":1,"a":1,"b":1}', '{"id":1,"a":2}')
        assert rows(store) == [{"id": 1, "a": 2, "b": None}]

    def test_same_run_again(self, store, variants):  # D6
        for _ in range(2):
            run(store, variants, '{"id":1,"a":1}', '{"id":2,"a":2}')
        assert rows(store) == [{"id": 1, "a": 1}, {"id": 2, "a": 2}]
        logged = [Version.from_json(r.version) for r in store.commits().orderBy("run").collect()]
        old, new = [store.read(v).drop("_synced_at") for v in logged]
        assert as_dicts(change_counts(old, new, ["id"])) == [{"change_kind": "same", "row_count": 2}]

    @pytest.mark.parametrize("staged", [False, True])
    def test_both_ways_agree(self, spark, staged):
        old = spark.range(100).select("id", F.lit("old").alias("x"))
        new = spark.range(50, 150).select("id", F.lit("new").alias("x"), F.col("id").alias("_at"))
        out = upsert(old, new.union(new), ["id"], ["_at"], staged)
        counts = {r["x"]: r["count"] for r in out.groupBy("x").count().collect()}
        assert counts == {"old": 50, "new": 100}

    def test_keys(self, spark):
        df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, x string")
        assert with_key(df, ["id"]).count() == without_key(df, ["id"]).count() == 1

    def test_hot_key_is_reduced_before_the_shuffle(self, spark):
        df = spark.range(1000).select(F.floor(F.col("id") / 900).alias("id"), F.col("id").alias("_at"))
        plan = latest(df, ["id"], ["_at"])._jdf.queryExecution().executedPlan().toString()
        assert "Partial" in plan.split("Exchange hashpartitioning")[1]

    def test_changes(self, spark):
        old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, x string")
        new = spark.createDataFrame([(2, "c", None), (3, None, None), (4, "d", 1)], "id int, x string, y int")
        got = {r["change_kind"]: r["row_count"] for r in as_dicts(change_counts(old, new, ["id"]))}
        assert got == {"absent": 1, "changed": 1, "same": 1, "added": 1}

    def test_null_and_value_do_not_hash_alike(self, spark):
        old = spark.createDataFrame([(1, None, "x")], "id int, a string, b string")
        new = spark.createDataFrame([(1, "x", None)], "id int, a string, b string")
        assert as_dicts(change_counts(old, new, ["id"])) == [{"change_kind": "changed", "row_count": 1}]


THREE = Family(
    "three",
    "wrapped",
    "offset",
    (Entity("item", "Item", (Collection("Lines", "item_line"),)), Entity("broken", "Broken"), Entity("later", "Later")),
)


class TestRuns:
    def test_failure_stops_the_run(self, spark, store, variants):  # D7
        bad = spark.createDataFrame([(0, 0, '{"id"')], "page bigint, pos int, j string")
        bad = bad.select("page", "pos", F.parse_json("j").alias("v"))
        good = variants('{"id":1,"Lines":[{"id":2},{"id":3}]}')
        with pytest.raises(SyncFailed):
            sync(store, THREE, given({"item": good, "broken": bad, "later": variants('{"id":9}')}))
        log = {r["table_name"]: r["status"] for r in as_dicts(store.commits())}
        assert log == {"item": "committed", "item_line": "committed", "broken": "failed"}
        assert rows(store, "item_line") == [{"id": 2, "parent_id": 1}, {"id": 3, "parent_id": 1}]
        assert store.table("later") is None

    def test_missing_entity_is_no_failure(self, store, variants):
        sync(store, THREE, given({"item": variants('{"id":1}'), "later": variants('{"id":9}')}))
        log = {r["table_name"]: r["status"] for r in as_dicts(store.commits())}
        assert log == {"item": "committed", "item_line": "committed", "broken": "missing", "later": "committed"}
        assert store.table("item_line") is None

    def test_rows_gone_from_the_source_stay(self, store, variants):
        sync(store, THREE, given({"item": variants('{"id":1,"Lines":[{"id":2}]}')}))
        sync(store, THREE, given({"item": variants('{"id":5}')}))
        assert [r["id"] for r in rows(store)] == [1, 5]
        assert [r["id"] for r in rows(store, "item_line")] == [2]

    def test_uncommitted_version_is_not_seen(self, store, variants):
        run(store, variants, '{"id":1,"a":1}')
        table = variants('{"id":1,"a":2}').select(F.lit(1).alias("id"), F.lit(2).alias("a"), F.lit(1).alias("_at"))
        store.write("items", "item", table, 2, store.versions()["items", "item"])
        assert rows(store) == [{"id": 1, "a": 1}]
        run(store, variants, '{"id":1,"a":3}')  # reuses the abandoned run number
        assert rows(store) == [{"id": 1, "a": 3}]

    def test_quarantine(self, store, variants):
        run(store, variants, '{"id":1}', '{"a":5}', "null", '{"id":{}}')
        assert rows(store) == [{"id": 1, "a": None}]
        commit = as_dicts(store.commits())[0]
        assert (commit["upserts"], commit["quarantined"]) == (1, 3)
        assert store.quarantined().count() == 3

    def test_a_run_that_dies_leaves_no_quarantine(self, store, variants, monkeypatch):
        texts = ('{"id":1}', '{"a":5}')
        with monkeypatch.context() as dying, pytest.raises(SyncFailed):
            dying.setattr(TableStore, "write", lambda *a, **k: 1 / 0)
            run(store, variants, *texts)
        assert store.quarantined() is None
        run(store, variants, *texts)
        assert store.quarantined().count() == 1

    def test_wrong_lists_at_every_level(self, store, variants):
        deep = Collection("Ops", "op", (Collection("Parts", "part"),))
        family = Family("deep", "wrapped", "offset", (Entity("item", "Item", (deep,)),))
        texts = ['{"id":1,"Ops":[{"id":2,"Parts":{"id":3}},{"id":4,"Parts":[{"id":5}]}]}', '{"id":6,"Ops":"x"}']
        run(store, variants, *texts, family=family)
        counts = {r["table_name"]: (r["upserts"], r["quarantined"]) for r in as_dicts(store.commits())}
        assert counts == {"item": (2, 0), "op": (2, 1), "part": (1, 1)}
        assert {r["table"] for r in as_dicts(store.quarantined())} == {"op", "part"}

    def test_families_do_not_share_tables(self, store, variants):
        other = Family("others", "plain", "cursor", (Entity("item", "Item"),))
        run(store, variants, '{"id":1,"a":1}')
        run(store, variants, '{"id":1,"a":2}', '{"id":2,"a":2}', family=other)
        assert [r["id"] for r in as_dicts(store.table("item", "items"))] == [1]
        assert store.table("item", "others").count() == 2
        with pytest.raises(ValueError):
            store.table("item")

    def test_untouched_buckets_stay_as_they_are(self, store, variants):
        run(store, variants, *[f'{{"id":{i},"a":1}}' for i in range(60)])
        before = store.versions()["items", "item"]
        run(store, variants, '{"id":7,"a":2}')
        after = store.versions()["items", "item"]
        assert sum(after.parts[b] != before.parts[b] for b in before.parts) == 1
        assert after.row_count == store.table("item").count() == 60
        assert [r["a"] for r in rows(store) if r["id"] == 7] == [2]

    def test_error_text_is_kept_whole(self, store, variants):
        def fail(entity):
            raise RuntimeError("x" * 5000)

        with pytest.raises(SyncFailed):
            sync(store, ITEM, fail)
        assert len(as_dicts(store.commits())[0]["error"]) > 5000

    def test_request_filter_of_full_dumps(self, store, variants):
        entity = Entity("item", "Item", inline=("Address",))
        text = '{"id":1,"Address":{"City":{"value":"x"}},"Other":{"City":{"value":"y"}}}'
        run(store, variants, text, family=Family("items", "wrapped", "offset", (entity,), filtered=False))
        assert rows(store) == [{"id": 1, "address_city": "x"}]

    def test_operation_summary(self, store, variants):
        sync(store, THREE, given({"item": variants('{"id":1,"Lines":[{"id":2},{"id":3}]}')}))
        got = {r["operation"]: r["operations"] for r in as_dicts(operation_summary(store.commits()))}
        assert got == {"upserts": 3, "updates": 0, "deletes": 0, "truncates": 0, "schema_changes": 2, "checkpoints": 3}


def test_shuffle_size_follows_the_input(spark, tmp_path):
    small = stage(spark.range(10).toDF("id"), "small")
    with sized_shuffles(small) as count:
        assert count == 8
        assert spark.conf.get(INITIAL_PARTITIONS) == "8"


def test_staged_records_are_read_by_path(variants):
    records = stage(variants('{"id":1,"A":{"value":2},"Big":{"value":"text"}}'), "records")
    plan = flatten(records, keeps=lambda path, obj: path == ("A",))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "v:struct<0:bigint>" in text
