"""Child and grandchild tables (ids as in FIXTURES.md)."""

import json
import random

import pytest
from pyspark.sql import functions as F

from recordloom.operators.catalogue import merged_schema
from recordloom.operators.fanout import _count_list, _id_tree, normalise, positioned, survey
from recordloom.session import stage
from recordloom.sources.entities import Collection, Entity
from recordloom.sources.families import BUSINESS, FAMILIES, MANUFACTURING, PROJECTS
from tests.conftest import as_dicts

BILL = BUSINESS.entity("bill")
BOM = MANUFACTURING.entity("bill_of_material")


def tables(records, entity, dialect="wrapped"):
    found = list(normalise(positioned(records), entity, dialect))
    return {t.table: as_dicts(t.rows().orderBy("_at").drop("_at")) for t in found}


def test_missing_null_and_empty_lists(variants):  # U1
    out = tables(variants('{"id":1}', '{"id":2,"Details":null}', '{"id":3,"Details":[]}'), BILL)
    assert [r["id"] for r in out["bill"]] == [1, 2, 3]
    assert out["bill_detail"] == []


def test_parent_id_only_where_absent(variants):  # U2 to U5
    details = '[{"id":1},{"id":2,"parent_id":"own"},{"id":3,"parent_id":null},{"id":4,"parent":{"id":9,"x":1}}]'
    out = tables(variants(f'{{"id":77,"Details":{details}}}'), BILL)
    assert [(r["id"], r["parent_id"]) for r in out["bill_detail"]] == [(1, "77"), (2, "own"), (3, None), (4, "9")]


def test_parent_id_of_wrapped_child_value(variants):
    out = tables(variants('{"id":1,"Details":[{"id":2,"parent_id":{"value":5}},{"id":3,"parent_id":[1]}]}'), BILL)
    assert [r["parent_id"] for r in out["bill_detail"]] == [5, 1]


def test_grandchildren_carry_both_ids(variants):  # U6
    text = (
        '{"id":"b1","Operations":['
        '{"id":"o1","Material":[{"id":"m1","Qty":{"value":2}},{"id":"m2","operation_id":"x"}]},'
        '{"id":"o2","Material":null},{"id":"o3"}]}'
    )
    out = tables(variants(text), BOM)
    assert [r["id"] for r in out["bill_of_material"]] == ["b1"]
    operations = out["bill_of_material_operation"]
    assert [(r["id"], r["parent_id"]) for r in operations] == [("o1", "b1"), ("o2", "b1"), ("o3", "b1")]
    materials = out["bill_of_material_material"]
    assert [(r["id"], r["parent_id"], r["operation_id"]) for r in materials] == [
        ("m1", "b1", "o1"),
        ("m2", "b1", "x"),
    ]


def test_siblings_are_not_crossed(variants):  # U7
    text = '{"id":1,"Details":[{"id":1},{"id":2},{"id":3}],"Packages":[{"id":4},{"id":5}]}'
    out = tables(variants(text), BUSINESS.entity("shipment"))
    assert len(out["shipment_detail"]) == 3
    assert len(out["shipment_package"]) == 2


def test_four_siblings(variants):
    keys = ["Attributes", "WarehouseDetails", "CrossReferences", "ReplenishmentParameters"]
    lists = ",".join(f'"{k}":[{{"id":{i}}}]' for i, k in enumerate(keys))
    out = tables(variants(f'{{"id":9,{lists}}}'), BUSINESS.entity("stock_item"))
    assert {k: len(v) for k, v in out.items()} == dict.fromkeys(BUSINESS.entity("stock_item").tables(), 1)


def test_elements_that_are_no_objects_are_set_aside(variants):  # U8
    records = positioned(variants('{"id":1,"Details":[{"id":2},5,null,"x",[1],{"B":1}]}'))
    _, details = normalise(records, BILL)
    assert [r["id"] for r in as_dicts(details.rows())] == [2, None]
    assert (details.tally.total, details.tally.keyed) == (6, 1)
    assert sorted(r["record"] for r in as_dicts(details.quarantine())) == ['"x"', "5", "[1]", "null", '{"B":1}']


def test_only_nulls_among_objects(variants):
    records = positioned(variants('{"id":1,"Details":[{"id":2},null]}'))
    _, details = normalise(records, BILL)
    assert [r["id"] for r in as_dicts(details.rows())] == [2]
    assert [r["record"] for r in as_dicts(details.quarantine())] == ["null"]


def test_collection_that_is_no_list(variants):
    records = positioned(variants('{"id":1,"Details":{"a":1}}', '{"id":2,"Details":[{"id":3}]}'))
    parents, details = normalise(records, BILL)
    assert details.tally.total == 1
    assert parents.wrong_lists(BILL.children[0]).count() == 1
    parents, _ = normalise(positioned(variants('{"id":2,"Details":[{"id":3}]}')), BILL)
    assert parents.wrong_lists(BILL.children[0]) is None


def test_survey_counts_all_levels(variants):
    text = '{"id":1,"Operations":[{"id":2,"Material":[{"id":3},{"id":{"value":4}},{"id":null}]},{"Material":[]}]}'
    found = survey(positioned(variants(text, '{"x":1}')), BOM)
    counts = {k: (t.total, t.keyed) for k, t in found.tallies.items()}
    assert counts == {
        "bill_of_material": (2, 1),
        "bill_of_material_operation": (2, 1),
        "bill_of_material_material": (3, 2),
    }


def test_survey_counts_whatever_is_missing(variants):
    rng = random.Random(3)

    def item(inner):
        made = {} if rng.random() < 0.1 else {"id": rng.choice(["", "a", "b", 7, None])}
        return None if rng.random() < 0.05 else made | inner

    def listed(make):
        return [make() for _ in range(rng.randrange(4))]

    def maybe(key, make):
        return rng.choice([{key: listed(make)}] * 6 + [{key: None}, {}])

    bills = [
        {"id": i} | maybe("Operations", lambda: item(maybe("Material", lambda: item({"Qty": {"value": 1}})))) for i in range(300)
    ]
    operations = [o for b in bills for o in b.get("Operations") or []]
    materials = [m for o in operations if o for m in o.get("Material") or []]
    found = survey(positioned(variants(*map(json.dumps, bills))), BOM).tallies
    for table, items in (("bill_of_material_operation", operations), ("bill_of_material_material", materials)):
        keyed = sum(e is not None and e.get("id") is not None for e in items)
        assert (found[table].total, found[table].keyed) == (len(items), keyed)


def test_survey_of_complete_lists_reads_sizes(spark, variants):
    text = '{"id":1,"Operations":[{"id":"2","Material":[{"id":"3"},{"id":""}]},{"id":"","Material":[]}]}'
    records = positioned(variants(text))
    plans = {}
    _count_list(BOM.children[0], _id_tree(merged_schema(records, F.col("v")).schema["Operations"].dataType, BOM.children[0]), "wrapped", plans)
    found = records.select(*[plan.alias(table) for table, plan in plans.items()])
    assert "array_contains" in found._jdf.queryExecution().optimizedPlan().toString()
    assert {k: tuple(v) for k, v in found.first().asDict().items()} == {
        "bill_of_material_operation": (2, 2, 0),
        "bill_of_material_material": (2, 2, 0),
    }


def test_places_order_the_emission(variants):
    records = variants('{"id":1,"Details":[{"id":5},{"id":6}]}', '{"id":2,"Details":[{"id":7}]}')
    _, details = normalise(positioned(records, run=4), BILL)
    places = [tuple(r["_at"]) for r in as_dicts(details.rows().orderBy("_at"))]
    assert places == [(4, 0, 0, 0, 0), (4, 0, 0, 1, 0), (4, 0, 1, 0, 0)]


def test_declared_tables_per_family():
    counts = {f.name: (len(f.entities), len(f.declared_tables())) for f in FAMILIES}
    assert counts == {"manufacturing": (8, 12), "business": (33, 63), "projects": (12, 12)}
    assert BOM.requested_lists() == ["Operations", "Operations/Material"]
    widths = {e.table: len(e.requested_columns()) for e in PROJECTS.entities}
    assert widths == {
        "account": 7, "job": 11, "task": 16, "contact": 6, "event": 5, "location": 5,
        "payment": 10, "cost_item": 12, "daily_log": 8, "comment": 10, "document": 20, "file": 14,
    }
    assert len(BUSINESS.entity("sales_order").custom) == 25


def test_new_entity_is_a_declaration(variants):
    entity = Entity("my_new_table", "MyNewEntity", (Collection("Lines", "my_new_table_line"),))
    out = tables(variants('{"id":1,"Lines":[{"id":2}]}'), entity)
    assert out["my_new_table_line"] == [{"id": 2, "parent_id": 1}]


def random_value(rng, depth):
    kind = rng.randrange(9)
    if kind == 0 and depth < 3:
        return {"value": random_value(rng, depth + 1)}
    if kind in (1, 2) and depth < 3:
        return {k: random_value(rng, depth + 1) for k in rng.sample(["A", "B", "value", "_links"], rng.randint(0, 3))}
    if kind == 3:
        return [rng.randint(0, 9)] * rng.randint(0, 2)
    return rng.choice([None, True, rng.randint(0, 99), 1.5, "text", {}])


@pytest.mark.parametrize("seed", range(6))
def test_all_ways_to_read_a_list_agree(variants, seed):
    """Typed or as VARIANTs, staged or not: one result for irregular records."""
    rng = random.Random(seed)
    texts = []
    for top in range(12):
        items = [
            {"id": f"{top}-{i}", **{k: random_value(rng, 0) for k in rng.sample("PQRST", 3)}}
            for i in range(rng.randint(0, 4))
        ]
        texts.append(json.dumps({"id": top, "Details": rng.choice([items, items, items, None])}))
    results = []
    for records in (variants(*texts), stage(variants(*texts), "random")):
        _, details = normalise(positioned(records), BILL)
        assert details.typed
        for typed in (True, False):
            details.typed = typed
            results.append((details.rows().columns, [tuple(r) for r in details.rows().orderBy("_at").collect()]))
            assert details.keys().count() == details.tally.keyed
    assert all(r == results[0] for r in results[1:])
