"""Flatten rules, one case each (ids as in FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from recordloom.functions.naming import labels, snake_case
from recordloom.functions.variant import parse_schema, widest
from recordloom.operators.access import Whole
from recordloom.operators.catalogue import discover
from recordloom.operators.fanout import normalise, positioned
from recordloom.operators.flatten import flatten
from recordloom.session import stage
from recordloom.sources.families import BUSINESS

BILL = BUSINESS.entity("bill")
CASES = [
    ("N1", ['{"A":{"value":1}}'], [{"A": 1}], [{"A_value": 1}]),
    ("N2", ['{"A":{"value":null}}'], [{"A": None}], [{"A_value": None}]),
    ("N3", ['{"A":{}}'], [{"A": None}], [{"A": None}]),
    ("N4", ['{"A":{"value":1,"error":"e"}}'], [{"A_value": 1, "A_error": "e"}], None),
    ("N5", ['{"A":{"value":1,"error":null}}'], [{"A_value": 1, "A_error": None}], None),
    ("N6", ['{"A":{"B":{"value":2}}}'], [{"A_B": 2}], [{"A_B_value": 2}]),
    ("N7", ['{"A":{"value":{"k":1}}}'], [{"A": '{"k":1}'}], [{"A_value_k": 1}]),
    ("N8", ['{"A":{"value":[1]}}'], [{"A": "[1]"}], [{}]),
    ("N9", ['{"A":[{"id":1}]}'], [{}], [{}]),
    ("N10", ['{"_links":{"self":"u"}}'], [{}], [{"_links_self": "u"}]),
    (
        "N11",
        ['{"A":{"_links":{"s":"u"},"B":{"value":1}}}'],
        [{"A_B": 1}],
        [{"A__links_s": "u", "A_B_value": 1}],
    ),
    (
        "N12",
        ['{"A":{"_links":{"s":"u"},"value":1}}'],
        [{"A_value": 1}],
        [{"A__links_s": "u", "A_value": 1}],
    ),
    ("N13", ['{"A":{"L":[1]}}'], [{}], [{}]),
    ("N14", ['{"A":{"_links":{"s":"u"}}}'], [{}], [{"A__links_s": "u"}]),
    ("N15a", ['{"A":"x"}'], [{"A": "x"}], None),
    ("N15b", ['{"A":true}'], [{"A": True}], None),
    ("N15c", ['{"A":1.5}'], [{"A": 1.5}], None),
    ("N15d", ['{"A":null}'], [{"A": None}], None),
    ("N16", ['{"value":5}'], [{"value": 5}], None),
    ("N17", ['{"A_B":1,"A":{"B":2}}'], [{"A_B": 2}], None),
    ("N18", ['{"A":{"B":2},"A_B":1}'], [{"A_B": 2}], None),  # the deeper path wins, see README
    (
        "N19",
        ['{"A":{"value":1}}', '{"A":{"value":1,"error":"e"}}'],
        [{"A": 1, "A_value": None, "A_error": None}, {"A": None, "A_value": 1, "A_error": "e"}],
        [{"A_value": 1, "A_error": None}, {"A_value": 1, "A_error": "e"}],
    ),
    ("N20", ['{"A":1}', '{"A":"x"}'], [{"A": "1"}, {"A": "x"}], None),
    (
        "wrapper in one record, object with a value of other keys in the next",
        ['{"A":{"value":{"k":1}}}', '{"A":{"value":{"j":1},"e":2}}'],
        [{"A": '{"k":1}', "A_e": None, "A_value_j": None}, {"A": None, "A_e": 2, "A_value_j": 1}],
        [{"A_value_k": 1, "A_value_j": None, "A_e": None}, {"A_value_k": None, "A_value_j": 1, "A_e": 2}],
    ),
    (
        "scalar, object, list, null, wrapper",
        ['{"A":5}', '{"A":{"q":{"value":2}}}', '{"A":[1]}', '{"A":null}', '{"A":{"value":7}}'],
        [{"A": 5, "A_q": None}, {"A": None, "A_q": 2}, *[{"A": None, "A_q": None}] * 2, {"A": 7, "A_q": None}],
        [
            {"A": 5, "A_q_value": None, "A_value": None},
            {"A": None, "A_q_value": 2, "A_value": None},
            *[{"A": None, "A_q_value": None, "A_value": None}] * 2,
            {"A": None, "A_q_value": None, "A_value": 7},
        ],
    ),
    ("empty object beside a filled one", ['{"A":{"B":{}}}', '{"A":{}}'], [{"A": None, "A_B": None}] * 2, None),
    ("null list", ['{"L":[1]}', '{"L":null}'], [{"L": None}] * 2, None),
    ("repeated key keeps the last", ['{"A":1,"A":2}'], [{"A": 2}], None),
    ("names that differ by case", ['{"id":1,"ID":"u"}'], [{"id": 1, "ID_2": "u"}], None),
    (
        "names with dots, quotes and spaces",
        ['{"a.b":{"c d":{"value":1}},"q\'s":2,"d\\"q":3}'],
        [{"a.b_c d": 1, "q's": 2, 'd"q': 3}],
        [{"a.b_c d_value": 1, "q's": 2, 'd"q': 3}],
    ),
    ("a name with both quotes", ['{"x\'\\"y":{"value":4}}'], [{"x'\"y": 4}], [{"x'\"y_value": 4}]),
    ("big integers stay exact", ['{"A":12345678901234567890}', '{"A":1}'], [{"A": 12345678901234567890}, {"A": 1}], None),
    ("whole fractions are fractions", ['{"A":23.0}', '{"A":17.0}'], [{"A": 23.0}, {"A": 17.0}], None),
]


@pytest.mark.parametrize("dialect", ["wrapped", "plain"])
@pytest.mark.parametrize("name,texts,wrapped,plain", CASES, ids=[c[0] for c in CASES])
def test_rule(variants, name, texts, wrapped, plain, dialect):
    want = wrapped if dialect == "wrapped" or plain is None else plain
    out = flatten(variants(*texts), dialect=dialect, carry=["pos"]).orderBy("pos")
    got = [{k: v for k, v in row.asDict().items() if k != "pos"} for row in out.collect()]
    assert got == want


@pytest.mark.parametrize("dialect", ["wrapped", "plain"])
@pytest.mark.parametrize("name,texts,wrapped,plain", CASES, ids=[c[0] for c in CASES])
@pytest.mark.parametrize("staged", [False, True])
def test_rule_in_lists(variants, name, texts, wrapped, plain, dialect, staged):
    """The same holds for the elements of a list, however the list is read."""
    want = wrapped if dialect == "wrapped" or plain is None else plain
    records = variants(*[f'{{"id":{i},"Details":[{t}]}}' for i, t in enumerate(texts)])
    _, details = normalise(positioned(stage(records, "rules") if staged else records), BILL, dialect)
    rows = details.rows().orderBy("_at").drop("_at").collect()
    got = [{k: v for k, v in row.asDict().items() if k != "parent_id"} for row in rows]
    assert got == want
    assert [row.parent_id for row in rows] == list(range(len(texts)))


def test_records_that_are_not_objects_have_no_columns(variants):
    records, record = variants('{"A":1}', "null", "[1]", "5"), Whole(F.col("v"))
    catalogue = discover(lambda wants: (records, record))
    assert list(catalogue.columns()) == ["A"]
    assert records.filter(catalogue.is_record(record)).count() == 1


def test_collisions_are_reported(variants):
    records = variants('{"A_B":1,"A":{"B":2}}')
    catalogue = discover(lambda wants: (records, Whole(F.col("v"))))
    assert catalogue.collisions() == {"A_B": [("A_B",), ("A", "B")]}


def test_no_records(variants):
    records = variants('{"A":1}').limit(0)
    assert flatten(records).columns == []


def test_names():
    assert snake_case("EstimatedCompletionDate") == "estimated_completion_date"
    assert snake_case("custom_Document_AttributeSHLTRTYPE") == "custom_document_attribute_shltrtype"
    assert labels(["ID", "OrderNbr", "id", "order_nbr"], snake=True) == {
        "ID": "id_2",
        "OrderNbr": "order_nbr_2",
        "id": "id",
        "order_nbr": "order_nbr",
    }


def test_types():
    assert widest(["bigint", "void"]) == "bigint"
    assert widest(["bigint", "double"]) == "double"
    assert widest(["bigint", "decimal(38,0)"]) == "decimal(38,0)"
    assert widest(["int", "bigint"]) == "bigint"
    assert widest(["boolean", "bigint"]) == "string"
    assert widest(["decimal(10,2)", "bigint"]) == "double"
    assert widest(["void"]) == "void"
    assert parse_schema("OBJECT<`OBJECT<`: BIGINT>").fieldNames() == ["OBJECT<"]
