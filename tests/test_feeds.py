"""The same rows in other files give the same records."""

import pyarrow.dataset as ds
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from recordloom.functions import variant as V
from recordloom.operators.catalogue import stage_records
from recordloom.operators.fanout import positioned, survey
from recordloom.plans import feeds
from recordloom.sources.families import BUSINESS

SOURCE = "/root/testdata/sf0.001"
TABLES = ("customer", "orders", "lineitem")


@pytest.mark.parametrize("feed", [feeds.bills, feeds.sales_orders, feeds.customers_with_orders])
def test_records_do_not_depend_on_files(spark, tmp_path, feed):
    for name in TABLES:
        spark.read.parquet(f"{SOURCE}/{name}.parquet").repartition(16).write.parquet(f"{tmp_path}/{name}.parquet")
    texts = [sorted(str(r.v) for r in feed(spark, folder).select("v").collect()) for folder in (SOURCE, str(tmp_path))]
    assert texts[0] == texts[1]


@pytest.mark.parametrize("feed", [feeds.bills, feeds.sales_orders])
def test_texts_are_made_before_rows_move(spark, feed):
    lines = feeds.gather(feeds.table(spark, SOURCE, "lineitem"), ["l_orderkey"], line=feeds.line_text())
    assert lines.columns == ["l_orderkey", "line"]
    plan = feed(spark, SOURCE)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression") :]
    above = plan[: plan.index("RepartitionByExpression")]
    assert "l_extendedprice" in below and "l_extendedprice" not in above


TEXTS = [
    (0, '{"id":1,"Details":[{"id":"a"},{"id":null},7,[1],{},{"id":{"value":2}},{"id":{}},{"id":[1]},null]}'),
    (1, '{"id":2,"Details":null}'),
    (2, '{"id":{"value":3}}'),
]


@pytest.mark.parametrize("shredded", [True, False])
def test_staged_records_are_the_same_shredded_or_not(spark, shredded):
    rows = spark.createDataFrame(TEXTS, "page bigint, j string")
    found = rows.select("page", F.lit(0).alias("pos"), F.parse_json("j").alias("v"))
    staged, merged = stage_records(found, "records", shredded)
    assert [str(r.v) for r in staged.orderBy("page").collect()] == [str(r.v) for r in found.orderBy("page").collect()]
    tallies = survey(positioned(staged), BUSINESS.entity("bill"), merged=merged).tallies
    assert (tallies["bill"].total, tallies["bill"].keyed) == (3, 3)
    assert (tallies["bill_detail"].total, tallies["bill_detail"].keyed) == (9, 2)


@pytest.mark.parametrize("shredded", [True, False])
def test_records_are_shredded_only_if_asked(spark, tmp_path, shredded, monkeypatch):
    monkeypatch.setattr("recordloom.session.scratch", lambda spark, label: f"{tmp_path}/{label}")
    stage_records(feeds.vendors(spark, SOURCE), "records", shredded)
    inner = {f.name for f in ds.dataset(f"{tmp_path}/records", format="parquet").schema.field("v").type}
    assert ("typed_value" in inner) == shredded


def test_objects_are_told_without_copying_them(spark):
    texts = ["{}", '{"a":{"b":[1]}}', "[]", "[{}]", "1", "null", '"{}"', None]
    v = spark.createDataFrame(list(enumerate(texts)), "i int, j string").select("i", F.parse_json("j").alias("v"))
    both = v.select("i", V.is_object(F.col("v")), V.is_object(F.col("v"), ("a",)))
    assert [tuple(r)[1:] for r in both.orderBy("i").collect()] == [(True, False), (True, True)] + [(False, False)] * 6
    assert "map" not in V.is_object(F.col("v"))._jc.toString() and V.ANY_OBJECT == "struct<>"


def test_staged_records_have_no_dictionaries(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("recordloom.session.scratch", lambda spark, label: f"{tmp_path}/{label}")
    stage_records(feeds.vendors(spark, SOURCE), "records")
    used = set()
    for path in ds.dataset(f"{tmp_path}/records", format="parquet").files:
        group = pq.ParquetFile(path).metadata.row_group(0)
        used |= {encoding for i in range(group.num_columns) for encoding in group.column(i).encodings}
    assert "PLAIN" in used and not {e for e in used if "DICTIONARY" in e}


def test_many_narrow_rows_in_one_file_are_dealt_to_several_tasks(spark, tmp_path):
    some = "array('click', 'view', 'error')[id % 3] event_type"
    rows = spark.range(200_000).selectExpr(
        "id event_id", "timestamp_millis(id * 977) ts", "xxhash64(id) user_id", some, "rand(1) value", "'{}' props"
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    dealt, read = feeds.events(spark, str(tmp_path)), feeds.events(spark, str(tmp_path), spread=False)
    assert dealt.rdd.getNumPartitions() > 2 and read.rdd.getNumPartitions() <= 2
    rows.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{tmp_path}/cut/events.parquet")
    assert "Repartition" not in feeds.events(spark, f"{tmp_path}/cut")._jdf.queryExecution().optimizedPlan().toString()
    sums = [f.agg(F.count("*"), F.sum(F.hash("page", F.to_json("v")).cast("bigint"))).first() for f in (dealt, read)]
    assert sums[0] == sums[1] and sums[0][0] == 200_000


def test_small_tables_are_read_as_they_lie(spark):
    plan = feeds.vendors(spark, SOURCE)._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan
