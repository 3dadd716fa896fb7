"""Landed pages back to records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.functions import variant as V
from recordloom.operators.flatten import flatten
from recordloom.plans import feeds
from recordloom.plans.feeds import record, table
from recordloom.plans.registry import query
from recordloom.plans.sync import landed
from recordloom.session import scratch, stage
from recordloom.sources.families import BUSINESS
from recordloom.sources.pages import (
    cursor_body,
    decode,
    envelope,
    head,
    numbered,
    page_lists,
    scan_staged,
    write_packed_pages,
)


def paged(rows: DataFrame, text, order: list[str]) -> DataFrame:
    """``page, list`` of all rows."""
    return page_lists(numbered(rows.select(*order, text.alias("record")), order), "record")


def with_strays(pages: DataFrame, body) -> DataFrame:
    """``page, body`` rows, and once more all pages numbered past the end.

    A reader going page by page never asks for the second set.
    """
    count = pages.agg(F.count("*")).first()[0]
    strays = pages.withColumn("page", F.col("page") + count + 1)
    return pages.select("page", body.alias("body")).unionByName(
        strays.select("page", F.col("list").alias("body"))
    )


@query(
    """
    SELECT o_orderkey AS id, o_totalprice AS total,
           (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS page,
           (row_number() OVER (ORDER BY o_orderkey) - 1) % 100 AS pos
    FROM orders
    """
)
def scan_offset_pages(spark, sf_dir):
    text = record(id="o_orderkey", Total=feeds.wrap("o_totalprice"))
    source = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    lists = stage(paged(source, text, ["o_orderkey"]), "pages")
    records, *_ = scan_staged(decode(with_strays(lists, F.col("list")), "offset"))
    flat = flatten(records, snake=True, carry=["page", "pos"])
    return flat.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    """
    SELECT c_custkey AS id, c_name AS name FROM customer
    """
)
def scan_envelope(spark, sf_dir):
    text = record(id="c_custkey", Name=feeds.wrap("c_name"))
    lists = stage(paged(table(spark, sf_dir, "customer"), text, ["c_custkey"]), "pages")
    even = F.col("page") % 2 == 0
    body = F.when(even, envelope(F.col("list"))).otherwise(F.col("list"))
    records, *_ = scan_staged(decode(with_strays(lists, body), "offset"))
    return flatten(records, snake=True)


@query(
    """
    SELECT event_id AS id, event_type AS type, value, user_id AS organization_id,
           'user ' || user_id AS organization_name, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "createdAt"
    FROM events
    """
)
def scan_cursor_pages(spark, sf_dir):
    lists = stage(paged(table(spark, sf_dir, "events"), feeds.event_text(), ["event_id"]), "pages")
    last = lists.agg(F.max("page")).first()[0]
    following = F.when(F.col("page") < last, F.col("page") + 1)
    body = cursor_body(F.col("list"), "events", following)
    records, *_ = scan_staged(decode(with_strays(lists, body), "cursor", "events"))
    return flatten(records, dialect="plain")


@query(
    """
    SELECT 'customer' AS entity, 'found' AS status, count(*) AS records FROM customer
    UNION ALL SELECT 'customer_class', 'missing', 0
    """
)
def scan_missing_entity(spark, sf_dir):
    root = scratch(spark, "landed")
    text = record(id="c_custkey", Name=feeds.wrap("c_name"))
    lists = paged(table(spark, sf_dir, "customer"), text, ["c_custkey"])
    write_packed_pages(lists.withColumnRenamed("list", "body"), f"{root}/entity=Customer")
    source = landed(spark, root, BUSINESS)
    reports = []
    for name in ("customer", "customer_class"):
        found = source(BUSINESS.entity(name))
        empty = spark.createDataFrame([], "page bigint, pos int, v variant")
        count = (empty if found is None else found[0]).agg(F.count("*").alias("records"))
        status = F.lit("missing" if found is None else "found")
        reports.append(count.select(F.lit(name).alias("entity"), status.alias("status"), "records"))
    return reduce(DataFrame.unionByName, reports)


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE::VARCHAR AS ship_date,
           (row_number() OVER all_lines - 1) // 100 AS page, (row_number() OVER all_lines - 1) % 100 AS pos
    FROM lineitem
    WINDOW all_lines AS (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
                         l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus)
    """
)
def paginate(spark, sf_dir):
    order = (
        "l_orderkey l_linenumber l_partkey l_suppkey l_shipdate "
        "l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
    ).split()
    lines = numbered(table(spark, sf_dir, "lineitem").select(*order), order)
    return lines.select(
        *order[:4],
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
        "page",
        F.col("pos").cast("bigint").alias("pos"),
    )


@query(
    """
    SELECT * FROM (SELECT 'customer' AS entity, c_custkey AS id FROM customer ORDER BY c_custkey LIMIT 3)
    UNION ALL SELECT * FROM (SELECT 'event', event_id FROM events ORDER BY event_id LIMIT 3)
    UNION ALL SELECT * FROM (SELECT 'stock_item', p_partkey FROM part ORDER BY p_partkey LIMIT 3)
    """
)
def sample_head3(spark, sf_dir):
    sources = {"customer": feeds.customers, "event": feeds.events, "stock_item": feeds.stock_items}
    samples = [
        head(feed(spark, sf_dir, spread=False)).select(F.lit(name).alias("entity"), V.pick(F.col("v"), ("id",), "bigint").alias("id"))
        for name, feed in sources.items()
    ]
    return reduce(DataFrame.unionByName, samples)
