"""Nested lists to child tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators.catalogue import WRAPPED, stage_records
from recordloom.operators.fanout import normalise, positioned
from recordloom.plans import feeds
from recordloom.plans.feeds import line_id, nest, record, records, table, with_parts, wrap
from recordloom.plans.registry import query
from recordloom.sources.entities import Collection, Entity
from recordloom.sources.families import BUSINESS, MANUFACTURING

CUSTOMER = Entity("customer", "Customer", (Collection("Orders", "customer_order"),))


def read(feed, entity, dialect=WRAPPED):
    """Nested records of each table, from a feed staged once for all of them."""
    records, merged = stage_records(feed, entity.table)
    return normalise(positioned(records), entity, dialect, merged=merged)


def tables(feed, entity):
    """Normalised tables by name."""
    found = read(feed, entity)
    return {t.table: t.rows(snake=True).drop("_at") for t in found}


@query(
    """
    SELECT l_orderkey AS parent_id, l_orderkey || '-' || l_returnflag AS operation_id,
           l_orderkey || '-' || l_linenumber AS id, l_partkey AS inventory_id, l_quantity AS quantity,
           l_extendedprice AS price, l_returnflag AS flag
    FROM lineitem
    """
)
def fanout_grandchild(spark, sf_dir):
    found = tables(feeds.bills(spark, sf_dir), MANUFACTURING.entity("bill_of_material"))
    return found["bill_of_material_material"]


@query(
    """
    SELECT l_orderkey AS parent_id, l_orderkey || '-' || l_returnflag AS id
    FROM lineitem GROUP BY l_orderkey, l_returnflag
    """
)
def fanout_child(spark, sf_dir):
    found = tables(feeds.bills(spark, sf_dir), MANUFACTURING.entity("bill_of_material"))
    return found["bill_of_material_operation"]


@query(
    """
    SELECT o_custkey || '-' || o_orderkey // 1024 AS parent_id, o_orderkey AS id, o_orderstatus AS status,
           o_totalprice AS total
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
    """
)
def child_null_tolerant(spark, sf_dir):
    return tables(feeds.customers_with_orders(spark, sf_dir), CUSTOMER)["customer_order"]


@query(
    """
    SELECT c_custkey || '-' || coalesce(span, 0) AS id, c_name AS name, CAST(NULL AS VARCHAR) AS orders
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, o_orderkey // 1024 AS span FROM orders) ON o_custkey = c_custkey
    """
)
def parent_rows(spark, sf_dir):
    parents = next(read(feeds.customers_with_orders(spark, sf_dir), CUSTOMER))
    return parents.rows(snake=True).drop("_at")


@query(
    """
    SELECT 'sales_order_detail' AS table_name, l_orderkey AS parent_id,
           l_orderkey || '-' || l_linenumber AS id, l_quantity AS quantity
    FROM lineitem
    UNION ALL
    SELECT 'sales_order_shipment', l_orderkey, l_orderkey || '-' || l_linenumber, l_quantity
    FROM lineitem WHERE l_linestatus = 'F'
    """
)
def fanout_siblings(spark, sf_dir):
    found = tables(feeds.sales_orders(spark, sf_dir), BUSINESS.entity("sales_order"))
    parts = [("sales_order_detail", "quantity"), ("sales_order_shipment", "shipped")]
    details, shipments = [
        found[name].select(F.lit(name).alias("table_name"), "parent_id", "id", F.col(column).alias("quantity"))
        for name, column in parts
    ]
    return details.unionByName(shipments)


@query(
    """
    SELECT l_orderkey || '-' || l_linenumber AS id, l_partkey AS part,
           CASE l_returnflag WHEN 'A' THEN l_suppkey WHEN 'N' THEN NULL ELSE l_orderkey END AS parent_id
    FROM lineitem
    """
)
def lineage_setdefault(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    part = wrap("l_partkey")
    line = (
        F.when(flag == "A", record(id=line_id(), Part=part, parent_id="l_suppkey"))
        .when(flag == "N", record(id=line_id(), Part=part, parent_id=F.lit(None).cast("bigint")))
        .otherwise(record(id=line_id(), Part=part))
    )
    packed = nest(feeds.gather(lines, ["l_orderkey"], line=line), ["l_orderkey"], lines="line")
    text = with_parts(record(id="l_orderkey"), Details=F.col("lines"))
    entity = BUSINESS.entity("bill")
    return tables(records(packed, text, "l_orderkey"), entity)["bill_detail"]
