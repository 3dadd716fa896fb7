"""Joins on the keys normalisation leaves in the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators.flatten import flatten_once
from recordloom.operators.joins import child_to_parent, line_to_order
from recordloom.plans import feeds
from recordloom.plans.feeds import line_id, nest, record, records, table, with_parts, wrap
from recordloom.plans.queries.fanning import CUSTOMER, read, tables
from recordloom.plans.registry import query
from recordloom.sources.families import BUSINESS


def invoice_lines(spark, sf_dir):
    """Invoice lines, an invoice per order; returned ones name no order."""
    lines = table(spark, sf_dir, "lineitem")
    order_nbr = F.when(F.col("l_returnflag") != "R", F.col("l_orderkey"))
    line = record(id=line_id(), OrderNbr=wrap(order_nbr), Quantity=wrap("l_quantity"))
    packed = nest(feeds.gather(lines, ["l_orderkey"], line=line), ["l_orderkey"], lines="line")
    invoice = with_parts(record(id="l_orderkey"), Details=F.col("lines"))
    found = tables(records(packed, invoice, "l_orderkey"), BUSINESS.entity("sales_invoice"))
    return found["sales_invoice_detail"]


def order_states(rows, place):
    """Flat orders; of rows that repeat an order, the one of the last page counts."""
    order = record(OrderNbr=wrap("o_orderkey"), Status=wrap("o_orderstatus"), Total=wrap("o_totalprice"))
    flat = flatten_once(records(rows, order, place), "orders", snake=True, carry=["page"])
    return flat.select(
        F.col("order_nbr").alias("order_key"),
        F.col("status").alias("order_status"),
        F.col("total").alias("order_total"),
        F.col("page").alias("_page"),
    )


@query(
    """
    SELECT l_orderkey || '-' || l_linenumber AS id, l_orderkey AS parent_id, l_quantity AS quantity,
           CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS order_nbr,
           o_orderstatus AS order_status, o_totalprice AS order_total
    FROM lineitem LEFT JOIN orders ON l_returnflag <> 'R' AND l_orderkey = o_orderkey
    """
)
def join_line_to_order(spark, sf_dir):
    orders = order_states(table(spark, sf_dir, "orders"), F.lit(0))
    return line_to_order(invoice_lines(spark, sf_dir), orders, "order_nbr", "order_key", ["_page"]).drop("order_key")


@query(
    """
    SELECT l_orderkey || '-' || l_linenumber AS id, l_orderkey AS parent_id, l_quantity AS quantity,
           CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS order_nbr,
           o_orderstatus AS order_status, o_totalprice + 1 AS order_total
    FROM lineitem LEFT JOIN orders ON l_returnflag <> 'R' AND l_orderkey = o_orderkey
    """
)
def join_line_to_repeated_order(spark, sf_dir):
    """Every order comes twice; the later one, with another total, is joined, and no line is doubled."""
    first = table(spark, sf_dir, "orders").withColumn("place", F.lit(0))
    second = first.withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("place", F.lit(1))
    orders = order_states(first.unionByName(second), "place")
    return line_to_order(invoice_lines(spark, sf_dir), orders, "order_nbr", "order_key", ["_page"]).drop("order_key")


@query(
    """
    SELECT o_custkey || '-' || o_orderkey // 1024 AS parent_id, o_orderkey AS id, o_orderstatus AS status,
           o_totalprice AS total, c_name AS parent_name
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')
    """
)
def join_child_parent(spark, sf_dir):
    parents, orders = read(feeds.customers_with_orders(spark, sf_dir), CUSTOMER)
    customers = parents.rows(snake=True).select("id", "name")
    return child_to_parent(orders.rows(snake=True).drop("_at"), customers)
