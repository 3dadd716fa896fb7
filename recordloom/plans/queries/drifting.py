"""Columns that come, go, change name and change type between runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators.drift import renamed, union_drift
from recordloom.operators.flatten import flatten_once
from recordloom.plans.feeds import record, records, table, wrap
from recordloom.plans.registry import query

CHANGE = "1999-01-01"  # the source changes shape on this day


def _halves(spark, sf_dir, before, after):
    """Orders flattened in two runs, split by date."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(CHANGE).cast("timestamp_ntz")
    parts = ((orders.filter(early), before), (orders.filter(~early), after))
    return [flatten_once(records(rows, text, "o_orderkey"), "orders", snake=True) for rows, text in parts]


def _order(**more):
    return record(id="o_orderkey", Total=wrap("o_totalprice"), **more)


@query(
    """
    SELECT o_orderkey AS id, o_totalprice AS total,
           CASE WHEN o_orderdate >= DATE '1999-01-01' THEN o_orderpriority END AS priority
    FROM orders
    """
)
def drift_add_column(spark, sf_dir):
    return union_drift(*_halves(spark, sf_dir, _order(), _order(Priority=wrap("o_orderpriority"))))


@query(
    """
    SELECT o_orderkey AS id, o_totalprice AS total,
           CASE WHEN o_orderdate < DATE '1999-01-01' THEN o_orderpriority END AS priority
    FROM orders
    """
)
def drift_drop_column(spark, sf_dir):
    return union_drift(*_halves(spark, sf_dir, _order(Priority=wrap("o_orderpriority")), _order()))


@query(
    """
    SELECT o_orderkey AS id, o_totalprice AS total,
           CASE WHEN o_orderdate < DATE '1999-01-01' THEN o_orderpriority END AS priority,
           CASE WHEN o_orderdate >= DATE '1999-01-01' THEN o_orderpriority END AS order_priority,
           o_orderpriority AS current_priority
    FROM orders
    """
)
def drift_rename_coalesce(spark, sf_dir):
    before, after = _order(Priority=wrap("o_orderpriority")), _order(OrderPriority=wrap("o_orderpriority"))
    both = union_drift(*_halves(spark, sf_dir, before, after))
    return both.withColumn("current_priority", renamed("order_priority", "priority"))


@query(
    """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END AS amount,
           CASE WHEN o_orderstatus = 'F' THEN o_custkey::VARCHAR
                WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE 'true' END AS reference,
           CASE WHEN o_orderdate < DATE '1999-01-01' THEN o_custkey::VARCHAR ELSE o_orderstatus END AS code
    FROM orders
    """
)
def drift_type_widen(spark, sf_dir):
    """Integers and fractions; numbers, text and flags; and two runs that differ."""
    status = F.col("o_orderstatus")

    def orders(code):
        whole = record(id="o_orderkey", Code=code, Amount=wrap(F.floor("o_totalprice")), Reference=wrap("o_custkey"))
        text = record(id="o_orderkey", Code=code, Amount=wrap("o_totalprice"), Reference=wrap("o_orderpriority"))
        flag = record(id="o_orderkey", Code=code, Amount=wrap("o_totalprice"), Reference=wrap(F.lit(True)))
        return F.when(status == "F", whole).when(status == "O", text).otherwise(flag)

    return union_drift(*_halves(spark, sf_dir, orders(wrap("o_custkey")), orders(wrap("o_orderstatus"))))
