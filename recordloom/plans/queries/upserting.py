"""Keyed upserts and what they change."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators.audit import change_counts
from recordloom.operators.upsert import upsert
from recordloom.plans import feeds
from recordloom.plans.feeds import line_id, record, records, table, wrap
from recordloom.plans.queries.fanning import read
from recordloom.plans.registry import query
from recordloom.plans.sync import given, sync
from recordloom.session import scratch
from recordloom.sinks.store import TableStore
from recordloom.sources.entities import Entity, Family

ORDER = Entity("order", "Order")


def order_rows(rows):
    """Flat orders of one run."""
    text = record(
        id="o_orderkey", Status=wrap("o_orderstatus"), Total=wrap("o_totalprice"), Priority=wrap("o_orderpriority")
    )
    return next(read(records(rows, text, "o_orderkey"), ORDER)).rows(snake=True)


@query(
    """
    SELECT l_orderkey || '-' || l_linenumber AS id, l_partkey AS part, l_suppkey AS supplier,
           l_quantity AS quantity, l_extendedprice AS price
    FROM (SELECT *, row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC
          ) AS newest FROM lineitem)
    WHERE newest = 1
    """
)
def upsert_last_wins(spark, sf_dir):
    at = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    batch = table(spark, sf_dir, "lineitem").select(
        line_id().alias("id"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        at.alias("_at"),
    )
    return upsert(None, batch, ["id"], ["_at"])


@query(
    """
    SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1000 END AS total
    FROM orders
    """
)
def upsert_no_delete(spark, sf_dir):
    """The second run lacks finished orders and reprices the others."""
    orders = table(spark, sf_dir, "orders")
    open_orders = orders.filter("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    first = upsert(None, order_rows(orders), ["id"], ["_at"])
    return upsert(first, order_rows(open_orders), ["id"], ["_at"])


@query(
    """
    SELECT c_custkey AS id, c_name AS customer_name, c_acctbal AS credit_balance,
           c_nationkey::BIGINT AS main_contact_address_nation
    FROM customer
    """
)
def upsert_idempotent(spark, sf_dir):
    """Two runs over the same customers leave the table of one."""
    family = Family("sales", "wrapped", "offset", (Entity("customer", "Customer"),))
    store = TableStore(spark, scratch(spark, "store"))
    source = given({"customer": feeds.customers(spark, sf_dir)})
    sync(store, family, source)
    sync(store, family, source)
    return store.table("customer").drop("_synced_at")


@query(
    """
    WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
                 WHERE o_orderdate < DATE '2000-01-01'),
         new AS (SELECT o_orderkey, o_orderstatus,
                        CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END
                            AS o_totalprice
                 FROM orders WHERE o_orderstatus <> 'P' OR o_orderdate >= DATE '2000-01-01')
    SELECT CASE WHEN old.o_orderkey IS NULL THEN 'added' WHEN new.o_orderkey IS NULL THEN 'absent'
                WHEN old.o_totalprice = new.o_totalprice THEN 'same' ELSE 'changed' END AS change_kind,
           count(*) AS row_count
    FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey GROUP BY ALL
    """
)
def changed_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    repriced = F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    late = F.col("o_orderdate") >= F.expr("timestamp_ntz'2000-01-01'")
    old = orders.filter(~late)
    new = orders.filter((F.col("o_orderstatus") != "P") | late).withColumn("o_totalprice", repriced)
    return change_counts(order_rows(old).drop("_at"), order_rows(new).drop("_at"), ["id"])


CHANGED_SQL = """
    SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority,
           CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 3 WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1
                ELSE o_totalprice END AS total
    FROM orders
    UNION ALL
    SELECT -o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
    WHERE o_orderkey % 97 = 0 AND o_orderkey > 0
"""


def order_feed(rows):
    text = record(
        id="o_orderkey", Status=wrap("o_orderstatus"), Total=wrap("o_totalprice"), Priority=wrap("o_orderpriority")
    )
    return given({"order": records(rows, text, F.abs("o_orderkey"))})


SALES = Family("sales", "wrapped", "offset", (ORDER,))


def small_batches(spark, sf_dir, **options):
    """A store of all orders after two runs of few: some repriced, some new under the negative key."""
    orders = table(spark, sf_dir, "orders")
    store = TableStore(spark, scratch(spark, "store"), **options)
    sync(store, SALES, order_feed(orders))

    def priced(rows, more):
        return rows.withColumn("o_totalprice", F.col("o_totalprice") + more)

    few = orders.filter("o_orderkey % 97 = 0")
    added = few.filter("o_orderkey > 0").withColumn("o_orderkey", -F.col("o_orderkey"))
    sync(store, SALES, order_feed(priced(few, 1).unionByName(added)))
    sync(store, SALES, order_feed(priced(orders.filter("o_orderkey % 89 = 0"), 3)))
    return store


@query(CHANGED_SQL)
def upsert_deltas(spark, sf_dir):
    """Small batches stay beside their base; the newest row of a key is read."""
    return small_batches(spark, sf_dir).table("order").drop("_synced_at")


@query(CHANGED_SQL)
def upsert_compacted(spark, sf_dir):
    """The same after compaction, in buckets split as the table grew, and without the versions before."""
    store = small_batches(spark, sf_dir, buckets=2, bucket_bytes=64 << 10)
    store.compact("order", "sales")
    store.sweep()
    return store.table("order").drop("_synced_at")


@query(
    """
    WITH old AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < DATE '2000-01-01'),
         new AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END
                            AS o_totalprice
                 FROM orders WHERE o_orderstatus <> 'P' OR o_orderdate >= DATE '2000-01-01')
    SELECT 1::BIGINT AS run, count(*) AS added, 0::BIGINT AS changed, 0::BIGINT AS same FROM old
    UNION ALL
    SELECT 2, count(*) FILTER (old.o_orderkey IS NULL), count(*) FILTER (old.o_totalprice <> new.o_totalprice),
           count(*) FILTER (old.o_totalprice = new.o_totalprice)
    FROM new LEFT JOIN old ON old.o_orderkey = new.o_orderkey
    """
)
def run_changes(spark, sf_dir):
    """What each run added, changed and found unchanged, as the commit log has it."""
    orders = table(spark, sf_dir, "orders")
    late = F.col("o_orderdate") >= F.expr("timestamp_ntz'2000-01-01'")
    repriced = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    store = TableStore(spark, scratch(spark, "store"))
    sync(store, SALES, order_feed(orders.filter(~late)))
    sync(store, SALES, order_feed(orders.filter((F.col("o_orderstatus") != "P") | late).withColumn("o_totalprice", repriced)))
    return store.commits().select("run", "added", "changed", "same")


@query(
    """
    SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS foo_bar,
           CASE WHEN c_custkey % 3 = 1 THEN c_acctbal + 1 ELSE c_acctbal END AS foo_bar_2
    FROM customer WHERE c_custkey % 3 < 2
    """
)
def column_labels_kept(spark, sf_dir):
    """Two names that give one label: each keeps its column in runs that bring only one of them, or both."""
    customers = table(spark, sf_dir, "customer")
    both = record(id="c_custkey", FooBar=wrap("c_name"), Foo_Bar=wrap("c_acctbal"))
    one = record(id="c_custkey", Foo_Bar=wrap(F.col("c_acctbal") + 1))
    store = TableStore(spark, scratch(spark, "store"))
    family = Family("sales", "wrapped", "offset", (Entity("customer", "Customer"),))
    for text, rest in ((both, 1), (one, 1), (both, 0)):
        chosen = customers.filter(F.col("c_custkey") % 3 == rest)
        sync(store, family, given({"customer": records(chosen, text, "c_custkey")}))
    return store.table("customer").drop("_synced_at")
