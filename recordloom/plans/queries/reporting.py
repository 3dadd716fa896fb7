"""Reports on tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.audit import freshness, inventory
from recordloom.operators.audit import entity_profile as profile_of
from recordloom.operators.audit import sync_counts as counts_of
from recordloom.operators.catalogue import stage_records
from recordloom.operators.fanout import positioned, survey
from recordloom.operators.flatten import flatten_once
from recordloom.plans import feeds
from recordloom.plans.feeds import record, records, table, wrap
from recordloom.plans.registry import query
from recordloom.sources.families import BUSINESS, FAMILIES, MANUFACTURING


def business_feeds(spark, sf_dir):
    return {
        "customer": feeds.customers(spark, sf_dir),
        "sales_order": feeds.sales_orders(spark, sf_dir),
        "vendor": feeds.vendors(spark, sf_dir),
        "stock_item": feeds.stock_items(spark, sf_dir),
    }


@query(
    """
    SELECT 'bill_of_material' AS table_name, count(*) AS row_count FROM lineitem
    UNION ALL SELECT 'bill_of_material_operation', count(*) FROM lineitem WHERE l_returnflag <> 'R'
    UNION ALL SELECT 'bill_of_material_material', 2 * count(*) FROM lineitem WHERE l_returnflag <> 'R'
    """
)
def sync_counts(spark, sf_dir):
    """A bill per line; one operation with two materials unless the line was returned."""
    materials = F.array(*[F.struct(F.col(c).alias("id")) for c in ("l_partkey", "l_suppkey")])
    operations = F.array(F.struct(F.col("l_orderkey").alias("id"), materials.alias("Material")))
    kept = F.when(F.col("l_returnflag") != "R", operations)
    lines = table(spark, sf_dir, "lineitem")
    bills = records(lines, record(id=feeds.line_id(), Operations=kept), "l_orderkey", "l_linenumber")
    staged, merged = stage_records(bills, "bill_of_material")
    known = survey(positioned(staged), MANUFACTURING.entity("bill_of_material"), merged=merged)
    return spark.createDataFrame(counts_of(known), "table_name string, row_count bigint")


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_synced FROM events")
def freshness_max(spark, sf_dir):
    return freshness(flatten_once(feeds.events(spark, sf_dir), "events", dialect="plain"), "createdAt")


@query(
    """
    SELECT 'projects' AS table_schema, 'event' AS table_name, count(*) AS row_count,
           strftime(max(ts), '%Y-%m-%d') AS last_altered FROM events
    UNION ALL
    SELECT 'business', 'sales_order', count(*), strftime(max(o_orderdate), '%Y-%m-%d') FROM orders
    UNION ALL
    SELECT 'business', 'sales_order_detail', count(*), strftime(max(l_shipdate), '%Y-%m-%d') FROM lineitem
    """
)
def table_inventory(spark, sf_dir):
    def dated(name, key, date):
        rows = table(spark, sf_dir, name)
        text = record(Key=wrap(key), Synced=wrap(F.date_format(date, "yyyy-MM-dd")))
        return flatten_once(records(rows, text, key), name, snake=True)

    found = {
        ("projects", "event"): dated("events", "event_id", "ts"),
        ("business", "sales_order"): dated("orders", "o_orderkey", "o_orderdate"),
        ("business", "sales_order_detail"): dated("lineitem", "l_orderkey", "l_shipdate"),
    }
    return inventory(found, "synced")


@query(
    """
    SELECT 'customer' AS entity, 'ok' AS status, count(*) AS row_count, 0 AS child_count,
           4 AS column_count FROM customer
    UNION ALL SELECT 'sales_order', 'ok', count(DISTINCT l_orderkey),
           count(*) + count(*) FILTER (l_linestatus = 'F'), 2 FROM lineitem
    UNION ALL SELECT 'vendor', 'ok', count(*), 0, 3 FROM supplier
    UNION ALL SELECT 'stock_item', 'ok', count(*), 0, 6 FROM part
    """
)
def entity_profile(spark, sf_dir):
    profiles = []
    for name, feed in business_feeds(spark, sf_dir).items():
        staged, merged = stage_records(feed, name)
        profiles.append(profile_of(positioned(staged), BUSINESS.entity(name), merged=merged))
    return reduce(DataFrame.unionByName, profiles)


# Family, table, position and entity of the declared tables.
DECLARED = """
        ('manufacturing', 'bill_of_material', 0, 'bill_of_material'),
        ('manufacturing', 'bill_of_material_operation', 1, 'bill_of_material'),
        ('manufacturing', 'bill_of_material_material', 2, 'bill_of_material'),
        ('manufacturing', 'production_order', 3, 'production_order'),
        ('manufacturing', 'production_order_detail', 4, 'production_order_detail'),
        ('manufacturing', 'labor_entry', 5, 'labor_entry'),
        ('manufacturing', 'labor_entry_detail', 6, 'labor_entry'),
        ('manufacturing', 'material_entry', 7, 'material_entry'),
        ('manufacturing', 'material_entry_detail', 8, 'material_entry'),
        ('manufacturing', 'work_center', 9, 'work_center'),
        ('manufacturing', 'machine', 10, 'machine'),
        ('manufacturing', 'shift', 11, 'shift'),
        ('business', 'account', 0, 'account'),
        ('business', 'bill', 1, 'bill'),
        ('business', 'bill_detail', 2, 'bill'),
        ('business', 'currency', 3, 'currency'),
        ('business', 'financial_period', 4, 'financial_period'),
        ('business', 'financial_period_detail', 5, 'financial_period'),
        ('business', 'invoice', 6, 'invoice'),
        ('business', 'invoice_detail', 7, 'invoice'),
        ('business', 'journal_transaction', 8, 'journal_transaction'),
        ('business', 'journal_transaction_detail', 9, 'journal_transaction'),
        ('business', 'ledger', 10, 'ledger'),
        ('business', 'payment', 11, 'payment'),
        ('business', 'payment_method', 12, 'payment_method'),
        ('business', 'sub_account', 13, 'sub_account'),
        ('business', 'tax_category', 14, 'tax_category'),
        ('business', 'tax_category_detail', 15, 'tax_category'),
        ('business', 'tax_zone', 16, 'tax_zone'),
        ('business', 'contact', 17, 'contact'),
        ('business', 'contact_attribute', 18, 'contact'),
        ('business', 'employee', 19, 'employee'),
        ('business', 'employee_attribute', 20, 'employee'),
        ('business', 'sales_person', 21, 'sales_person'),
        ('business', 'customer', 22, 'customer'),
        ('business', 'customer_contact', 23, 'customer'),
        ('business', 'customer_attribute', 24, 'customer'),
        ('business', 'customer_class', 25, 'customer_class'),
        ('business', 'customer_location', 26, 'customer_location'),
        ('business', 'sales_invoice', 27, 'sales_invoice'),
        ('business', 'sales_invoice_detail', 28, 'sales_invoice'),
        ('business', 'sales_order', 29, 'sales_order'),
        ('business', 'sales_order_detail', 30, 'sales_order'),
        ('business', 'sales_order_shipment', 31, 'sales_order'),
        ('business', 'sales_order_tax_detail', 32, 'sales_order'),
        ('business', 'shipment', 33, 'shipment'),
        ('business', 'shipment_detail', 34, 'shipment'),
        ('business', 'shipment_package', 35, 'shipment'),
        ('business', 'purchase_order', 36, 'purchase_order'),
        ('business', 'purchase_order_detail', 37, 'purchase_order'),
        ('business', 'purchase_order_tax_detail', 38, 'purchase_order'),
        ('business', 'purchase_receipt', 39, 'purchase_receipt'),
        ('business', 'purchase_receipt_detail', 40, 'purchase_receipt'),
        ('business', 'vendor', 41, 'vendor'),
        ('business', 'vendor_contact', 42, 'vendor'),
        ('business', 'vendor_attribute', 43, 'vendor'),
        ('business', 'vendor_class', 44, 'vendor_class'),
        ('business', 'inventory_issue', 45, 'inventory_issue'),
        ('business', 'inventory_issue_detail', 46, 'inventory_issue'),
        ('business', 'inventory_receipt', 47, 'inventory_receipt'),
        ('business', 'inventory_receipt_detail', 48, 'inventory_receipt'),
        ('business', 'non_stock_item', 49, 'non_stock_item'),
        ('business', 'non_stock_item_attribute', 50, 'non_stock_item'),
        ('business', 'non_stock_item_cross_ref', 51, 'non_stock_item'),
        ('business', 'physical_inventory_review', 52, 'physical_inventory_review'),
        ('business', 'physical_inventory_review_detail', 53, 'physical_inventory_review'),
        ('business', 'stock_item', 54, 'stock_item'),
        ('business', 'stock_item_attribute', 55, 'stock_item'),
        ('business', 'stock_item_warehouse_detail', 56, 'stock_item'),
        ('business', 'stock_item_cross_ref', 57, 'stock_item'),
        ('business', 'stock_item_replenishment', 58, 'stock_item'),
        ('business', 'warehouse', 59, 'warehouse'),
        ('business', 'warehouse_location', 60, 'warehouse'),
        ('business', 'item_class', 61, 'item_class'),
        ('business', 'units_of_measure', 62, 'units_of_measure'),
        ('projects', 'account', 0, 'account'),
        ('projects', 'job', 1, 'job'),
        ('projects', 'task', 2, 'task'),
        ('projects', 'contact', 3, 'contact'),
        ('projects', 'event', 4, 'event'),
        ('projects', 'location', 5, 'location'),
        ('projects', 'payment', 6, 'payment'),
        ('projects', 'cost_item', 7, 'cost_item'),
        ('projects', 'daily_log', 8, 'daily_log'),
        ('projects', 'comment', 9, 'comment'),
        ('projects', 'document', 10, 'document'),
        ('projects', 'file', 11, 'file')
"""

DECLARED_SQL = f"""
    WITH declared(family, table_name, position, entity) AS (VALUES {DECLARED}),
    counted AS (
        SELECT 'business' AS family, 'customer' AS table_name, count(*) AS n FROM customer
        UNION ALL SELECT 'business', 'vendor', count(*) FROM supplier
        UNION ALL SELECT 'business', 'stock_item', count(*) FROM part
        UNION ALL SELECT 'business', 'sales_order', count(DISTINCT l_orderkey) FROM lineitem
        UNION ALL SELECT 'business', 'sales_order_detail', count(*) FROM lineitem
        UNION ALL SELECT 'business', 'sales_order_shipment', count(*) FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT 'projects', 'event', count(*) FROM events
        UNION ALL SELECT 'manufacturing', 'bill_of_material', count(DISTINCT l_orderkey) FROM lineitem
        UNION ALL SELECT 'manufacturing', 'bill_of_material_operation', count(DISTINCT (l_orderkey, l_returnflag))
                  FROM lineitem
        UNION ALL SELECT 'manufacturing', 'bill_of_material_material', count(*) FROM lineitem
    )
    SELECT family, table_name, position, entity, 'id' AS primary_key, coalesce(n, 0) AS row_count
    FROM declared LEFT JOIN counted USING (family, table_name)
    """


@query(DECLARED_SQL)
def declared_tables(spark, sf_dir):
    """Every declared table with its key, and the rows a run would emit for it from the given data.

    The counts come from the pass that surveys a feed; nothing is shuffled for them.
    """
    found = {
        "manufacturing": {"bill_of_material": feeds.bills(spark, sf_dir)},
        "business": business_feeds(spark, sf_dir),
        "projects": {"event": feeds.events(spark, sf_dir)},
    }
    counts = {}
    for family in FAMILIES:
        for name, feed in found[family.name].items():
            staged, merged = stage_records(feed, name, shredded=False)  # one pass reads it
            known = survey(positioned(staged), family.entity(name), family.dialect, merged)
            counts.update({(family.name, table): n for table, n in counts_of(known)})
    declared = [
        (*row, position, counts.get(row[:2], 0)) for f in FAMILIES for position, row in enumerate(f.declared_tables())
    ]
    schema = "family string, table_name string, entity string, primary_key string, position bigint, row_count bigint"
    return spark.createDataFrame(declared, schema)
