"""Whole runs into a table store, in batch and as a stream."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.functions.naming import snake_case
from recordloom.operators.audit import inventory, operation_summary
from recordloom.plans import feeds
from recordloom.plans.feeds import table
from recordloom.plans.queries.reporting import DECLARED, business_feeds
from recordloom.plans.queries.scanning import paged
from recordloom.plans.registry import query
from recordloom.plans.sync import SyncFailed, given, landed, sync
from recordloom.session import scratch, stage
from recordloom.sinks.store import TableStore
from recordloom.sources.entities import Family
from recordloom.sources.families import BUSINESS, MANUFACTURING, PROJECTS
from recordloom.sources.pages import cursor_body, write_packed_pages
from recordloom.streaming.ingest import ingest, landing_stream, page_stream


def new_store(spark):
    return TableStore(spark, scratch(spark, "store"))


@query(
    """
    SELECT 'customer' AS table_name, count(*) AS upserts, count(*) AS row_count FROM customer
    UNION ALL SELECT 'vendor', count(*), count(*) FROM supplier
    UNION ALL SELECT 'stock_item', count(*), count(*) FROM part
    UNION ALL SELECT 'event', count(*), count(*) FROM events
    UNION ALL SELECT 'sales_order', count(DISTINCT l_orderkey), count(DISTINCT l_orderkey) FROM lineitem
    UNION ALL SELECT 'sales_order_detail', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
    UNION ALL SELECT 'sales_order_shipment', count(*), count(DISTINCT (l_orderkey, l_linenumber))
              FROM lineitem WHERE l_linestatus = 'F'
    UNION ALL SELECT 'bill_of_material', count(DISTINCT l_orderkey), count(DISTINCT l_orderkey) FROM lineitem
    UNION ALL SELECT 'bill_of_material_operation', count(DISTINCT (l_orderkey, l_returnflag)),
              count(DISTINCT (l_orderkey, l_returnflag)) FROM lineitem
    UNION ALL SELECT 'bill_of_material_material', count(*), count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
    """
)
def sync_all_counts(spark, sf_dir):
    """All three families into one store; every table that got rows."""
    store = new_store(spark)
    sync(store, MANUFACTURING, given({"bill_of_material": feeds.bills(spark, sf_dir)}))
    sync(store, BUSINESS, given(business_feeds(spark, sf_dir)))
    sync(store, PROJECTS, given({"event": feeds.events(spark, sf_dir)}))
    done = store.commits().filter("status = 'committed' AND upserts > 0")
    return done.select("table_name", "upserts", "row_count")


@query(
    """
    SELECT 'business' AS family, 'account' AS table_name, n_nationkey::BIGINT AS id, n_name AS name FROM nation
    UNION ALL SELECT 'projects', 'account', r_regionkey, r_name FROM region
    UNION ALL SELECT 'business', 'contact', c_custkey, c_name FROM customer
    UNION ALL SELECT 'projects', 'contact', s_suppkey, s_name FROM supplier
    UNION ALL SELECT 'business', 'payment', o_orderkey, o_orderstatus FROM orders
    UNION ALL SELECT 'projects', 'payment', event_id, event_type FROM events
    """
)
def sync_shared_names(spark, sf_dir):
    """Two families that declare tables of the same names, in one store."""
    kinds = {
        ("business", "account"): ("nation", "n_nationkey", "n_name", "Description"),
        ("projects", "account"): ("region", "r_regionkey", "r_name", "name"),
        ("business", "contact"): ("customer", "c_custkey", "c_name", "DisplayName"),
        ("projects", "contact"): ("supplier", "s_suppkey", "s_name", "name"),
        ("business", "payment"): ("orders", "o_orderkey", "o_orderstatus", "Status"),
        ("projects", "payment"): ("events", "event_id", "event_type", "type"),
    }
    store = new_store(spark)
    for family in (BUSINESS, PROJECTS):
        frames = {}
        for (owner, name), (source, key, text, label) in kinds.items():
            if owner == family.name:
                value = feeds.wrap(text) if family is BUSINESS else F.col(text)
                rows = table(spark, sf_dir, source)
                frames[name] = feeds.records(rows, feeds.record(id=key, **{label: value}), key)
        only = tuple(family.entity(name) for name in frames)
        sync(store, replace(family, entities=only), given(frames))
    found = []
    for (family, name), (*_, label) in kinds.items():
        rows = store.table(name, family)
        column = snake_case(label)
        shown = F.col(column) if column in rows.columns else F.lit(None).cast("string")
        found.append(rows.select(F.lit(family).alias("family"), F.lit(name).alias("table_name"), "id", shown.alias("name")))
    return reduce(DataFrame.unionByName, found)


@query(
    """
    SELECT 1 AS position, 'customer' AS entity, 3::BIGINT AS tables, count(*) AS upserts FROM customer
    UNION ALL SELECT 2, 'vendor', 3, count(*) FROM supplier
    UNION ALL SELECT 3, 'stock_item', 5, count(*) FROM part
    """
)
def commit_per_entity(spark, sf_dir):
    """Landed pages to tables; one commit per entity, in declared order."""
    root = scratch(spark, "landed")
    sources = {
        "Customer": (table(spark, sf_dir, "customer"), "c_custkey", feeds.wrap("c_name")),
        "Vendor": (table(spark, sf_dir, "supplier"), "s_suppkey", feeds.wrap("s_name")),
        "StockItem": (table(spark, sf_dir, "part"), "p_partkey", feeds.wrap("p_name")),
    }
    for collection, (rows, key, name) in sources.items():
        lists = paged(rows, feeds.record(id=key, Name=name), [key])
        write_packed_pages(lists.withColumnRenamed("list", "body"), f"{root}/entity={collection}")
    entities = tuple(BUSINESS.entity(name) for name in ("customer", "vendor", "stock_item"))
    family = Family("sales", BUSINESS.dialect, BUSINESS.paging, entities)
    store = new_store(spark)
    sync(store, family, landed(spark, root, family))
    commits = store.commits().groupBy("position", "entity")
    counted = commits.agg(F.count("*").alias("tables"), F.sum("upserts").alias("upserts"))
    return counted.withColumn("position", F.col("position") + 1)


@query(
    """
    SELECT 'customer' AS entity, 'committed' AS status, count(*) AS upserts FROM customer
    UNION ALL SELECT 'sales_order', 'failed', 0
    """
)
def audit_status(spark, sf_dir):
    """Orders fail on cut-off JSON: customers stay, vendors are never started."""
    orders = table(spark, sf_dir, "orders")
    cut = feeds.records(orders, F.substring(feeds.record(id="o_orderkey"), 1, 5), "o_orderkey")
    store = new_store(spark)
    try:
        sync(store, BUSINESS, given({**business_feeds(spark, sf_dir), "sales_order": cut}))
    except SyncFailed:
        pass
    report = store.commits().filter("status <> 'missing'").groupBy("entity", "status")
    return report.agg(F.coalesce(F.sum("upserts"), F.lit(0)).alias("upserts"))


@query(
    f"""
    WITH declared(family, table_name, position, entity) AS (VALUES {DECLARED}),
    tables AS (
        SELECT count(*) AS n FROM customer UNION ALL SELECT count(*) FROM supplier UNION ALL SELECT count(*) FROM part
        UNION ALL SELECT count(DISTINCT l_orderkey) FROM lineitem UNION ALL SELECT count(*) FROM lineitem
        UNION ALL SELECT count(*) FROM lineitem WHERE l_linestatus = 'F')
    SELECT 'upserts' AS operation, sum(n)::BIGINT AS operations FROM tables
    UNION ALL SELECT 'updates', 0 UNION ALL SELECT 'deletes', 0 UNION ALL SELECT 'truncates', 0
    UNION ALL SELECT 'schema_changes', count(*) FROM tables WHERE n > 0
    UNION ALL SELECT 'checkpoints', count(DISTINCT entity) FROM declared WHERE family = 'business'
    """
)
def op_summary(spark, sf_dir):
    """One run of the business family: a table made is a schema change, an entity scanned a checkpoint."""
    store = new_store(spark)
    sync(store, BUSINESS, given(business_feeds(spark, sf_dir)))
    return operation_summary(store.commits())


@query(
    """
    SELECT event_id AS id, event_type AS type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
           user_id AS organization_id, 'user ' || user_id AS organization_name
    FROM events
    """
)
def stream_upsert(spark, sf_dir):
    """Two scheduled runs: stale errors and clicks first, then all events."""
    root = scratch(spark, "stream")
    source = table(spark, sf_dir, "events")
    stale = source.filter("event_type IN ('error', 'click')").withColumn("event_type", F.lit("pending"))
    store = new_store(spark)
    for events in (stale, source):
        lists = stage(paged(events, feeds.event_text(), ["event_id"]), "pages")
        last = lists.agg(F.max("page")).first()[0]
        following = F.when(F.col("page") < last, F.col("page") + 1)
        pages = lists.select("page", cursor_body(F.col("list"), "events", following).alias("body"))
        pages.write.mode("append").parquet(f"{root}/pages")
        stream = page_stream(spark, f"{root}/pages")
        ingest(stream, store, PROJECTS, PROJECTS.entity("event"), f"{root}/checkpoint").awaitTermination()
    return store.table("event").drop("_synced_at")


def event_landing(spark, events, folder, landing):
    """Cursor pages of events as one landing."""
    lists = stage(paged(events, feeds.event_text(), ["event_id"]), "pages")
    last = lists.agg(F.max("page")).first()[0]
    following = F.when(F.col("page") < last, F.col("page") + 1)
    pages = lists.select("page", cursor_body(F.col("list"), "events", following).alias("body"))
    pages.write.parquet(f"{folder}/run_id={landing}")


LANDINGS_SQL = """
    SELECT event_id AS id, CASE WHEN event_id % 3 = 0 THEN event_type ELSE 'pending' END AS type,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
           user_id AS organization_id, 'user ' || user_id AS organization_name
    FROM events
    """


def two_landings(spark, sf_dir):
    """An older landing of all events, still pending, and a newer one of every third, on earlier pages."""
    folder = f"{scratch(spark, 'landings')}/entity=events"
    source = table(spark, sf_dir, "events")
    event_landing(spark, source.withColumn("event_type", F.lit("pending")), folder, 1)
    event_landing(spark, source.filter("event_id % 3 = 0"), folder, 2)
    return folder


@query(LANDINGS_SQL)
def stream_two_landings(spark, sf_dir):
    """Two landings wait for one trigger: the newer row wins wherever its page stands."""
    folder, store = two_landings(spark, sf_dir), new_store(spark)
    stream = landing_stream(spark, folder)
    ingest(stream, store, PROJECTS, PROJECTS.entity("event"), scratch(spark, "checkpoint")).awaitTermination()
    return store.table("event").drop("_synced_at")


@query(LANDINGS_SQL)
def batch_two_landings(spark, sf_dir):
    """The same two landings read by one batch run."""
    folder, store = two_landings(spark, sf_dir), new_store(spark)
    family = replace(PROJECTS, entities=(PROJECTS.entity("event"),))
    sync(store, family, landed(spark, folder.removesuffix("/entity=events"), family))
    return store.table("event").drop("_synced_at")


@query(
    """
    SELECT 'bill' AS table_name, count(DISTINCT l_orderkey) AS upserts, 0::BIGINT AS quarantined FROM lineitem
    UNION ALL
    SELECT 'bill_detail', count(*) FILTER (l_returnflag = 'A'), count(*) FILTER (l_returnflag <> 'A') FROM lineitem
    """
)
def quarantine_rows(spark, sf_dir):
    """Lines that are no objects (N) or have no id (R) are set aside and counted."""
    flag = F.col("l_returnflag")
    text = F.when(flag == "N", F.to_json(F.array("l_partkey"))).when(
        flag == "R", feeds.record(Part=feeds.wrap("l_partkey"))
    )
    lines = feeds.gather(table(spark, sf_dir, "lineitem"), ["l_orderkey"], line=F.coalesce(text, feeds.line_text()))
    packed = feeds.nest(lines, ["l_orderkey"], lines="line")
    bill = feeds.with_parts(feeds.record(id="l_orderkey"), Details=F.col("lines"))
    store = new_store(spark)
    family = Family("purchases", BUSINESS.dialect, BUSINESS.paging, (BUSINESS.entity("bill"),))
    sync(store, family, given({"bill": feeds.records(packed, bill, "l_orderkey")}, shredded=False))
    return with_rows_aside(store)


def with_rows_aside(store):
    """Upserts of the log, and the rows that were really set aside; the log must count as many."""
    aside = store.quarantined().groupBy(F.col("table").alias("table_name")).agg(F.count("*").alias("aside"))
    both = store.commits().select("table_name", "upserts", F.col("quarantined").alias("logged"))
    both = both.join(aside, "table_name", "left")
    agreed = F.when(F.col("logged") == F.coalesce("aside", F.lit(0)), F.col("logged"))
    return both.select("table_name", "upserts", agreed.alias("quarantined"))


@query(
    """
    SELECT 'bill_of_material' AS table_name, count(DISTINCT l_orderkey) AS upserts, 0::BIGINT AS quarantined FROM lineitem
    UNION ALL
    SELECT 'bill_of_material_operation', count(DISTINCT (l_orderkey, l_returnflag)), 0 FROM lineitem
    UNION ALL
    SELECT 'bill_of_material_material', count(*) FILTER (l_returnflag = 'A'),
           count(DISTINCT (l_orderkey, l_returnflag)) FILTER (l_returnflag <> 'A') FROM lineitem
    """
)
def quarantine_grandchildren(spark, sf_dir):
    """Grandchild lists that are an object (N) or a text (R) are set aside with their operation, and counted."""
    keys = ["l_orderkey", "l_returnflag"]
    lines = feeds.gather(table(spark, sf_dir, "lineitem"), keys, keys[:1], line=feeds.line_text())
    operations = feeds.nest(lines, keys, lines="line")
    flag = F.col("l_returnflag")
    material = F.when(flag == "A", F.col("lines")).when(flag == "N", F.lit('{"id":3}')).otherwise(F.lit('"x"'))
    operation = feeds.with_parts(feeds.record(id=feeds.flagged_id()), Material=material)
    nested = feeds.nest(operations, ["l_orderkey"], operations=operation)
    text = feeds.with_parts(feeds.record(id="l_orderkey"), Operations=F.col("operations"))
    store = new_store(spark)
    family = replace(MANUFACTURING, entities=(MANUFACTURING.entity("bill_of_material"),))
    sync(store, family, given({"bill_of_material": feeds.records(nested, text, "l_orderkey")}, shredded=False))
    return with_rows_aside(store)


def event_pages(spark, events):
    """Cursor pages of events, numbered from 0."""
    lists = stage(paged(events, feeds.event_text(), ["event_id"]), "pages")
    last = lists.agg(F.max("page")).first()[0]
    following = F.when(F.col("page") < last, F.col("page") + 1)
    return stage(lists.select("page", cursor_body(F.col("list"), "events", following).alias("body")), "bodies"), last


@query(
    """
    SELECT event_id AS id, event_type AS type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
           user_id AS organization_id, 'user ' || user_id AS organization_name
    FROM events
    """
)
def stream_landing_in_parts(spark, sf_dir):
    """One landing over three triggers: its first quarter, then every second page of the rest, then what lies between."""
    folder = f"{scratch(spark, 'landings')}/entity=events"
    pages, last = event_pages(spark, table(spark, sf_dir, "events"))
    first, odd = F.col("page") <= last // 4, F.col("page") % 2 == 1
    store, checkpoint = new_store(spark), scratch(spark, "checkpoint")
    for part in (first, ~first & odd, ~first & ~odd):
        pages.filter(part).write.mode("append").parquet(f"{folder}/run_id=1")
        ingest(landing_stream(spark, folder), store, PROJECTS, PROJECTS.entity("event"), checkpoint).awaitTermination()
    return store.table("event").drop("_synced_at")


@query(LANDINGS_SQL)
def stream_late_landing(spark, sf_dir):
    """The older landing, all pending, arrives a trigger after the newer one of every third event: newer rows stay."""
    folder = f"{scratch(spark, 'landings')}/entity=events"
    source = table(spark, sf_dir, "events")
    landings = {2: source.filter("event_id % 3 = 0"), 1: source.withColumn("event_type", F.lit("pending"))}
    store, checkpoint = new_store(spark), scratch(spark, "checkpoint")
    for landing, events in landings.items():
        event_landing(spark, events, folder, landing)
        ingest(landing_stream(spark, folder), store, PROJECTS, PROJECTS.entity("event"), checkpoint).awaitTermination()
    return store.table("event").drop("_synced_at")


@query(
    """
    WITH pages AS (SELECT (count(*) + 99) // 100 AS n FROM events)
    SELECT 1::BIGINT AS run_id, n + 1 + i AS page, 'after the end' AS reason FROM pages, range(n) t(i)
    UNION ALL SELECT 2, i, 'no first page' FROM pages, range(1, n) t(i)
    UNION ALL SELECT 3, i, 'after a gap' FROM pages, range(3, n) t(i)
    """
)
def unread_pages(spark, sf_dir):
    """Three landings of the same pages: one with pages past its end, one without its first, one without its third."""
    root = scratch(spark, "landings")
    pages, last = event_pages(spark, table(spark, sf_dir, "events"))
    strays = pages.withColumn("page", F.col("page") + last + 2)
    landings = {1: pages.unionByName(strays), 2: pages.filter("page <> 0"), 3: pages.filter("page <> 2")}
    for landing, rows in landings.items():
        rows.write.parquet(f"{root}/entity=events/run_id={landing}")
    store = new_store(spark)
    family = replace(PROJECTS, entities=(PROJECTS.entity("event"),))
    sync(store, family, landed(spark, root, family))
    return store.unread().select("run_id", "page", "reason")


@query(
    """
    WITH counted AS (
        SELECT 'business' AS table_schema, 'customer' AS table_name, count(*) AS row_count, true AS by_last_run FROM customer
        UNION ALL SELECT 'business', 'stock_item', count(*), true FROM part
        UNION ALL SELECT 'business', 'vendor', count(*), false FROM supplier
        UNION ALL SELECT 'business', 'sales_order', count(DISTINCT l_orderkey), false FROM lineitem
        UNION ALL SELECT 'business', 'sales_order_detail', count(DISTINCT (l_orderkey, l_linenumber)), false FROM lineitem
        UNION ALL SELECT 'business', 'sales_order_shipment', count(DISTINCT (l_orderkey, l_linenumber)), false
                  FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT 'projects', 'event', count(*), false FROM events)
    SELECT *, table_name = 'stock_item' AS changed_by_last_run FROM counted
    """
)
def store_inventory(spark, sf_dir):
    """Inventory of a whole store, from its log: a run of all feeds, then one of customers as they were and items renamed."""
    store = new_store(spark)
    feed = business_feeds(spark, sf_dir)
    sync(store, PROJECTS, given({"event": feeds.events(spark, sf_dir)}))
    sync(store, BUSINESS, given(feed))
    first = store.commits().agg(F.max("at")).first()[0]
    parts = table(spark, sf_dir, "part")
    items = feeds.records(parts, feeds.record(id="p_partkey", Name=feeds.wrap(F.upper("p_name"))), "p_partkey")
    sync(store, BUSINESS, given({"customer": feed["customer"], "stock_item": items}))
    found = store.inventory()
    later = [F.coalesce(F.col(c) > F.lit(first), F.lit(False)).alias(n) for c, n in
             (("last_synced", "by_last_run"), ("last_changed", "changed_by_last_run"))]
    return found.select("table_schema", "table_name", "row_count", *later).filter("row_count > 0")
