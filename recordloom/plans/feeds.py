"""Nested JSON records built from flat tables.

Gives the operators real input of any size: rows become wrapped or plain records
and child rows are nested into their parents. Rows are nested by values only, in
groups that are bounded by nature (the lines of one order) or by a range of unique
keys that is part of the parent's id, so the same rows give the same records however
their files are cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.session import deal, shuffle_partitions

SPAN_BITS = 10  # a customer's orders are nested by ranges of 1,024 order keys


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return deal(rows) if spread else rows


def wrap(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.struct(value.alias("value"))


def record(keep_nulls: bool = True, **fields: Column | str) -> Column:
    """JSON text of one object; NULL fields are written or left out."""
    columns = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in fields.items()]
    return F.to_json(F.struct(*columns), {"ignoreNullFields": str(not keep_nulls).lower()})


def with_parts(head: Column, **parts: Column) -> Column:
    """JSON object ``head`` extended by already encoded values; a NULL part is left out."""
    text = F.substring(head, F.lit(1), F.length(head) - 1)
    for name, part in parts.items():
        text = F.concat(text, F.coalesce(F.concat(F.lit(f',"{name}":'), part), F.lit("")))
    return F.concat(text, F.lit("}"))


def as_list(texts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def gather(children: DataFrame, keys: list[str], by: list[str] | None = None, **texts: Column) -> DataFrame:
    """Keys and texts of the children, those of one key (or what of it ``by`` names) brought together.

    The texts are made before the rows move: inside an aggregate Spark would interpret their expressions row by row.
    The keys must bound their groups.
    """
    made = children.select(*keys, *[text.alias(name) for name, text in texts.items()])
    return made.repartition(shuffle_partitions(children), *(by or keys))


def nest(gathered: DataFrame, keys: list[str], **lists: Column | str) -> DataFrame:
    """One row per key with a sorted JSON list per entry; NULL texts are left out."""
    collected = [as_list(F.sort_array(F.collect_list(text))).alias(name) for name, text in lists.items()]
    return gathered.groupBy(*keys).agg(*collected)


def records(rows: DataFrame, text: Column, page: Column | str, pos: Column | str | int = 0) -> DataFrame:
    """``page, pos, v`` records; every row's place must be its own."""
    page = F.col(page) if isinstance(page, str) else page
    pos = F.col(pos) if isinstance(pos, str) else F.lit(pos) if isinstance(pos, int) else pos
    return rows.select(
        page.cast("bigint").alias("page"), pos.cast("bigint").alias("pos"), F.parse_json(text).alias("v")
    )


# --- the feeds several queries share -------------------------------------------------


def line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def line_text() -> Column:
    return record(
        id=line_id(),
        InventoryID=wrap("l_partkey"),
        Quantity=wrap("l_quantity"),
        Price=wrap("l_extendedprice"),
        Flag=wrap("l_returnflag"),
    )


# Flat feeds are ``spread`` unless few of their records will be made.


def customers(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    """Flat customers, one record each."""
    rows = table(spark, sf_dir, "customer", spread)
    text = record(
        id="c_custkey",
        CustomerName=wrap("c_name"),
        CreditBalance=wrap("c_acctbal"),
        MainContact=F.struct(F.struct(wrap("c_nationkey").alias("Nation")).alias("Address")),
    )
    return records(rows, text, "c_custkey")


def span(key: str) -> Column:
    return F.shiftright(F.col(key), SPAN_BITS)


def customers_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers ⊃ orders, a record per range of order keys. By segment the list is also null, missing or empty.

    The inner join may be split on a hot customer; customers without orders are found from the order table's keys alone.
    """
    orders = table(spark, sf_dir, "orders").withColumn("span", span("o_orderkey"))
    order = record(id="o_orderkey", Status=wrap("o_orderstatus"), Total=wrap("o_totalprice"))
    packed = nest(gather(orders, ["o_custkey", "span"], order=order), ["o_custkey", "span"], orders="order")
    parents = table(spark, sf_dir, "customer")
    owned = packed.join(parents, packed.o_custkey == parents.c_custkey)
    owners = table(spark, sf_dir, "orders").select("o_custkey")
    bare = parents.join(owners, parents.c_custkey == owners.o_custkey, "left_anti")
    rows = owned.unionByName(bare, allowMissingColumns=True)
    segment = F.col("c_mktsegment")
    listed = (
        F.when(segment == "AUTOMOBILE", F.lit("null"))
        .when(segment == "BUILDING", F.lit(None))
        .when(segment == "FURNITURE", F.lit("[]"))
        .otherwise(F.coalesce("orders", F.lit("[]")))
    )
    head = record(id=F.concat_ws("-", "c_custkey", F.coalesce("span", F.lit(0))), Name=wrap("c_name"))
    return records(rows, with_parts(head, Orders=listed), "c_custkey", F.coalesce("span", F.lit(0)))


def flagged_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_returnflag")


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ⊃ return flags ⊃ lines as three-level records.

    The one shuffle on the order serves both nestings.
    """
    keys = ["l_orderkey", "l_returnflag"]
    operations = nest(gather(table(spark, sf_dir, "lineitem"), keys, keys[:1], line=line_text()), keys, lines="line")
    operation = with_parts(record(id=flagged_id()), Material=F.col("lines"))
    nested = nest(operations, ["l_orderkey"], operations=operation)
    text = with_parts(record(id="l_orderkey"), Operations=F.col("operations"))
    return records(nested, text, "l_orderkey")


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ⊃ lines and ⊃ shipments (the lines of status F): two sibling lists."""
    shipment = F.when(F.col("l_linestatus") == "F", record(id=line_id(), Shipped=wrap("l_quantity")))
    lines = gather(table(spark, sf_dir, "lineitem"), ["l_orderkey"], detail=line_text(), shipment=shipment)
    packed = nest(lines, ["l_orderkey"], details="detail", shipments="shipment")
    head = record(id="l_orderkey", Kind=wrap(F.lit("SO")))
    text = with_parts(head, Details=F.col("details"), Shipments=F.col("shipments"))
    return records(packed, text, "l_orderkey")


def stock_items(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    text = record(
        id="p_partkey",
        PartName=wrap("p_name"),
        BrandCode=wrap("p_brand"),
        ItemType=wrap("p_type"),
        PartSize=wrap("p_size"),
        RetailPrice=wrap("p_retailprice"),
    )
    return records(table(spark, sf_dir, "part", spread), text, "p_partkey")


def vendors(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    text = record(id="s_suppkey", VendorName=wrap("s_name"), Balance=wrap("s_acctbal"))
    return records(table(spark, sf_dir, "supplier", spread), text, "s_suppkey")


def event_text() -> Column:
    return record(
        id="event_id",
        type="event_type",
        createdAt=F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        value="value",
        organization=F.struct(F.col("user_id").alias("id"), F.concat(F.lit("user "), "user_id").alias("name")),
    )


def events(spark: SparkSession, sf_dir: str, spread: bool = True) -> DataFrame:
    return records(table(spark, sf_dir, "events", spread), event_text(), "event_id")
