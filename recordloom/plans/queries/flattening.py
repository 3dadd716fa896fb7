"""Nested records to flat columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordloom.operators.catalogue import PLAIN
from recordloom.operators.flatten import flatten_once
from recordloom.plans.feeds import record, records, table, with_parts, wrap
from recordloom.plans.registry import query
from recordloom.sources.families import BUSINESS, PROJECTS


def _links(key: str):
    return F.struct(F.concat(F.lit("/entity/"), F.col(key)).alias("self"))


@query(
    """
    SELECT c_custkey AS id, c_name AS "Name", c_mktsegment AS "Segment", c_acctbal AS "Credit_Balance",
           CAST(NULL AS VARCHAR) AS "Credit_Rules", c_nationkey::BIGINT AS "MainContact_Address_Nation",
           CAST(NULL AS VARCHAR) AS "Note"
    FROM customer
    """
)
def flatten_wrapped(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    address = F.struct(wrap("c_nationkey").alias("Nation"), _links("c_custkey").alias("_links"))
    head = record(
        id="c_custkey",
        Name=wrap("c_name"),
        Segment=wrap("c_mktsegment"),
        MainContact=F.struct(address.alias("Address")),
        Tags=F.array("c_mktsegment"),
        _links=_links("c_custkey"),
    )
    credit = with_parts(record(Balance=wrap("c_acctbal")), Rules=F.lit("{}"))
    text = with_parts(head, Credit=credit, Note=F.lit("{}"))
    return flatten_once(records(rows, text, "c_custkey"), "customer")


@query(
    """
    SELECT o_orderkey AS id, o_orderstatus AS "Status", o_totalprice AS "Total", o_custkey AS "Customer",
           strftime(o_orderdate, '%Y-%m-%d') AS "Date", o_orderstatus = 'F' AS "Approved",
           CAST(NULL AS VARCHAR) AS "Memo", '{"rank":"' || o_orderpriority || '"}' AS "Extra"
    FROM orders
    """
)
def unwrap_value(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    text = record(
        id="o_orderkey",
        Status=wrap("o_orderstatus"),
        Total=wrap("o_totalprice"),
        Customer=wrap("o_custkey"),
        Date=wrap(F.date_format("o_orderdate", "yyyy-MM-dd")),
        Approved=wrap(F.col("o_orderstatus") == "F"),
        Memo=wrap(F.lit(None).cast("string")),
        Extra=wrap(F.struct(F.col("o_orderpriority").alias("rank"))),
    )
    return flatten_once(records(rows, text, "o_orderkey"), "orders")


@query(
    """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS "Total",
           CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS "Total_value",
           CASE WHEN o_orderstatus <> 'F' THEN 'not final' END AS "Total_error"
    FROM orders
    """
)
def unwrap_ambiguous(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    final = record(id="o_orderkey", Total=wrap("o_totalprice"))
    partial = F.struct(F.col("o_totalprice").alias("value"), F.lit("not final").alias("error"))
    text = F.when(F.col("o_orderstatus") == "F", final).otherwise(record(id="o_orderkey", Total=partial))
    return flatten_once(records(rows, text, "o_orderkey"), "orders")


@query(
    """
    SELECT s_suppkey AS id, s_acctbal AS "Terms_Balance", s_nationkey::BIGINT AS "Terms_Area_Nation",
           s_name AS "Named_value"
    FROM supplier
    """
)
def drop_links(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier")
    links = _links("s_suppkey").alias("_links")
    area = F.struct(wrap("s_nationkey").alias("Nation"), links)
    text = record(
        id="s_suppkey",
        _links=_links("s_suppkey"),
        Terms=F.struct(wrap("s_acctbal").alias("Balance"), area.alias("Area"), links),
        Named=F.struct(F.col("s_name").alias("value"), links),  # two keys, so no wrapper
        Bare=F.struct(links),
    )
    return flatten_once(records(rows, text, "s_suppkey"), "supplier")


@query(
    """
    SELECT p_partkey AS id, CAST(NULL AS VARCHAR) AS "Dimensions",
           CASE WHEN p_size >= 10 THEN p_size::BIGINT END AS "Dimensions_Size",
           CAST(NULL AS VARCHAR) AS "Remarks"
    FROM part
    """
)
def empty_object_null(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    sized = record(Size=wrap("p_size"))
    dimensions = F.when(F.col("p_size") < 10, F.lit("{}")).otherwise(sized)
    text = with_parts(record(id="p_partkey"), Dimensions=dimensions, Remarks=F.lit("{}"))
    return flatten_once(records(rows, text, "p_partkey"), "part")


@query(
    """
    SELECT c_custkey AS id, c_name AS "Info_Name",
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS "Codes"
    FROM customer
    """
)
def flatten_drop_lists(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    codes = F.when(F.col("c_mktsegment") == "BUILDING", F.to_json(F.array("c_mktsegment")))
    info = F.struct(wrap("c_name").alias("Name"), F.array("c_nationkey").alias("Areas"))
    only_lists = F.struct(F.array("c_acctbal").alias("Balances"))
    head = record(id="c_custkey", Info=info, Lists=only_lists, Orders=F.array(F.struct("c_custkey")))
    scalar = F.concat(F.lit('"'), "c_mktsegment", F.lit('"'))
    text = with_parts(head, Codes=F.coalesce(codes, scalar))
    return flatten_once(records(rows, text, "c_custkey"), "customer")


@query(
    """
    SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS amount_value,
           c_custkey AS account_id, c_name AS account_name, '/o/' || o_orderkey AS _links_self
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def flatten_plain(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    text = record(
        id="o_orderkey",
        status="o_orderstatus",
        amount=wrap("o_totalprice"),
        account=F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        lines=F.array("o_orderkey"),
        _links=F.struct(F.concat(F.lit("/o/"), "o_orderkey").alias("self")),
    )
    return flatten_once(records(rows, text, "o_orderkey"), "orders", dialect=PLAIN)


@query(
    """
    SELECT o_orderkey AS id, CAST(NULL AS VARCHAR) AS name, o_orderkey AS number, o_orderstatus AS status,
           o_orderpriority AS type, CAST(NULL AS VARCHAR) AS description,
           strftime(o_orderdate, '%Y-%m-%d') AS "createdAt", CAST(NULL AS VARCHAR) AS "closedAt",
           CAST(NULL AS VARCHAR) AS "dueDate", CAST(NULL AS VARCHAR) AS tax, o_totalprice AS price,
           CAST(NULL AS VARCHAR) AS cost, CAST(NULL AS VARCHAR) AS "externalId",
           o_custkey AS account_id, 'account ' || o_custkey AS account_name,
           CAST(NULL AS VARCHAR) AS organization_id, CAST(NULL AS VARCHAR) AS organization_name,
           o_orderkey AS job_id, CAST(NULL AS VARCHAR) AS job_name, o_orderpriority AS job_number
    FROM orders
    """
)
def project_subselect(spark, sf_dir):
    document = PROJECTS.entity("document")
    account = F.struct(
        F.col("o_custkey").alias("id"),
        F.concat(F.lit("account "), "o_custkey").alias("name"),
        F.col("o_custkey").alias("region"),
    )
    job = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("number"))
    text = record(
        keep_nulls=False,
        id="o_orderkey",
        number="o_orderkey",
        status="o_orderstatus",
        type="o_orderpriority",
        createdAt=F.date_format("o_orderdate", "yyyy-MM-dd"),
        price="o_totalprice",
        account=account,
        job=job,
        internalCode="o_custkey",
    )
    rows = records(table(spark, sf_dir, "orders"), text, "o_orderkey")
    return flatten_once(rows, "orders", dialect=PLAIN, keeps=document.keeps, fixed=document.requested_columns())


@query(
    """
    SELECT s_suppkey AS id, s_name AS "VendorName", s_name AS "MainContact_Attention",
           s_nationkey::BIGINT AS "MainContact_Address_Nation",
           s_nationkey::BIGINT AS "ShippingContact_Address_Nation"
    FROM supplier
    """
)
def inline_expand(spark, sf_dir):
    vendor = BUSINESS.entity("vendor")
    address = F.struct(wrap("s_nationkey").alias("Nation"), F.lit(1).alias("Line"))
    main = F.struct(
        wrap("s_name").alias("Attention"),
        F.struct(wrap("s_nationkey").alias("Nation")).alias("Address"),
        F.struct(wrap("s_acctbal").alias("Balance"), F.lit(1).alias("Rank")).alias("Credit"),
    )
    text = record(
        id="s_suppkey",
        VendorName=wrap("s_name"),
        MainContact=main,
        ShippingContact=F.struct(F.struct(wrap("s_nationkey").alias("Nation")).alias("Address")),
        RemitContact=F.struct(address.alias("Address")),
    )
    rows = records(table(spark, sf_dir, "supplier"), text, "s_suppkey")
    return flatten_once(rows, "supplier", keeps=vendor.keeps)


@query(
    """
    SELECT o_orderkey AS id, o_orderstatus AS "Status", o_orderpriority AS "custom_Document_AttributeSOURCE",
           o_custkey AS "custom_Document_AttributeUNITS"
    FROM orders
    """
)
def custom_fields(spark, sf_dir):
    order = BUSINESS.entity("sales_order")
    document = F.struct(
        wrap("o_orderpriority").alias("AttributeSOURCE"),
        wrap("o_custkey").alias("AttributeUNITS"),
        wrap("o_totalprice").alias("AttributeNOTLISTED"),
    )
    other = F.struct(wrap("o_custkey").alias("AttributeSOURCE"), F.lit(1).alias("Line"))
    text = record(
        id="o_orderkey",
        Status=wrap("o_orderstatus"),
        custom=F.struct(document.alias("Document"), other.alias("Transactions")),
    )
    rows = records(table(spark, sf_dir, "orders"), text, "o_orderkey")
    return flatten_once(rows, "orders", keeps=order.keeps)


@query(
    """
    SELECT p_partkey AS id, p_name AS part_name, p_brand AS brand_code,
           p_retailprice AS estimated_retail_price,
           p_type AS custom_document_attribute_shltrtype, p_size::BIGINT AS usrxml_size
    FROM part
    """
)
def snake_case_columns(spark, sf_dir):
    text = record(
        id="p_partkey",
        PartName=wrap("p_name"),
        brandCode=wrap("p_brand"),
        EstimatedRetailPrice=wrap("p_retailprice"),
        custom=F.struct(F.struct(wrap("p_type").alias("AttributeSHLTRTYPE")).alias("Document")),
        USRXMLSize=wrap("p_size"),
    )
    return flatten_once(records(table(spark, sf_dir, "part"), text, "p_partkey"), "part", snake=True)


@query(
    """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderstatus = 'P' THEN o_custkey ELSE o_orderkey END AS "Bill_Number"
    FROM orders
    """
)
def name_collision(spark, sf_dir):
    """Two paths give one column: the deeper one wins wherever a record has it."""
    rows = table(spark, sf_dir, "orders")
    both = record(id="o_orderkey", Bill_Number="o_custkey", Bill=F.struct(F.col("o_orderkey").alias("Number")))
    flat = record(id="o_orderkey", Bill_Number="o_custkey", Bill=F.struct(F.array("o_custkey").alias("Lines")))
    text = F.when(F.col("o_orderstatus") == "P", flat).otherwise(both)
    return flatten_once(records(rows, text, "o_orderkey"), "orders")
