"""The three declared families.

Fixed values: table, collection, list, sub-object and field names below must
equal those of the sources they describe, so they are stated as they are.
"""

from __future__ import annotations

from recordloom.operators.catalogue import PLAIN, WRAPPED
from recordloom.sources.entities import Collection, Entity, Family


def _details(table: str) -> tuple[Collection, ...]:
    return (Collection("Details", f"{table}_detail"),)


def _attributes(table: str) -> Collection:
    return Collection("Attributes", f"{table}_attribute")


MANUFACTURING = Family(
    "manufacturing",
    WRAPPED,
    "offset",
    (
        Entity(
            "bill_of_material",
            "BillOfMaterial",
            (
                Collection(
                    "Operations",
                    "bill_of_material_operation",
                    (Collection("Material", "bill_of_material_material"),),
                ),
            ),
        ),
        Entity("production_order", "ProductionOrder"),
        Entity("production_order_detail", "ProductionOrderDetail"),
        Entity("labor_entry", "LaborEntry", _details("labor_entry")),
        Entity("material_entry", "MaterialEntry", _details("material_entry")),
        Entity("work_center", "WorkCenter"),
        Entity("machine", "Machine"),
        Entity("shift", "Shift"),
    ),
)

SALES_ORDER_CUSTOM = (
    "Document.AttributeACCESSORIE",
    "Document.AttributeACCPERCENT",
    "Document.AttributeCONEORDNBR",
    "Document.AttributeELECTRICAL",
    "Document.AttributeELEPERCT",
    "Document.AttributeENDUSER",
    "Document.AttributeFINALCHECK",
    "Document.AttributeHOTDIPPER",
    "Document.AttributeINSTALLER1",
    "Document.AttributeINSTALLER2",
    "Document.AttributeINSTALLER3",
    "Document.AttributeINSTALLER4",
    "Document.AttributeINSTALLTEC",
    "Document.AttributeLIGHTNING",
    "Document.AttributePMTNBR",
    "Document.AttributeSALESFORDR",
    "Document.AttributeSHLTRSIZE",
    "Document.AttributeSHLTRTYPE",
    "Document.AttributeSKU",
    "Document.AttributeSOURCE",
    "Document.AttributeTURNKEYINS",
    "Document.AttributeUNITS",
    "Document.AttributeUSECASE",
    "Document.AttributeVERTICALS",
    "Document.AttributeWARRANTY",
)

BUSINESS = Family(
    "business",
    WRAPPED,
    "offset",
    (
        # finance
        Entity("account", "Account"),
        Entity("bill", "Bill", _details("bill")),
        Entity("currency", "Currency"),
        Entity("financial_period", "FinancialPeriod", _details("financial_period")),
        Entity("invoice", "Invoice", _details("invoice"), inline=("BillToContact", "ShipToContact")),
        Entity("journal_transaction", "JournalTransaction", _details("journal_transaction")),
        Entity("ledger", "Ledger"),
        Entity("payment", "Payment"),
        Entity("payment_method", "PaymentMethod"),
        Entity("sub_account", "SubAccount"),
        Entity("tax_category", "TaxCategory", _details("tax_category")),
        Entity("tax_zone", "TaxZone"),
        # customer relations
        Entity("contact", "Contact", (_attributes("contact"),), inline=("Address",)),
        Entity("employee", "Employee", (_attributes("employee"),), inline=("ContactInfo",)),
        Entity("sales_person", "SalesPerson"),
        # sales
        Entity(
            "customer",
            "Customer",
            (Collection("Contacts", "customer_contact"), _attributes("customer")),
            inline=("MainContact/Address", "BillingContact/Address", "ShippingContact/Address"),
            custom=("BAccount.AttributeCRMREFNO",),
        ),
        Entity("customer_class", "CustomerClass"),
        Entity("customer_location", "CustomerLocation"),
        Entity(
            "sales_invoice",
            "SalesInvoice",
            _details("sales_invoice"),
            inline=("BillToAddress", "ShipToAddress", "ShipToContact"),
        ),
        Entity(
            "sales_order",
            "SalesOrder",
            (
                Collection("Details", "sales_order_detail"),
                Collection("Shipments", "sales_order_shipment"),
                Collection("TaxDetails", "sales_order_tax_detail"),
            ),
            inline=("BillToAddress", "ShipToAddress", "BillToContact", "ShipToContact"),
            custom=SALES_ORDER_CUSTOM,
        ),
        Entity(
            "shipment",
            "Shipment",
            (Collection("Details", "shipment_detail"), Collection("Packages", "shipment_package")),
        ),
        # purchasing
        Entity(
            "purchase_order",
            "PurchaseOrder",
            (
                Collection("Details", "purchase_order_detail"),
                Collection("TaxDetails", "purchase_order_tax_detail"),
            ),
            custom=("Document.AttributeSOREF",),
        ),
        Entity("purchase_receipt", "PurchaseReceipt", _details("purchase_receipt")),
        Entity(
            "vendor",
            "Vendor",
            (Collection("Contacts", "vendor_contact"), _attributes("vendor")),
            inline=("MainContact/Address", "ShippingContact/Address"),
        ),
        Entity("vendor_class", "VendorClass"),
        # inventory
        Entity("inventory_issue", "InventoryIssue", _details("inventory_issue")),
        Entity("inventory_receipt", "InventoryReceipt", _details("inventory_receipt")),
        Entity(
            "non_stock_item",
            "NonStockItem",
            (_attributes("non_stock_item"), Collection("CrossReferences", "non_stock_item_cross_ref")),
        ),
        Entity(
            "physical_inventory_review",
            "PhysicalInventoryReview",
            _details("physical_inventory_review"),
        ),
        Entity(
            "stock_item",
            "StockItem",
            (
                _attributes("stock_item"),
                Collection("WarehouseDetails", "stock_item_warehouse_detail"),
                Collection("CrossReferences", "stock_item_cross_ref"),
                Collection("ReplenishmentParameters", "stock_item_replenishment"),
            ),
        ),
        Entity("warehouse", "Warehouse", (Collection("Locations", "warehouse_location"),)),
        Entity("item_class", "ItemClass"),
        Entity("units_of_measure", "UnitsOfMeasure"),
    ),
)

ACCOUNT = ("account", ("id", "name"))
ORGANIZATION = ("organization", ("id", "name"))
LOCATION = ("location", ("id", "name"))
JOB = ("job", ("id", "name", "number"))


def _requested(table: str, collection: str, scalars: tuple[str, ...], *relations) -> Entity:
    return Entity(table, collection, scalars=scalars, relations=relations)


# The fields each request asks for. Invoices cannot be read from this source, and its events accept no other
# relation than the organization.
PROJECTS = Family(
    "projects",
    PLAIN,
    "cursor",
    (
        _requested("account", "accounts", ("id", "name", "type", "createdAt", "archivedAt"), ORGANIZATION),
        _requested(
            "job", "jobs", ("id", "name", "number", "status", "description", "createdAt", "closedOn"), ORGANIZATION, LOCATION
        ),
        _requested(
            "task",
            "tasks",
            ("id", "name", "description", "createdAt", "startDate", "endDate", "progress"),
            ACCOUNT,
            ORGANIZATION,
            LOCATION,
            JOB,
        ),
        _requested("contact", "contacts", ("id", "name", "title", "createdAt"), ACCOUNT),
        _requested("event", "events", ("id", "type", "createdAt"), ORGANIZATION),
        _requested("location", "locations", ("id", "name", "createdAt"), ACCOUNT),
        _requested(
            "payment", "payments", ("id", "type", "description", "createdAt", "amount", "externalId"), ACCOUNT, ORGANIZATION
        ),
        _requested(
            "cost_item", "costItems", ("id", "name", "description", "createdAt", "price", "cost", "quantity"), ORGANIZATION, JOB
        ),
        _requested("daily_log", "dailyLogs", ("id", "notes", "createdAt"), ORGANIZATION, JOB),
        _requested("comment", "comments", ("id", "name", "createdAt"), ACCOUNT, ORGANIZATION, JOB),
        _requested(
            "document",
            "documents",
            ("id", "name", "number", "status", "type", "description", "createdAt", "closedAt", "dueDate", "tax", "price", "cost", "externalId"),
            ACCOUNT,
            ORGANIZATION,
            JOB,
        ),
        _requested(
            "file", "files", ("id", "name", "type", "description", "createdAt"), ACCOUNT, ORGANIZATION, LOCATION, JOB
        ),
    ),
)

FAMILIES = (MANUFACTURING, BUSINESS, PROJECTS)
