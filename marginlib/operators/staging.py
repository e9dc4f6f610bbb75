"""Staging: typed order, line and catalog rows from the landed documents.

The landed ``raw`` column is a VARIANT (parsed once at landing), so
staging reads fields from binary JSON without parsing text.  Numbers are
read with ``try_variant_get`` as DECIMAL: exact for JSON numbers, numeric
text is parsed, anything else (a malformed value, an object) becomes NULL
for that value only instead of failing the job, and is counted by a check.
A number beyond DECIMAL(18,4) fails the job (a landing job quarantines it before): it is
never read as NULL or 0 uncounted.  Lines and header amounts are read from the document
once, at landing, into typed columns (``items``, ``header``) that every model reads; a
frame without them is read from ``raw`` here.  A non-array ``Items``
gives an order no lines; array elements that are not objects give lines
with NULL fields, as a lateral unnest of the array would.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from ..functions.coerce import nullif_blank, to_bool, vmoney, vnum, vtext
from ..functions.numeric import NUM, PRODUCT, zero

STG_ORDERS_COLUMNS = ["order_id", "order_source", "company_id", "status_code", "created_on",
                      "last_updated", "grand_total", "shipping_charged_to_customer",
                      "order_shipping_cost", "order_source_order_id", "company_name",
                      "order_source_url"]

STG_ITEMS_COLUMNS = ["order_id", "order_item_id", "source_sku", "parent_sku", "sku", "product_name",
                     "qty", "qty_returned", "unit_price", "revenue", "unit_cost", "cogs",
                     "marketplace_fee", "refunds", "is_bundle"]

STG_CATALOG_COLUMNS = ["sku", "canonical_sku", "parent_sku", "product_name", "active_status",
                       "is_active", "is_end_of_life", "is_kit", "msrp", "average_cost", "last_cost",
                       "current_cost", "brand", "product_type", "weight_lbs"]

_NUM = "decimal(18,4)"


def num(doc: Column, key: str) -> Column:
    """``(doc->>'key')::numeric``, NULL when it is not a number."""
    return vmoney(doc, f"$.{key}", _NUM)


def num0(doc: Column, key: str) -> Column:
    """``coalesce((doc->>'key')::numeric, 0)``."""
    return F.coalesce(num(doc, key), zero())


def order_items(doc: Column) -> Column:
    """The ``Items`` array of an order document (NULL unless an array)."""
    return F.try_variant_get(doc, "$.Items", "array<variant>")


def order_header_columns(doc: Column) -> dict[str, Column]:
    """P1 columns taken from the order document, by output name."""
    return {
        "company_id": vtext(doc, "$.CompanyID"),
        "shipping_charged_to_customer": num0(doc, "ShippingTotal"),
        "order_shipping_cost": num0(doc, "FinalShippingFee"),
        "company_name": vtext(doc, "$.CompanyName"),
        "order_source_url": vtext(doc, "$.OrderSourceUrl"),
    }


def status_kept(codes: Iterable[int]) -> Column:
    """True when the order survives the excluded-status filter.

    With no codes every order is kept; otherwise ``status not in codes``
    with SQL NULL logic (a NULL status is not kept).
    """
    codes = list(codes or [])
    if not codes:
        return F.lit(True)
    return F.coalesce(~F.col("status_code").isin(codes), F.lit(False))


def stg_orders(raw_orders: DataFrame, excluded_status_codes: Iterable[int] = ()) -> DataFrame:
    """P1 + P2: one row per order."""
    o = raw_orders.where(status_kept(excluded_status_codes)).withColumn("h", header_of(raw_orders))
    return o.select(*(F.col(f"h.{c}") if c in HEADER.names else F.col(c) for c in STG_ORDERS_COLUMNS))


def sku_of(item: Column) -> Column:
    """P5: parent SKU when non-empty, else the line's own product id."""
    return F.coalesce(nullif_blank(vtext(item, "$.ShadowOf")), vtext(item, "$.ProductID"))


# One typed read per line: a VARIANT object cast to this struct matches
# fields by name; a field that does not convert is NULL on its own.  Amounts are
# read wide, so that one that is too large is seen and not NULL.
ITEM_AMOUNTS = ["Qty", "QtyReturned", "SitePrice", "LineTotal", "AverageCost", "FinalValueFee",
                "TotalRefunded"]
_WIDE = "decimal(38,4)"
ITEM_STRUCT = ("struct<ID:bigint,ProductID:string,ShadowOf:string,ProductName:string,"
               + ",".join(f"{x}:{_WIDE}" for x in ITEM_AMOUNTS) + ",BundleItems:array<variant>>")
# What is landed of a line, and of an order's header.
LINE = StructType([StructField("ID", LongType()), *(StructField(x, StringType()) for x in ("ProductID", "ShadowOf", "ProductName")),
                   *(StructField(x, NUM) for x in ITEM_AMOUNTS), StructField("is_bundle", BooleanType())])
HEADER = StructType([StructField("company_id", StringType()), StructField("shipping_charged_to_customer", NUM),
                     StructField("order_shipping_cost", NUM), StructField("company_name", StringType()),
                     StructField("order_source_url", StringType())])


def item_fields(item: Column) -> Column:
    """The fields of one line (a VARIANT) as a struct with wide amounts; NULL where a
    value does not convert."""
    return F.try_variant_get(item, "$", ITEM_STRUCT)


def _beyond(item: Column, field: str) -> Column:
    """A number of a line that not even the wide type holds, as DOUBLE."""
    wide = F.try_variant_get(item, f"$.{field}", "double")
    return F.when(F.abs(wide) < float("inf"), wide)


def _line(item: Column, f: Column, strict: bool) -> Column:
    """The typed line of ``f``, the ``item_fields`` of ``item``; an amount that is too large
    is an error, or NULL if not ``strict``."""
    def amount(x: str) -> Column:
        return F.coalesce(f[x].cast(NUM), _beyond(item, x).cast(NUM)) if strict else f[x].try_cast(NUM)

    return F.struct(*(f[x].alias(x) for x in ("ID", "ProductID", "ShadowOf", "ProductName")),
                    *(amount(x).alias(x) for x in ITEM_AMOUNTS),
                    (F.coalesce(F.array_size(f["BundleItems"]), F.lit(0)) > 0).alias("is_bundle"))


def _read_lines(doc: Column) -> Column:
    """Each line as (v, f): its VARIANT and its fields."""
    return F.transform(order_items(doc), lambda v: F.struct(v.alias("v"), item_fields(v).alias("f")))


def typed_lines(doc: Column, strict: bool = True) -> Column:
    """The ``Items`` of an order document as an array of typed structs, each line
    converted from VARIANT once."""
    return F.transform(_read_lines(doc), lambda x: _line(x["v"], x["f"], strict))


def typed_header(doc: Column, strict: bool = True) -> Column:
    """The fields of an order's header that models read, as a struct."""
    def amount(key: str) -> Column:
        return F.coalesce((vmoney if strict else vnum)(doc, f"$.{key}", _NUM), zero())

    h = order_header_columns(doc)
    h = {**h, "shipping_charged_to_customer": amount("ShippingTotal"), "order_shipping_cost": amount("FinalShippingFee")}
    return F.struct(*(c.alias(n) for n, c in h.items()))


def line_problems(doc: Column, typed: Column | None = None) -> Column:
    """(field, value, reason) of line and header amounts that are too large to be landed.
    ``typed``: ``typed_lines`` without ``strict``, so that lines are not converted again."""
    def too_large(field: Column, item: Column, key: str, narrow: Column) -> Column:
        return F.when(narrow.isNull() & _beyond(item, key).isNotNull(), F.struct(
            field.alias("field"), F.try_variant_get(item, f"$.{key}", "string").alias("value"),
            F.lit("too large").alias("reason")))

    pairs = _read_lines(doc) if typed is None else F.arrays_zip(order_items(doc).alias("v"), typed.alias("f"))
    lines = F.transform(pairs, lambda x, i: F.array(*(
        too_large(F.concat(F.lit("Items["), i.cast("string"), F.lit(f"].{k}")), x["v"], k, x["f"][k].try_cast(NUM))
        for k in ITEM_AMOUNTS)))
    header = F.array(*(too_large(F.lit(k), doc, k, vnum(doc, f"$.{k}", _NUM)) for k in ("ShippingTotal", "FinalShippingFee")))
    return F.array_compact(F.concat(header, F.coalesce(F.flatten(lines), F.array())))


def lines_of(raw_orders: DataFrame) -> Column:
    """The typed lines of landed orders."""
    return F.col("items") if "items" in raw_orders.columns else typed_lines(F.col("raw"))


def header_of(raw_orders: DataFrame) -> Column:
    return F.col("header") if "header" in raw_orders.columns else typed_header(F.col("raw"))


def item_columns(item: Column) -> list[Column]:
    """P3 + P5 + F5 + F21 on one typed line; order_id excluded."""
    f = item
    z = zero()
    qty = F.coalesce(f["Qty"], z)
    unit_cost = f["AverageCost"]
    shadow = nullif_blank(f["ShadowOf"])
    return [
        f["ID"].alias("order_item_id"),
        f["ProductID"].alias("source_sku"),
        shadow.alias("parent_sku"),
        F.coalesce(shadow, f["ProductID"]).alias("sku"),
        f["ProductName"].alias("product_name"),
        qty.alias("qty"),
        F.coalesce(f["QtyReturned"], z).alias("qty_returned"),
        f["SitePrice"].alias("unit_price"),
        F.coalesce(f["LineTotal"], z).alias("revenue"),
        unit_cost.alias("unit_cost"),
        (qty * F.coalesce(unit_cost, z)).cast(PRODUCT).alias("cogs"),
        F.coalesce(f["FinalValueFee"], z).alias("marketplace_fee"),
        F.coalesce(f["TotalRefunded"], z).alias("refunds"),
        F.coalesce(f["is_bundle"], F.lit(False)).alias("is_bundle"),
    ]


ITEM_NUMERIC_FIELDS = ["ID", "Qty", "QtyReturned", "SitePrice", "LineTotal", "AverageCost",
                       "FinalValueFee", "TotalRefunded"]


def malformed_line_numbers(raw_orders: DataFrame) -> DataFrame:
    """Q13: count of line values present in the document (not missing, not
    JSON null) that did not convert to a number, per field, as rows of
    ``check, model, column, failures``.  Staging turns them into NULL so the
    job does not fail; this makes them visible."""
    e = explode_items(raw_orders).select("item", item_fields(F.col("item")).alias("f"))

    def bad(field: str) -> Column:
        v = F.try_variant_get("item", f"$.{field}", "variant")
        present = v.isNotNull() & ~F.is_variant_null(v)
        read = F.col("f")[field] if field == "ID" else F.col("f")[field].try_cast(NUM)
        return F.count(F.when(present & read.isNull(), 1)).cast("long")

    agg = e.agg(*[bad(f).alias(f) for f in ITEM_NUMERIC_FIELDS])
    stack = ", ".join(f"'{f}', `{f}`" for f in ITEM_NUMERIC_FIELDS)
    return agg.selectExpr(f"stack({len(ITEM_NUMERIC_FIELDS)}, {stack}) as (column, failures)") \
        .select(F.lit("malformed_number").alias("check"), F.lit("stg_order_items").alias("model"),
                "column", "failures")


def malformed_document_numbers(landed: DataFrame, model: str, fields: Iterable[str]) -> DataFrame:
    """Q13 for fields of whole documents (order headers, catalog): present, but no
    number of type DECIMAL(18,4)."""
    fields = list(fields)

    def bad(field: str) -> Column:
        v = F.try_variant_get("raw", f"$.{field}", "variant")
        present = v.isNotNull() & ~F.is_variant_null(v)
        return F.count(F.when(present & F.try_variant_get("raw", f"$.{field}", _NUM).isNull(), 1)).cast("long")

    stack = ", ".join(f"'{f}', `{f}`" for f in fields)
    return landed.agg(*[bad(f).alias(f) for f in fields]) \
        .selectExpr(f"stack({len(fields)}, {stack}) as (column, failures)") \
        .select(F.lit("malformed_number").alias("check"), F.lit(model).alias("model"), "column", "failures")


def explode_items(df: DataFrame, *keep: str) -> DataFrame:
    """One row per element of ``Items`` (orders without an array vanish).

    The outer variant plus a filter on the generated position keeps the
    optimizer from adding a non-empty-array filter below the explode.
    """
    return (df.select(*keep, F.posexplode_outer(order_items(F.col("raw"))).alias("pos", "item"))
              .where(F.col("pos").isNotNull()))


def stg_order_items(raw_orders: DataFrame) -> DataFrame:
    """P3 + J5: one row per order line."""
    e = (raw_orders.select("order_id", F.posexplode_outer(lines_of(raw_orders)).alias("pos", "f"))
         .where(F.col("pos").isNotNull()))
    return e.select("order_id", *item_columns(F.col("f")))


CATALOG_STRUCT = ("struct<ShadowOf:string,ProductName:string,ActiveStatus:string,"
                  f"IsEndOfLife:string,IsKit:string,SitePrice:{_NUM},AverageCost:{_NUM},"
                  f"LastCost:{_NUM},BrandName:string,ProductType:string,WeightLbs:{_NUM}>")


def stg_catalog(raw_catalog: DataFrame) -> DataFrame:
    """P4 + P5 + F11: one row per catalog product."""
    c = raw_catalog.select("product_id", "product_name", "average_cost", "raw",
                           F.try_variant_get("raw", "$", CATALOG_STRUCT).alias("d"))
    d = F.col("d")
    shadow = nullif_blank(d["ShadowOf"])

    def amount(field: str) -> Column:
        return vmoney(F.col("raw"), f"$.{field}", _NUM, read=d[field])

    last_cost = amount("LastCost")
    avg_json = amount("AverageCost")
    return c.select(
        F.col("product_id").alias("sku"),
        F.coalesce(shadow, F.col("product_id")).alias("canonical_sku"),
        shadow.alias("parent_sku"),
        F.coalesce("product_name", d["ProductName"]).alias("product_name"),
        d["ActiveStatus"].alias("active_status"),
        (d["ActiveStatus"] == "Active").alias("is_active"),
        to_bool(d["IsEndOfLife"]).alias("is_end_of_life"),
        to_bool(d["IsKit"]).alias("is_kit"),
        amount("SitePrice").alias("msrp"),
        F.coalesce(F.col("average_cost").cast(NUM), avg_json).alias("average_cost"),
        last_cost.alias("last_cost"),
        F.coalesce(F.when(last_cost != 0, last_cost), avg_json).alias("current_cost"),
        d["BrandName"].alias("brand"),
        d["ProductType"].alias("product_type"),
        amount("WeightLbs").alias("weight_lbs"),
    )
