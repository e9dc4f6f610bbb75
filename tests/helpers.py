import json

from pyspark.sql import functions as F

from marginlib.sources import landing

NOW = "2024-09-01 00:00:00"


def payloads(spark, docs):
    """JSON documents (dicts or raw text) -> payload frame with arrival seq."""
    rows = [(d if isinstance(d, str) else json.dumps(d), i) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "value string, seq long")


def raw_orders(spark, docs):
    return landing.land_orders(payloads(spark, docs), NOW).drop("seq")


def raw_catalog(spark, docs):
    c = landing.land_catalog(payloads(spark, docs), NOW)
    return c.where(F.col("product_id").isNotNull()).drop("seq")


def raw_returns(spark, docs):
    return landing.land_returns(payloads(spark, docs), NOW).drop("seq")


def order(oid, items, source=4, company="100", ship=10, status=2, created="2024-08-01T10:00:00Z"):
    d = {"ID": oid, "CreatedOn": created, "OrderSource": source, "StatusCode": status,
         "CompanyID": company, "GrandTotal": 1, "Items": items}
    if ship is not None:
        d["FinalShippingFee"] = ship
    return d


def item(iid, sku, total, qty=1, cost=None, shadow="", fee=0, price=None, refunded=0, bundle=None,
         name=None):
    d = {"ID": iid, "ProductID": sku, "ShadowOf": shadow, "Qty": qty, "LineTotal": total,
         "FinalValueFee": fee, "TotalRefunded": refunded, "ProductName": name or sku}
    if cost is not None:
        d["AverageCost"] = cost
    if price is not None:
        d["SitePrice"] = price
    if bundle is not None:
        d["BundleItems"] = bundle
    return d


def rows(df, *cols):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)
