"""Landing: API JSON payloads -> typed landed tables.

Input of every function here is a DataFrame of JSON documents with a
``value`` column (one document per row, e.g. ``spark.read.text`` over
JSON-lines files) and an optional ``seq`` column giving arrival order
(used by the latest-wins upsert).  Each document is parsed once, with
``try_parse_json``, into a VARIANT kept whole in ``raw`` (binary JSON, like
the jsonb column it stands for): typed key columns are read from it here,
and every later model reads fields from it without parsing text again.
JSON numbers stay exact decimals (no DOUBLE round trip).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DecimalType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType, VariantType)

from ..functions.coerce import first_truthy, nullif_blank, parse_ts, to_num, vmoney, vnum, vtext
from ..operators.staging import HEADER, LINE, line_problems, typed_header, typed_lines
from ..session import apply_conf

RAW_ORDERS_SCHEMA = StructType([
    StructField("order_id", LongType(), False),
    StructField("order_source_order_id", StringType()),
    StructField("created_on", TimestampType()),
    StructField("last_updated", TimestampType()),
    StructField("grand_total", DecimalType(14, 2)),
    StructField("order_source", IntegerType()),
    StructField("status_code", IntegerType()),
    StructField("raw", VariantType(), False),
    # Read from the document once, here, so that models need not read it again.
    StructField("header", HEADER),
    StructField("items", ArrayType(LINE)),
    StructField("extracted_at", TimestampType(), False),
])

RAW_CATALOG_SCHEMA = StructType([
    StructField("product_id", StringType(), False),
    StructField("product_name", StringType()),
    StructField("shadow_of", StringType()),
    StructField("average_cost", DecimalType(14, 4)),
    StructField("raw", VariantType(), False),
    StructField("extracted_at", TimestampType(), False),
])

RAW_RETURNS_SCHEMA = StructType([
    StructField("submission_id", StringType(), False),
    StructField("created_at", TimestampType()),
    StructField("order_rma", StringType()),
    StructField("sku_raw", StringType()),
    StructField("channel", StringType()),
    StructField("reason", StringType()),
    StructField("disposition", StringType()),
    StructField("labor_cost", DecimalType(12, 2)),
    StructField("processing_cost", DecimalType(12, 2)),
    StructField("raw", VariantType(), False),
    StructField("extracted_at", TimestampType(), False),
])

SYNC_STATE_SCHEMA = StructType([
    StructField("source", StringType(), False),
    StructField("last_run_at", TimestampType()),
    StructField("watermark", TimestampType()),
    StructField("max_created_on", TimestampType()),
])

# Return-form question ids of each landed column.
RETURN_QIDS = {
    "order_rma": "9",
    "sku_raw": "10",
    "channel": "13",
    "reason": "15",
    "disposition": "18",
    "labor_cost": "122",
    "processing_cost": "123",
}

def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines files (one document per line) -> ``value`` + arrival order.

    Arrival order is (file modification time, file path, position in the
    file), so a document re-pulled later, or later in the same file, wins
    the upsert.  The position comes from ``monotonically_increasing_id``,
    which increases along each file split in read order.
    """
    docs = (spark.read.format("text").load(path)
            .where(F.trim("value") != "")
            .select("value",
                    F.col("_metadata.file_modification_time").alias("_file_time"),
                    F.col("_metadata.file_path").alias("_file"),
                    F.monotonically_increasing_id().alias("_pos")))
    return docs.select("value", F.struct("_file_time", "_file", "_pos").alias("seq"))


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def _with_seq(payloads: DataFrame) -> Column:
    return F.col("seq") if "seq" in payloads.columns else F.lit(None).cast("long")


def _parsed(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    apply_conf(payloads.sparkSession)       # a repeated key keeps its last value
    return payloads.select(F.try_parse_json("value").alias("raw"),
                           _with_seq(payloads).alias("seq"), *keep)


def rejected(payloads: DataFrame, extracted_at) -> DataFrame:
    """Documents that do not parse, whole, with the reason: the reject table of a
    landing run.  They have no key, so the upsert of the landed rows skips them."""
    apply_conf(payloads.sparkSession)
    return payloads.where(F.try_parse_json("value").isNull()).select(
        "value",
        F.when(F.col("value").isNull(), "no document").otherwise("not JSON").alias("reason"),
        _ts(extracted_at).alias("extracted_at"), _with_seq(payloads).alias("seq"))


def land_orders(payloads: DataFrame, extracted_at, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Order document -> raw_orders row (+ ``seq``).

    A total that the landed type can't hold is an error; without ``strict`` it is NULL, and
    `amount_problems` names it.  ``keep`` passes columns of the payloads on.
    """
    d = F.col("raw")
    return _parsed(payloads, keep).select(
        vnum(d, "$.ID", "bigint").alias("order_id"),
        vtext(d, "$.OrderSourceOrderID").alias("order_source_order_id"),
        parse_ts(vtext(d, "$.CreatedOn")).alias("created_on"),
        parse_ts(vtext(d, "$.LastUpdated")).alias("last_updated"),
        (vmoney if strict else vnum)(d, "$.GrandTotal", "decimal(14,2)").alias("grand_total"),
        vnum(d, "$.OrderSource", "int").alias("order_source"),
        vnum(d, "$.StatusCode", "int").alias("status_code"),
        "raw", typed_header(d, strict).alias("header"), typed_lines(d, strict).alias("items"),
        _ts(extracted_at).alias("extracted_at"),
        "seq", *keep)


def land_catalog(payloads: DataFrame, extracted_at, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Product document -> raw_catalog row (+ ``seq``).

    The id is the first truthy of ProductID, ID, Sku, SKU (keys are
    case-sensitive); rows without one get a NULL id and are dropped (and
    counted) by the upsert.
    """
    d = F.col("raw")
    return _parsed(payloads, keep).select(
        first_truthy(d, "$.ProductID", "$.ID", "$.Sku", "$.SKU").alias("product_id"),
        vtext(d, "$.ProductName").alias("product_name"),
        nullif_blank(vtext(d, "$.ShadowOf")).alias("shadow_of"),
        to_num(vtext(d, "$.AverageCost"), DecimalType(14, 4)).alias("average_cost"),
        "raw",
        _ts(extracted_at).alias("extracted_at"),
        "seq", *keep)


def _answer(qid: str) -> Column:
    return vtext(F.col("raw"), f"$.answers['{qid}'].answer")


def land_returns(payloads: DataFrame, extracted_at, strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """S3: form submission -> raw_returns row (+ ``seq``).

    Answers that are objects (time widgets etc.) land as their JSON text.
    """
    q = RETURN_QIDS
    d = F.col("raw")
    return _parsed(payloads, keep).select(
        vtext(d, "$.id").alias("submission_id"),
        parse_ts(vtext(d, "$.created_at")).alias("created_at"),
        _answer(q["order_rma"]).alias("order_rma"),
        _answer(q["sku_raw"]).alias("sku_raw"),
        _answer(q["channel"]).alias("channel"),
        _answer(q["reason"]).alias("reason"),
        _answer(q["disposition"]).alias("disposition"),
        to_num(_answer(q["labor_cost"]), DecimalType(12, 2)).alias("labor_cost"),
        to_num(_answer(q["processing_cost"]), DecimalType(12, 2)).alias("processing_cost"),
        "raw",
        _ts(extracted_at).alias("extracted_at"),
        "seq", *keep)


def _problem(field: str, text: Column, dtype: DecimalType) -> Column:
    """(field, value, reason) of an amount that was sent but can't be landed, else NULL."""
    number = F.regexp_replace(text, r"[,$]", "").try_cast("double")
    reason = F.when(F.abs(number) < float("inf"), "too large").otherwise("not a number")
    return F.when((F.trim(text) != "") & to_num(text, dtype).isNull(),
                  F.struct(F.lit(field).alias("field"), text.alias("value"), reason.alias("reason")))


def amount_problems(kind: str, lines: Column | None = None) -> Column:
    """Amounts of a document (``raw``) that the landed columns of its kind can't hold, as
    an array of (field, value, reason): what the landed row has as NULL.  ``lines``: the
    lines of an order as landed without ``strict``, where they were read already."""
    q, d = RETURN_QIDS, F.col("raw")
    amounts = {
        "orders": [("GrandTotal", vtext(d, "$.GrandTotal"), DecimalType(14, 2))],
        "catalog": [("AverageCost", vtext(d, "$.AverageCost"), DecimalType(14, 4))],
        "returns": [(c, _answer(q[c]), DecimalType(12, 2)) for c in ("labor_cost", "processing_cost")],
    }[kind]
    found = F.array_compact(F.array(*(_problem(*a) for a in amounts)))
    return F.concat(found, line_problems(d, lines)) if kind == "orders" else found


def orders_window(raw_orders: DataFrame, since=None, until=None) -> DataFrame:
    """Orders created in [since, until] (both inclusive, either open)."""
    c = F.col("created_on")
    cond = F.lit(True)
    if since is not None:
        cond = cond & (c >= _ts(since))
    if until is not None:
        cond = cond & (c <= _ts(until))
    return raw_orders.where(cond)


def returns_since(raw_returns: DataFrame, since=None) -> DataFrame:
    """Submissions created strictly after ``since`` (all when None)."""
    if since is None:
        return raw_returns
    return raw_returns.where(F.col("created_at") > _ts(since))


def sync_state(landed: DataFrame, source: str, run_at, ts_col: str = "created_on") -> DataFrame:
    """The state row a landing run records for ``source``.

    ``watermark`` is the run time, as the landing jobs record it (nothing
    reads it back); ``max_created_on`` adds the newest landed timestamp,
    which is what a watermark is usually meant to hold.  Upsert it on
    ``source`` into the state table.
    """
    now = _ts(run_at)
    return landed.agg(F.max(ts_col).alias("max_created_on")).select(
        F.lit(source).alias("source"), now.alias("last_run_at"), now.alias("watermark"),
        "max_created_on")


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty landed table (first run, no snapshot yet)."""
    return spark.createDataFrame([], schema)
