"""Seed tables: channel map, channel fee rules, SKU aliases.

Seeds are small, hand-maintained reference tables.  Their size is bounded
by construction (one row per order source / channel / alias typed by a
person), which is what makes ``F.broadcast`` on them safe at any data
size.  They can be read from CSV files with declared types, or built from
the default values below.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, IntegerType,
                               StringType, StructField, StructType)

CHANNEL_MAP_SCHEMA = StructType([
    StructField("order_source", IntegerType()),
    StructField("company_id", StringType()),
    StructField("channel", StringType()),
])

FEE_RULES_SCHEMA = StructType([
    StructField("channel", StringType()),
    StructField("fee_method", StringType()),
    StructField("fee_pct", DecimalType(10, 4)),
    StructField("flat_fee", DecimalType(12, 2)),
    StructField("channel_pays_shipping", BooleanType()),
])

SKU_ALIASES_SCHEMA = StructType([
    StructField("entered_sku", StringType()),
    StructField("canonical_sku", StringType()),
])

# ---------------------------------------------------------------------------
# The default seed contents.  They must equal the business's
# seed files for results to match.
#
# channel_map (order_source, company_id, channel); a NULL company_id means
# "any company"; 6/195 is a company-specific override.
CHANNEL_MAP_ROWS = [
    (4, None, "Amazon"),
    (20, None, "Amazon"),
    (6, None, "Website"),
    (6, "195", "Lowe's"),
    (72, None, "Home Depot"),
    (50, None, "Walmart"),
    (79, None, "Walmart"),
    (42, None, "Walmart"),
    (1, None, "eBay"),
    (22, None, "Overstock"),
    (0, None, "Local Store"),
    (62, None, "Target"),
]

# channel_fee_rules (channel, fee_method, fee_pct, flat_fee, channel_pays_shipping)
FEE_RULES_ROWS = [
    ("Amazon", "from_actuals", "0", "0", False),
    ("eBay", "from_actuals", "0", "0", False),
    ("Walmart", "from_actuals", "0", "0", False),
    ("Website", "computed_pct_flat", "0.024", "0.30", False),
    ("Home Depot", "wholesale_none", "0", "0", True),
    ("Lowe's", "wholesale_none", "0", "0", True),
    ("Overstock", "wholesale_none", "0", "0", True),
    ("Local Store", "none", "0", "0", False),
    ("Target", "from_actuals", "0", "0", False),
    ("Other", "none", "0", "0", False),
]

# sku_aliases (entered_sku, canonical_sku): ships empty.
SKU_ALIASES_ROWS: list[tuple[str, str]] = []
# ---------------------------------------------------------------------------

# Size up to which a seed is broadcast.
BROADCAST_BYTES = 8 << 20

# Fee methods understood by the costing step.
FROM_ACTUALS = "from_actuals"
COMPUTED_PCT_FLAT = "computed_pct_flat"
WHOLESALE_NONE = "wholesale_none"
# Channel for orders whose source is not in the channel map.
DEFAULT_CHANNEL = "Other"


def _literal(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """``rows`` as literals of the plan, whose size the plan knows: a frame made from Python
    rows has no size, so ``small`` would leave it to a shuffle of what it is joined to."""
    array = F.array(*(F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)))
                      for r in rows))
    return spark.range(0, 1, 1, 1).select(F.inline(array))


def channel_map(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return _read_csv(spark, path, CHANNEL_MAP_SCHEMA)
    return _literal(spark, CHANNEL_MAP_ROWS, CHANNEL_MAP_SCHEMA)


def fee_rules(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return _read_csv(spark, path, FEE_RULES_SCHEMA)
    rows = [(c, m, Decimal(p), Decimal(f), s) for c, m, p, f, s in FEE_RULES_ROWS]
    return _literal(spark, rows, FEE_RULES_SCHEMA)


def sku_aliases(spark: SparkSession, path: str | None = None) -> DataFrame:
    if path:
        return _read_csv(spark, path, SKU_ALIASES_SCHEMA)
    return spark.createDataFrame(SKU_ALIASES_ROWS, SKU_ALIASES_SCHEMA)


def _read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Seed CSV with a header and declared column types (no inference).

    An empty field is NULL, as a seed loader would store it.
    """
    return (spark.read.schema(schema)
            .option("header", "true")
            .option("mode", "FAILFAST")
            .csv(path))


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its plan says that it has ``most`` bytes at most
    (a CSV counts with the size of its files); else as it is, for a shuffle join or
    what the adaptive plan measures."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= most else df


def prepared_channel_lookups(channel_map_df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the channel map into (specific, generic) lookups.

    specific: (order_source, company_id) -> channel, company_id non-blank
    generic:  order_source -> channel, company_id blank/NULL
    A company-specific row beats the generic row for the same source.  If
    a seed lists a key twice, the smallest channel name is kept so the
    result does not depend on row order.
    """
    # Seeds are tiny: one partition satisfies the grouping below, so the
    # dedup runs without a shuffle.
    m = channel_map_df.coalesce(1).select(
        "order_source",
        F.when(F.trim("company_id") != "", F.trim("company_id")).alias("company_id"),
        "channel")
    specific = (m.where(F.col("company_id").isNotNull())
                .groupBy("order_source", "company_id")
                .agg(F.min("channel").alias("specific_channel")))
    generic = (m.where(F.col("company_id").isNull())
               .groupBy("order_source")
               .agg(F.min("channel").alias("generic_channel")))
    return specific, generic


def prepared_fee_rules(fee_rules_df: DataFrame) -> DataFrame:
    """One rule per channel; NULL pct / flat fee mean 0 (no shuffle: one
    partition)."""
    return (fee_rules_df.coalesce(1)
            .groupBy("channel")
            .agg(F.min_by(F.struct(
                     "fee_method",
                     F.coalesce("fee_pct", F.lit(0).cast("decimal(10,4)")).alias("fee_pct"),
                     F.coalesce("flat_fee", F.lit(0).cast("decimal(12,2)")).alias("flat_fee"),
                     "channel_pays_shipping"), "fee_method").alias("r"))
            .select("channel", "r.*"))
