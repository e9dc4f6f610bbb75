"""Returns: one row per (submission, typed SKU), disposition-categorised,
cost-allocated and matched to a canonical SKU in tiers
alias -> exact -> normalized -> unmatched.

Plan: the comma list is split and cleaned as an array, its size gives the
part count (no window, no shuffle on the returns side), then it is
exploded.  Different typed SKUs, counted with partial sums, are matched
against the three references, each grouped by its key; the lines then
take their SKU's match.  The ``HEAVY`` commonest SKUs are broadcast for that, as
their lines would meet in one task; the others are shuffled once, and AQE
broadcasts their matches too whenever the measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import dec, qdiv

# Disposition prefixes (upper-cased, tested in this order) and
# the category each maps to; anything else is 'unknown'.
DISPOSITION_PREFIXES = [
    ("NEW OPEN BOX", "open_box"),
    ("NEW", "new"),
    ("REFURBISHED", "refurbished"),
    ("USED", "used"),
    ("WARRANTY", "warranty"),
    ("PARTS", "scrapped"),
]
UNKNOWN = "unknown"
# Typed SKUs whose matches are broadcast: any with over 1/HEAVY of the lines is one of them.
HEAVY = 64

STG_RETURNS_COLUMNS = ["return_line_id", "submission_id", "created_at", "order_rma",
                       "channel_reported", "reason", "disposition", "disposition_category",
                       "sku_entered", "sku_norm", "sku", "sku_match_status", "skus_in_submission",
                       "submission_processing_cost", "processing_cost", "labor_cost",
                       "is_warranty", "resells_as_new", "resells_as_sd", "is_scrapped"]


def key_exact(c: Column) -> Column:
    return F.lower(F.trim(c))


def _alphanumerics(c: Column) -> Column:
    return F.regexp_replace(c, "[^a-z0-9]+", "")


def key_fuzzy(c: Column) -> Column:
    return _alphanumerics(key_exact(c))


def disposition_category(d: Column) -> Column:
    u = F.upper(d)
    expr = None
    for prefix, cat in DISPOSITION_PREFIXES:
        cond = u.startswith(prefix)
        expr = F.when(cond, cat) if expr is None else expr.when(cond, cat)
    return expr.otherwise(UNKNOWN)


def exploded(raw_returns: DataFrame) -> DataFrame:
    """J6 + P7 + W2 + F17 + F15 + F19: one row per non-blank typed SKU."""
    parts = F.filter(F.transform(F.split(F.coalesce("sku_raw", F.lit("")), ","), lambda p: F.trim(p)),
                     lambda p: p != "")
    r = raw_returns.select(
        "submission_id", "created_at", "order_rma", "channel", "reason", "disposition",
        "labor_cost", "processing_cost", parts.alias("parts"))
    n = F.size("parts").cast("long")
    r = r.withColumns({
        "skus_in_submission": n,
        "processing_cost_alloc": F.round(
            qdiv(F.coalesce("processing_cost", F.lit(0).cast("decimal(12,2)")), n,
                 in_type=dec(20, 2), out_type=dec(38, 12)), 2).cast(dec(12, 2)),
        "disposition_category": disposition_category(F.col("disposition")),
    })
    e = r.select("*", F.explode("parts").alias("sku_entered")).drop("parts")
    return e.withColumns({"key_exact": key_exact(F.col("sku_entered")),
                          "key_fuzzy": key_fuzzy(F.col("sku_entered"))})


def sku_universe(stg_catalog_df: DataFrame, distinct: bool = True) -> DataFrame:
    """Every catalog SKU in its own and its canonical form.

    ``distinct=False`` keeps duplicates; the references below only take
    ``min`` and a distinct-count test, which duplicates do not change.
    """
    own = (stg_catalog_df.where(F.coalesce(F.trim("sku"), F.lit("")) != "")
           .select(F.col("sku").alias("raw_sku"), "canonical_sku"))
    canon = (stg_catalog_df.where(F.coalesce(F.trim("canonical_sku"), F.lit("")) != "")
             .select(F.col("canonical_sku").alias("raw_sku"), "canonical_sku"))
    u = own.unionByName(canon)
    return u.distinct() if distinct else u


def ref_exact(universe: DataFrame) -> DataFrame:
    """lower/trim key -> smallest canonical SKU (no ambiguity guard)."""
    return (universe.groupBy(key_exact(F.col("raw_sku")).alias("k"))
            .agg(F.min("canonical_sku").alias("canonical_sku")))


def ref_fuzzy(universe: DataFrame) -> DataFrame:
    """Alphanumeric key -> canonical SKU, only when exactly one exists.

    ``count(distinct canonical) = 1`` is computed as ``min = max`` (the
    canonical SKU is never NULL here), which keeps it a plain hash
    aggregate.
    """
    return (universe.groupBy(key_fuzzy(F.col("raw_sku")).alias("k"))
            .agg(F.min("canonical_sku").alias("canonical_sku"),
                 F.max("canonical_sku").alias("mx"))
            .where(F.col("canonical_sku") == F.col("mx"))
            .drop("mx"))


def aliases_ref(aliases: DataFrame) -> DataFrame:
    """Alias key -> smallest canonical SKU."""
    return (aliases.where(F.coalesce(F.trim("entered_sku"), F.lit("")) != "")
            .groupBy(key_exact(F.col("entered_sku")).alias("k"))
            .agg(F.min("canonical_sku").alias("canonical_sku")))


def matched_keys(lines: DataFrame, stg_catalog_df: DataFrame, aliases: DataFrame) -> DataFrame:
    """(k, lines, al_sku, re_sku, rf_sku), a row for each different typed SKU of ``lines``."""
    u = sku_universe(stg_catalog_df, distinct=False)
    al = aliases_ref(aliases).select(F.col("k").alias("al_k"), F.col("canonical_sku").alias("al_sku"))
    re_ = ref_exact(u).select(F.col("k").alias("re_k"), F.col("canonical_sku").alias("re_sku"))
    rf = ref_fuzzy(u).select(F.col("k").alias("rf_k"), F.col("canonical_sku").alias("rf_sku"))
    keys = lines.groupBy(F.col("key_exact").alias("k")).agg(F.count("*").alias("lines"))
    return (keys.join(al, F.col("k") == F.col("al_k"), "left")
            .join(re_, F.col("k") == F.col("re_k"), "left")
            .join(rf, _alphanumerics(F.col("k")) == F.col("rf_k"), "left")
            .select("k", "lines", *_TIERS))


_TIERS = ("al_sku", "re_sku", "rf_sku")


def _matched(lines: DataFrame, matches: DataFrame) -> DataFrame:
    """``lines`` with the columns of their SKU's row in ``matches``."""
    heavy = (matches.orderBy(F.desc("lines"), "k").limit(HEAVY)
             .select(F.col("k").alias("heavy_k"), *(F.col(t).alias(f"heavy_{t}") for t in _TIERS)))
    light = matches.select(F.col("k").alias("light_k"), *(F.col(t).alias(f"light_{t}") for t in _TIERS))
    is_heavy = F.col("heavy_k").isNotNull()
    # Lines that have their match already are spread by submission.
    spread = F.concat(F.lit("\u0000"), F.coalesce("submission_id", F.lit("")))
    j = (lines.join(F.broadcast(heavy), F.col("key_exact") == F.col("heavy_k"), "left")
         .withColumn("spot", F.when(is_heavy, spread).otherwise(F.col("key_exact")))
         .join(light, F.col("spot") == F.col("light_k"), "left"))
    return j.select(*lines.columns, *(F.when(is_heavy, F.col(f"heavy_{t}")).otherwise(F.col(f"light_{t}")).alias(t)
                                      for t in _TIERS))


def stg_returns(raw_returns: DataFrame, stg_catalog_df: DataFrame, aliases: DataFrame) -> DataFrame:
    """J7 + F16 + F18 + F20: the cleaned returns table."""
    p = exploded(raw_returns)
    j = _matched(p, matched_keys(p, stg_catalog_df, aliases))
    cat = F.col("disposition_category")
    status = (F.when(F.col("al_sku").isNotNull(), "alias")
               .when(F.col("re_sku").isNotNull(), "exact")
               .when(F.col("rf_sku").isNotNull(), "normalized")
               .otherwise("unmatched"))
    return j.select(
        F.concat(F.col("submission_id"), F.lit("|"), F.col("key_exact")).alias("return_line_id"),
        "submission_id", "created_at", "order_rma",
        F.col("channel").alias("channel_reported"), "reason", "disposition", "disposition_category",
        "sku_entered", F.col("key_exact").alias("sku_norm"),
        F.coalesce("al_sku", "re_sku", "rf_sku", "sku_entered").alias("sku"),
        status.alias("sku_match_status"),
        "skus_in_submission",
        F.col("processing_cost").alias("submission_processing_cost"),
        F.col("processing_cost_alloc").alias("processing_cost"),
        "labor_cost",
        (cat == "warranty").alias("is_warranty"),
        cat.isin("new", "open_box").alias("resells_as_new"),
        cat.isin("used", "refurbished").alias("resells_as_sd"),
        (cat == "scrapped").alias("is_scrapped"))
