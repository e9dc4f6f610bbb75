"""Data-quality checks: not_null / unique per (model, column), as one table
``check, model, column, failures``.

``unique`` counts the distinct non-null values that occur more than once
(the rows a uniqueness test returns); ``not_null`` counts NULL rows.

Each model is read once, however many checks it has: a row gives one (check, column, key)
for each column to be unique and for each NULL that must not be.  The rows of all models
are counted by one aggregation, which sums up equal keys before its exchange.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rejected(df: DataFrame, model: str) -> DataFrame:
    """Rows of a landing run's reject table (``landing.rejected``)."""
    return df.agg(F.count(F.lit(1)).cast("long").alias("failures")) \
        .select(F.lit("rejected").alias("check"), F.lit(model).alias("model"),
                F.lit("raw").alias("column"), "failures")


def _keys(df: DataFrame, model: str, tests: list[tuple[str, str]]) -> DataFrame:
    """(check, model, column, key) of the rows of one model that its tests count."""
    def entry(check: str, column: str):
        value = F.col(column)
        wanted = value.isNull() if check == "not_null" else value.isNotNull()
        key = F.lit(None) if check == "not_null" else value
        return F.when(wanted, F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"),
                                       key.cast("string").alias("key")))

    columns = df.select(*dict.fromkeys(c for _, c in tests))
    entries = columns.select(F.explode(F.array_compact(F.array(*(entry(*t) for t in tests)))).alias("e"))
    return entries.select("e.check", F.lit(model).alias("model"), "e.column", "e.key")


def run_checks(tests: Iterable[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """``tests``: (check, model, frame, column) -> one table of results.

    Tests of a model must come with one frame; it is read once.
    """
    frames: dict[str, DataFrame] = {}
    of: dict[str, list[tuple[str, str]]] = {}
    for check, model, df, column in tests:
        if check not in ("not_null", "unique"):
            raise ValueError(check)
        frames.setdefault(model, df)
        of.setdefault(model, []).append((check, column))
    counted = reduce(DataFrame.union, (_keys(frames[m], m, t) for m, t in of.items())) \
        .groupBy("check", "model", "column", "key").agg(F.count(F.lit(1)).alias("n"))
    failed = counted.select("check", "model", "column", F.when(F.col("check") == "not_null", F.col("n"))
                            .otherwise((F.col("n") > 1).cast("long")).alias("failures"))
    # Every test has a row, also without failures.
    spark = next(iter(frames.values())).sparkSession
    none = spark.createDataFrame([(c, m, x, 0) for m, t in of.items() for c, x in t],
                                 "check string, model string, column string, failures long")
    return failed.union(none).groupBy("check", "model", "column").agg(F.sum("failures").alias("failures"))
