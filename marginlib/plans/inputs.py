"""Landed input tables for a test-data directory.

The landed tables are what the landing jobs would have written: Spark
derives them from the test tables (payload fixtures -> landing) and writes
them once, as Parquet, under the shared folder named by
``spark.checkpoint.dir``.  The folder name is a fingerprint of the input
files (path, size, modification time) and of the landing code version, so
changed inputs are landed again.  Each table is written to a temporary
folder and renamed into place, so a lost executor or a concurrent run never
leaves a half-written table visible; a failed task is simply retried.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_conf, drop_shuffles, job_dir
from ..sources import landing, seeds, testdata

# Bump when the fixture or landing logic changes.
LANDING_VERSION = "8"
_SOURCES = {"raw_orders": ["orders", "lineitem", "part"],
            "raw_catalog": ["part"],
            "raw_returns": ["orders", "lineitem"]}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _fingerprint(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    h = hashlib.sha1(f"{LANDING_VERSION}|{sf_dir.rstrip('/')}".encode())
    for t in tables:
        p, fs = _fs(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        for st in sorted(fs.listStatus(p), key=lambda s: s.getPath().toString()):
            h.update(f"|{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def materialized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Read table ``name`` for ``sf_dir``; build and write it on first use."""
    apply_conf(spark)
    key = _fingerprint(spark, sf_dir, _SOURCES[name])
    base = job_dir(spark, "marginlib", "landed", key)
    final = f"{base}/{name}"
    fp, fs = _fs(spark, final)
    if not fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(fp, "_SUCCESS")):
        tmp = f"{base}/_tmp-{name}-{uuid.uuid4().hex}"
        # Documents are stored as whole VARIANT values: the models read whole
        # line arrays, and re-assembling shredded values on read costs more
        # than it saves.
        prev = spark.conf.get("spark.sql.variant.writeShredding.enabled", None)
        spark.conf.set("spark.sql.variant.writeShredding.enabled", "false")
        try:
            build().write.mode("overwrite").option("compression", "zstd").parquet(tmp)
        finally:
            if prev is None:
                spark.conf.unset("spark.sql.variant.writeShredding.enabled")
            else:
                spark.conf.set("spark.sql.variant.writeShredding.enabled", prev)
        tp, _ = _fs(spark, tmp)
        if not fs.rename(tp, fp):          # another run finished first
            fs.delete(tp, True)
        drop_shuffles(spark)
    return spark.read.parquet(final)


def build_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Sorted by creation time inside each task (no shuffle): Parquet row
    # groups then cover narrow time ranges, so date windows (re-pull, cost
    # watch) pushed to the scan skip most row groups.
    return (landing.land_orders(testdata.order_payloads(spark, sf_dir), testdata.FIXTURE_NOW)
            .drop("seq").sortWithinPartitions("created_on"))


def build_raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = landing.land_catalog(testdata.catalog_payloads(spark, sf_dir), testdata.FIXTURE_NOW)
    return c.where(F.col("product_id").isNotNull()).drop("seq")


def build_raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.land_returns(testdata.return_payloads(spark, sf_dir),
                                testdata.FIXTURE_NOW).drop("seq")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, sf_dir, "raw_orders", lambda: build_raw_orders(spark, sf_dir))


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, sf_dir, "raw_catalog", lambda: build_raw_catalog(spark, sf_dir))


def raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, sf_dir, "raw_returns", lambda: build_raw_returns(spark, sf_dir))


def channel_map(spark: SparkSession) -> DataFrame:
    return seeds.channel_map(spark)


def fee_rules(spark: SparkSession) -> DataFrame:
    return seeds.fee_rules(spark)
