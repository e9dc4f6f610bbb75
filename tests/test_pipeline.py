"""The end-to-end job writes every table and equals the per-query plans."""
import uuid

from helpers import rows
from marginlib.plans import pipeline
from marginlib.plans.queries import QUERIES
from marginlib.session import job_dir

SF = "/root/testdata/sf0.001"


def test_pipeline_outputs_equal_queries(spark):
    out = job_dir(spark, "test-pipeline", uuid.uuid4().hex)
    written = pipeline.run_for_testdata(spark, SF, out)
    assert set(written) == {"int_order_items_costed", "fct_order_item_profit", "fct_sku_profit",
                            "fct_sku_profit_monthly", "fct_sku_channel", "fct_sku_cost_watch",
                            "stg_returns", "dq_checks"}
    for name in ["fct_sku_profit", "fct_sku_channel", "fct_sku_cost_watch", "fct_sku_profit_monthly"]:
        got = spark.read.parquet(written[name])
        assert rows(got) == rows(QUERIES[name](spark, SF)), name
    dq = {(r["check"], r["model"], r["column"]): r["failures"]
          for r in spark.read.parquet(written["dq_checks"]).collect()}
    assert dq[("unique", "fct_sku_profit", "sku")] == 0
    assert dq[("not_null", "stg_returns", "sku")] == 0


def test_cost_watch_reads_only_recent_months(spark):
    out = job_dir(spark, "test-pipeline", uuid.uuid4().hex)
    written = pipeline.run_for_testdata(spark, SF, out)
    from pyspark.sql import functions as F
    lines = spark.read.parquet(written["int_order_items_costed"])
    pruned = lines.where(F.col(pipeline.MONTH) >= F.lit("2001-05-01").cast("date"))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan
