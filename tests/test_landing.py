"""Landing coercions, latest-wins upserts, streaming upsert, checks."""
import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from helpers import NOW, payloads, raw_returns, rows
from marginlib.operators import checks, costing, staging, upsert
from marginlib.session import job_dir
from marginlib.sources import landing, seeds
from marginlib.streaming import upsert_stream


def test_order_landing_types_and_timestamps(spark):
    docs = [{"ID": 7, "CreatedOn": "2024-08-19T10:44:20.543Z", "LastUpdated": "2024",
             "GrandTotal": "12.345", "OrderSource": 4, "StatusCode": "3"}]
    r = landing.land_orders(payloads(spark, docs), NOW).collect()[0]
    assert r["order_id"] == 7 and r["status_code"] == 3 and r["order_source"] == 4
    assert r["created_on"] == dt.datetime(2024, 8, 19, 10, 44, 20, 543000)
    assert r["last_updated"] is None            # not an ISO timestamp
    assert r["grand_total"] == D("12.35")
    assert r["raw"].toJson().startswith("{")   # whole document kept as VARIANT


def test_catalog_id_truthiness(spark):
    docs = [{"ProductID": "", "ID": 0, "Sku": "S1"}, {"SKU": "S2", "Sku": ""}, {"ID": 5},
            {"ProductName": "no id"}, {"ProductID": "P", "AverageCost": "$1,234.5"}]
    c = landing.land_catalog(payloads(spark, docs), NOW)
    assert rows(c, "product_id", "average_cost") == sorted(
        [("S1", None), ("S2", None), ("5", None), (None, None), ("P", D("1234.5000"))], key=repr)
    assert upsert.skipped_without_key(c, "product_id").collect()[0][0] == 1


def test_return_answers(spark):
    docs = [{"id": 11, "created_at": "2024-08-19 10:44:20",
             "answers": {"9": {"answer": "RMA1"}, "10": {"answer": "A,B"},
                         "15": {"answer": {"hh": "09", "mm": "40"}},
                         "122": {"answer": " $12.50 "}, "123": {"answer": {"x": 1}}}}]
    r = raw_returns(spark, docs).collect()[0]
    assert r["submission_id"] == "11" and r["order_rma"] == "RMA1" and r["sku_raw"] == "A,B"
    assert r["reason"] == '{"hh":"09","mm":"40"}'
    assert r["labor_cost"] == D("12.50") and r["processing_cost"] is None
    assert r["channel"] is None


def test_upsert_last_occurrence_wins(spark):
    snap = spark.createDataFrame([(1, "old"), (2, "keep")], "k long, v string")
    batch = spark.createDataFrame([(1, "first", 1), (1, "last", 2), (3, "new", 0), (None, "x", 9)],
                                  "k long, v string, seq long")
    out = upsert.upsert(snap, batch, "k")
    assert rows(out) == [(1, "last"), (2, "keep"), (3, "new")]
    again = upsert.upsert(out, batch, "k")
    assert rows(again) == rows(out)             # applying a batch twice = once


def test_snapshot_versions(spark):
    d = job_dir(spark, "test-snapshots", str(id(spark)) + "a")
    schema = "k long, v string"
    assert upsert.read_snapshot(spark, d, schema).count() == 0
    upsert.write_snapshot(spark, spark.createDataFrame([(1, "a")], schema), d)
    upsert.write_snapshot(spark, spark.createDataFrame([(1, "b")], schema), d)
    assert rows(upsert.read_snapshot(spark, d, schema)) == [(1, "b")]


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    ev = spark.createDataFrame(
        [(1, 1, "a", 1), (1, 2, "b", 1), (2, 1, "c", 2), (1, 0, "late-but-old", 3), (3, 5, "d", 3)],
        "user_id long, ts long, payload string, part int")
    ev.repartition("part").write.partitionBy("part").parquet(src)
    schema = ev.schema
    base = job_dir(spark, "test-stream", tmp_path.name)
    upsert_stream.run_upsert_stream(spark, src, schema, ["user_id"], ["ts"], f"{base}/t", f"{base}/c")
    got = upsert.read_snapshot(spark, f"{base}/t", None).select("user_id", "ts", "payload")
    expect = upsert.latest_per_key(ev.drop("part"), ["user_id"], ["ts"])
    assert rows(got) == rows(expect) == [(1, 2, "b"), (2, 1, "c"), (3, 5, "d")]


def test_checks_table(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    out = checks.run_checks([("not_null", "m", df, "k"), ("unique", "m", df, "k")])
    assert rows(out) == [("not_null", "m", "k", 1), ("unique", "m", "k", 1)]


def test_windows(spark):
    docs = [{"ID": i, "CreatedOn": f"2024-08-{d:02d}T00:00:00Z"} for i, d in enumerate([1, 10, 20, 31])]
    ro = landing.land_orders(payloads(spark, docs), NOW)
    w = landing.orders_window(ro, since="2024-08-10 00:00:00", until="2024-08-20 00:00:00")
    assert rows(w, "order_id") == [(1,), (2,)]
    rr = raw_returns(spark, [{"id": "a", "created_at": "2024-08-10 00:00:00"},
                             {"id": "b", "created_at": "2024-08-11 00:00:00"}])
    assert rows(landing.returns_since(rr, "2024-08-10 00:00:00"), "submission_id") == [("b",)]


def test_partitioned_upsert_rewrites_touched_partitions(spark):
    import os
    base = job_dir(spark, "test-upsert-part", str(os.getpid()) + "x")
    t = f"{base}/table"
    first = spark.createDataFrame(
        [(1, "a", "2024-01", 0), (2, "b", "2024-01", 0), (3, "c", "2024-02", 0), (4, "d", "2024-03", 0)],
        "k long, v string, month string, seq long")
    upsert.upsert_partitioned(spark, t, first, "k", "month")
    march = f"{t}/month=2024-03"
    before = sorted(os.listdir(march)) if os.path.isdir(march) else None
    # key 3 moves to 2024-01 (emptying 2024-02), key 1 changes twice, key 5 is new
    batch = spark.createDataFrame(
        [(1, "a1", "2024-01", 1), (1, "a2", "2024-01", 2), (3, "c1", "2024-01", 1),
         (5, "e", "2024-04", 1)], "k long, v string, month string, seq long")
    upsert.upsert_partitioned(spark, t, batch, "k", "month")
    got = spark.read.parquet(t).select("k", "v", "month")
    expect = upsert.upsert(first.drop("seq"), batch, "k")
    assert rows(got) == rows(expect.select("k", "v", "month")) == [
        (1, "a2", "2024-01"), (2, "b", "2024-01"), (3, "c1", "2024-01"), (4, "d", "2024-03"),
        (5, "e", "2024-04")]
    if before is not None:                       # untouched partition not rewritten
        assert sorted(os.listdir(march)) == before
    assert not os.path.isdir(f"{t}/month=2024-02")


def test_documents_from_json_lines_files(spark, tmp_path):
    import json as _json
    d = tmp_path / "orders"
    d.mkdir()
    (d / "a.jsonl").write_text("\n".join(_json.dumps(x) for x in [
        {"ID": 1, "StatusCode": 1}, {"ID": 2, "StatusCode": 1}, {"ID": 1, "StatusCode": 2}]) + "\n\n")
    docs = landing.read_documents(spark, str(d))
    landed = landing.land_orders(docs, NOW)
    out = upsert.upsert(landing.empty(spark, landing.RAW_ORDERS_SCHEMA), landed, "order_id")
    assert rows(out, "order_id", "status_code") == [(1, 2), (2, 1)]


def test_stream_into_partitioned_table(spark, tmp_path):
    src = str(tmp_path / "in")
    ev = spark.createDataFrame(
        [(1, 1, "a", "m1", 1), (1, 2, "b", "m2", 1), (2, 1, "c", "m1", 2), (1, 0, "old", "m1", 3),
         (3, 5, "d", "m3", 3)],
        "user_id long, ts long, payload string, month string, part int")
    ev.repartition("part").write.partitionBy("part").parquet(src)
    base = job_dir(spark, "test-stream-part", tmp_path.name)
    upsert_stream.run_upsert_stream(spark, src, ev.schema, ["user_id"], ["ts"], f"{base}/t",
                                    f"{base}/c", partition_cols=["month"])
    got = spark.read.parquet(f"{base}/t").select("user_id", "ts", "payload", "month")
    assert rows(got) == [(1, 2, "b", "m2"), (2, 1, "c", "m1"), (3, 5, "d", "m3")]


def test_sync_state_row(spark):
    docs = [{"ID": 1, "CreatedOn": "2024-08-01T00:00:00Z"}, {"ID": 2, "CreatedOn": "2024-08-05T00:00:00Z"}]
    ro = landing.land_orders(payloads(spark, docs), NOW)
    st = landing.sync_state(ro, "orders", "2024-09-01 00:00:00")
    old = spark.createDataFrame([("orders", None, None, None), ("returns", None, None, None)],
                                landing.SYNC_STATE_SCHEMA)
    out = upsert.upsert(old, st.withColumn("seq", F.lit(1)), "source")
    got = {r["source"]: r for r in out.collect()}
    assert got["orders"]["watermark"] == dt.datetime(2024, 9, 1)
    assert got["orders"]["max_created_on"] == dt.datetime(2024, 8, 5)
    assert got["returns"]["watermark"] is None


def test_repeated_keys_and_rejected_documents(spark):
    docs = payloads(spark, ['{"ID": 1, "StatusCode": 1, "StatusCode": 2}', '{"ID": 2', '{"ID": 3}'])
    assert rows(landing.land_orders(docs, NOW).where("raw is not null"), "order_id", "status_code") == [(1, 2), (3, None)]
    bad = landing.rejected(docs, NOW)
    assert rows(bad, "value", "reason", "seq") == [('{"ID": 2', "not JSON", 1)]
    assert rows(checks.rejected(bad, "raw_orders")) == [("rejected", "raw_orders", "raw", 1)]


@pytest.mark.parametrize("total", ["999999999999999999", "1e36", '"999999999999999"'])
def test_amounts_too_large_are_errors_not_zero(spark, total):
    line = '{"ID": 7, "ProductID": "A", "Qty": 1, "LineTotal": %s}'
    ro = landing.land_orders(payloads(spark, ['{"ID": 1, "Items": [' + line % total + ']}',
                                              '{"ID": 2, "Items": [' + line % '"12,50"' + ']}']), NOW)
    seeds_of = seeds.channel_map(spark), seeds.fee_rules(spark)
    for df in (staging.stg_order_items(ro), costing.costed_lines(ro, *seeds_of)):
        with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
            df.collect()
    assert rows(staging.stg_order_items(ro.where("order_id = 2")), "revenue") == [(D("0.0000"),)]
    assert rows(staging.malformed_line_numbers(ro).where("failures > 0"), "column", "failures") == [("LineTotal", 2)]
    header = landing.land_orders(payloads(spark, ['{"ID": 3, "FinalShippingFee": %s}' % total]), NOW)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        staging.stg_orders(header).collect()
    assert rows(staging.malformed_document_numbers(header, "stg_orders", ["FinalShippingFee"]), "failures") == [(1,)]
