"""The registered query set: name -> (spark, sf_dir) -> DataFrame.

Every query reads the test tables of ``sf_dir`` (through the payload
fixtures and landing, i.e. data Spark derives from them) and runs over all
rows.  Timestamps are emitted as 'yyyy-MM-dd HH:mm:ss' text so results
compare across engines; everything else keeps its type.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce
from ..operators import checks, costing, marts, returns, staging, upsert
from ..sources import landing, testdata
from . import inputs

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (part of the query definition).
EXCLUDED_CODES = [3]
REPULL_UNTIL = testdata.AS_OF                 # S4 window end (inclusive day)
REPULL_DAYS = 30                              # S4 default look-back
RETURNS_SINCE = "2001-06-01 00:00:00"         # S5 strict lower bound
UPSERT_SNAPSHOT_BEFORE = "2001-06-01"         # orders already landed
UPSERT_BATCH_FROM = "2001-05-01"              # re-pulled window (overlaps)
UPSERT_NEW_STATUS = 3
WINDOW_DAYS = 90

COSTED_TYPES = {
    "order_revenue": "decimal(22,4)", "order_shipping_cost": "decimal(18,4)",
    "fee_pct": "decimal(10,4)", "flat_fee": "decimal(12,2)",
    "allocated_shipping_cost": "decimal(26,12)", "allocated_flat_fee": "decimal(26,12)",
    "channel_fee": "decimal(26,12)", "list_discount": "decimal(22,8)",
    "gross_profit": "decimal(24,8)", "net_revenue": "decimal(19,4)",
    "contribution": "decimal(30,12)",
}
TS_COLUMNS = {"created_on", "last_updated", "ordered_at", "extracted_at", "created_at",
              "last_run_at", "watermark", "max_created_on", "ts"}


def ts_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def present(df: DataFrame, types: dict | None = None) -> DataFrame:
    """Timestamps to text, declared output types applied."""
    types = types or {}
    out = []
    for c in df.columns:
        col = F.col(c)
        if c in TS_COLUMNS:
            col = ts_text(col)
        elif c in types:
            col = col.cast(types[c])
        out.append(col.alias(c))
    return df.select(*out)


# --- shared building blocks ---------------------------------------------------

def _costed(spark, sf, excluded=()) -> DataFrame:
    return costing.costed_lines(inputs.raw_orders(spark, sf), inputs.channel_map(spark),
                                inputs.fee_rules(spark), excluded)


def _catalog(spark, sf) -> DataFrame:
    return staging.stg_catalog(inputs.raw_catalog(spark, sf))


def _stg_returns(spark, sf) -> DataFrame:
    return returns.stg_returns(inputs.raw_returns(spark, sf), _catalog(spark, sf),
                               testdata.test_aliases(spark, sf))


# --- sources ------------------------------------------------------------------

def q_land_orders(spark, sf):
    return present(inputs.raw_orders(spark, sf).drop("raw", "header", "items"))


def q_land_catalog(spark, sf):
    return inputs.raw_catalog(spark, sf).select("product_id", "product_name", "shadow_of",
                                                "average_cost")


def q_land_returns(spark, sf):
    return present(inputs.raw_returns(spark, sf).drop("raw", "extracted_at"))


def q_orders_repull_window(spark, sf):
    until = F.lit(REPULL_UNTIL).cast("date")
    w = landing.orders_window(inputs.raw_orders(spark, sf),
                              since=F.date_sub(until, REPULL_DAYS).cast("timestamp"),
                              until=(F.date_add(until, 1).cast("timestamp") - F.expr("INTERVAL 1 SECOND")))
    return present(w.select("order_id", "created_on", "status_code", "grand_total"))


def q_returns_since(spark, sf):
    r = landing.returns_since(inputs.raw_returns(spark, sf), RETURNS_SINCE)
    return present(r.select("submission_id", "created_at", "order_rma"))


def _upsert_orders_result(spark, sf) -> DataFrame:
    # The re-pulled documents are the landed rows; arrival order = order id.
    landed = inputs.raw_orders(spark, sf).withColumn("seq", F.col("order_id"))
    snapshot = landed.where(F.col("created_on") < F.lit(UPSERT_SNAPSHOT_BEFORE).cast("timestamp")) \
        .drop("seq")
    window = landed.where(F.col("created_on") >= F.lit(UPSERT_BATCH_FROM).cast("timestamp"))
    # The re-pull sees every order twice: as first paged, then after an
    # edit; the later occurrence must win.
    first = window.withColumn("seq", F.col("seq") * 2)
    edited = window.withColumns({"seq": F.col("seq") * 2 + 1,
                                 "status_code": F.lit(UPSERT_NEW_STATUS),
                                 "extracted_at": F.lit("2001-08-03 06:00:00").cast("timestamp")})
    return upsert.upsert(snapshot, edited.unionByName(first), "order_id")


def q_upsert_orders(spark, sf):
    r = _upsert_orders_result(spark, sf)
    return present(r.select("order_id", "status_code", "grand_total", "created_on", "extracted_at"))


def q_upsert_orders_partitioned(spark, sf):
    """Same re-pull as ``upsert_orders``, into a table partitioned by the
    month of creation: only the months the re-pull touches are rewritten."""
    import uuid

    from ..session import job_dir
    landed = inputs.raw_orders(spark, sf).withColumns({
        "seq": F.col("order_id"),
        "created_month": F.date_format("created_on", "yyyy-MM")})
    table = job_dir(spark, "marginlib", "upsert", uuid.uuid4().hex, "raw_orders")
    first = landed.where(F.col("created_on") < F.lit(UPSERT_SNAPSHOT_BEFORE).cast("timestamp"))
    upsert.upsert_partitioned(spark, table, first, "order_id", "created_month")
    window = landed.where(F.col("created_on") >= F.lit(UPSERT_BATCH_FROM).cast("timestamp"))
    edited = window.withColumns({"seq": F.col("seq") * 2 + 1,
                                 "status_code": F.lit(UPSERT_NEW_STATUS),
                                 "extracted_at": F.lit("2001-08-03 06:00:00").cast("timestamp")})
    batch = edited.unionByName(window.withColumn("seq", F.col("seq") * 2))
    upsert.upsert_partitioned(spark, table, batch, "order_id", "created_month")
    r = spark.read.parquet(table)
    return present(r.select("order_id", "status_code", "grand_total", "created_on", "extracted_at"))


def q_upsert_catalog(spark, sf):
    """The whole catalog pulled again, each product twice: as landed, then with
    every third product renamed; the later occurrence wins."""
    landed = inputs.raw_catalog(spark, sf)
    pk = F.regexp_extract("product_id", r"(\d+)$", 1).cast("long")
    renamed = F.when(pk % 3 == 0, F.concat("product_name", F.lit(" v2"))).otherwise(F.col("product_name"))
    batch = (landed.withColumns({"product_name": renamed, "seq": F.lit(2)})
             .unionByName(landed.withColumn("seq", F.lit(1))))
    r = upsert.upsert(landed, batch, "product_id")
    return r.select("product_id", "product_name", "shadow_of", "average_cost")


def q_upsert_returns(spark, sf):
    """Submissions since a time pulled again, with another disposition, into
    the table of all of them."""
    landed = inputs.raw_returns(spark, sf)
    batch = landing.returns_since(landed, RETURNS_SINCE).withColumns({
        "disposition": F.lit("Used - rechecked"), "seq": F.lit(1)})
    r = upsert.upsert(landed, batch, "submission_id")
    return present(r.select("submission_id", "created_at", "disposition", "processing_cost"))


def q_sync_state(spark, sf):
    state = landing.sync_state(inputs.raw_orders(spark, sf), "orders", testdata.FIXTURE_NOW)
    empty = landing.empty(spark, landing.SYNC_STATE_SCHEMA)
    return present(upsert.upsert(empty, state.withColumn("seq", F.lit(1)), "source"))


def q_upsert_events_latest(spark, sf):
    ev = testdata.table(spark, sf, "events")
    cols = ["user_id", "event_id", "ts", "event_type", "value"]
    empty = spark.createDataFrame([], ev.select(*cols).schema)   # first run: no snapshot yet
    r = upsert.upsert(empty, ev, "user_id", seq=["ts", "event_id"])
    return present(r)


# --- coercions of loose values --------------------------------------------------

def q_coerce_num(spark, sf):
    p = F.col("l_partkey").cast("string")
    kinds = [F.concat(F.lit("$1,"), F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0"), F.lit(".25")),
             F.concat(F.lit(" -"), p, F.lit(".5 ")), F.lit(""), F.lit("n/a"),
             F.concat(F.lit('{"amount":'), p, F.lit("}")), F.lit("999999999999999999"), p,
             F.lit(None).cast("string")]
    sent = F.get(F.array(*kinds), ((F.col("l_orderkey") + F.col("l_linenumber")) % 8).cast("int"))
    rows = testdata.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", sent.alias("sent"))
    return rows.withColumn("num", coerce.to_num(F.col("sent")))


def q_coerce_ts(spark, sf):
    at = F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey") % 86400)
    kinds = [F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
             F.date_format(at + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'"),
             F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.date_format(at, "yyyy"), F.lit("yesterday"),
             F.lit(None).cast("string")]
    sent = F.get(F.array(*kinds), (F.col("o_orderkey") % 6).cast("int"))
    rows = testdata.table(spark, sf, "orders").select("o_orderkey", sent.alias("sent"))
    return present(rows.withColumn("ts", coerce.parse_ts(F.col("sent"))))


def q_coerce_text(spark, sf):
    """Answers of every JSON kind, as text."""
    size = F.col("p_size").cast("string")
    kinds = [F.to_json(F.struct(F.col("p_name").alias("answer"))),
             F.concat(F.lit('{"answer":'), F.col("p_partkey").cast("string"), F.lit("}")),
             F.lit('{"answer":true}'), F.concat(F.lit('{"answer":{"hh":"'), size, F.lit('"}}')),
             F.concat(F.lit('{"answer":["'), F.col("p_brand"), F.lit('",'), size, F.lit("]}")),
             F.lit('{"answer":""}'), F.lit('{"answer":null}')]
    doc = F.get(F.array(*kinds), (F.col("p_partkey") % 7).cast("int"))
    rows = testdata.table(spark, sf, "part").select("p_partkey", F.try_parse_json(doc).alias("doc"))
    return rows.select("p_partkey", coerce.vtext(F.col("doc"), "$.answer").alias("txt"))


# --- staging ------------------------------------------------------------------

def q_stg_orders(spark, sf):
    return present(staging.stg_orders(inputs.raw_orders(spark, sf)))


def q_stg_orders_excluded(spark, sf):
    return present(staging.stg_orders(inputs.raw_orders(spark, sf), EXCLUDED_CODES))


def q_stg_order_items(spark, sf):
    return staging.stg_order_items(inputs.raw_orders(spark, sf))


def q_stg_catalog(spark, sf):
    return _catalog(spark, sf)


# --- costing ------------------------------------------------------------------

def q_int_order_items_costed(spark, sf):
    return present(_costed(spark, sf).select(*costing.INT_COSTED_COLUMNS), COSTED_TYPES)


def q_int_order_items_costed_excluded(spark, sf):
    return present(_costed(spark, sf, EXCLUDED_CODES).select(*costing.INT_COSTED_COLUMNS),
                   COSTED_TYPES)


def q_int_order_items_costed_joined(spark, sf):
    c = costing.costed_lines_joined(inputs.raw_orders(spark, sf), inputs.channel_map(spark),
                                    inputs.fee_rules(spark))
    return present(c, COSTED_TYPES)


def q_order_channel(spark, sf):
    o = staging.stg_orders(inputs.raw_orders(spark, sf))
    return costing.order_channel(o, inputs.channel_map(spark)).select(
        "order_id", "order_source", "company_id", "channel")


def q_order_revenue(spark, sf):
    return costing.order_revenue(staging.stg_order_items(inputs.raw_orders(spark, sf)))


def q_shipping_allocation(spark, sf):
    c = _costed(spark, sf)
    return c.groupBy("order_id").agg(
        F.max("order_shipping_cost").alias("order_shipping_cost"),
        F.count(F.lit(1)).alias("lines"),
        marts.round_money(F.sum("allocated_shipping_cost")).alias("allocated_shipping_total"))


def q_channel_fee(spark, sf):
    c = _costed(spark, sf)
    return c.groupBy("channel", "fee_method").agg(
        F.count(F.lit(1)).alias("lines"),
        marts.round_money(F.sum("channel_fee")).alias("channel_fee_total"),
        marts.round_money(F.sum("allocated_flat_fee")).alias("flat_fee_total"),
        marts.round_money(F.sum("list_discount")).alias("list_discount_total"))


# --- marts --------------------------------------------------------------------

def q_fct_order_item_profit(spark, sf):
    return present(marts.fct_order_item_profit(_costed(spark, sf)),
                   {"gross_profit": "decimal(24,8)", "net_revenue": "decimal(19,4)",
                    "channel_fee": "decimal(26,12)"})


def q_fct_sku_profit(spark, sf):
    return marts.fct_sku_profit(_costed(spark, sf), _catalog(spark, sf))


def q_fct_sku_profit_excluded(spark, sf):
    return marts.fct_sku_profit(_costed(spark, sf, EXCLUDED_CODES), _catalog(spark, sf))


def q_fct_sku_profit_monthly(spark, sf):
    return marts.fct_sku_profit_monthly(_costed(spark, sf))


def q_fct_sku_channel(spark, sf):
    return marts.fct_sku_channel(_costed(spark, sf))


def q_fct_sku_cost_watch(spark, sf):
    return marts.fct_sku_cost_watch(_costed(spark, sf), _catalog(spark, sf), testdata.AS_OF,
                                    WINDOW_DAYS)


def q_catalog_rollup(spark, sf):
    return marts.catalog_rollup(_catalog(spark, sf))


def q_sku_weighted_fee(spark, sf):
    return marts.sku_weighted_fee(marts.fct_sku_channel(_costed(spark, sf)))


def q_orders_total(spark, sf):
    return marts.orders_total(inputs.raw_orders(spark, sf))


# --- returns ------------------------------------------------------------------

def q_returns_exploded(spark, sf):
    e = returns.exploded(inputs.raw_returns(spark, sf))
    return e.select("submission_id", "sku_entered", "key_exact", "key_fuzzy", "skus_in_submission",
                    F.col("processing_cost_alloc").alias("processing_cost"))


def q_returns_disposition(spark, sf):
    r = inputs.raw_returns(spark, sf)
    cat = returns.disposition_category(F.col("disposition"))
    return r.select("submission_id", "disposition", cat.alias("disposition_category"))


def q_sku_universe(spark, sf):
    return returns.sku_universe(_catalog(spark, sf))


def q_sku_ref_exact(spark, sf):
    return returns.ref_exact(returns.sku_universe(_catalog(spark, sf), distinct=False))


def q_sku_ref_normalized(spark, sf):
    return returns.ref_fuzzy(returns.sku_universe(_catalog(spark, sf), distinct=False))


def q_sku_aliases_ref(spark, sf):
    return returns.aliases_ref(testdata.test_aliases(spark, sf))


def q_stg_returns(spark, sf):
    return present(_stg_returns(spark, sf))


# --- checks -------------------------------------------------------------------

def q_dq_checks(spark, sf):
    ro = inputs.raw_orders(spark, sf)
    rc = inputs.raw_catalog(spark, sf)
    rr = inputs.raw_returns(spark, sf)
    so = staging.stg_orders(ro)
    si = staging.stg_order_items(ro)
    sr = _stg_returns(spark, sf)
    cat = _catalog(spark, sf)
    costed = _costed(spark, sf)
    sp = marts.fct_sku_profit(costed, cat)
    cw = marts.fct_sku_cost_watch(costed, cat, testdata.AS_OF, WINDOW_DAYS)
    tests = [
        ("not_null", "stg_orders", so, "order_id"),
        ("unique", "stg_orders", so, "order_id"),
        ("not_null", "stg_order_items", si, "order_item_id"),
        ("unique", "stg_order_items", si, "order_item_id"),
        ("not_null", "stg_returns", sr, "return_line_id"),
        ("unique", "stg_returns", sr, "return_line_id"),
        ("not_null", "stg_returns", sr, "sku"),
        ("not_null", "fct_sku_profit", sp, "sku"),
        ("unique", "fct_sku_profit", sp, "sku"),
        ("not_null", "fct_sku_cost_watch", cw, "sku"),
        ("unique", "fct_sku_cost_watch", cw, "sku"),
        ("not_null", "raw_orders", ro, "order_id"),
        ("unique", "raw_orders", ro, "order_id"),
        ("not_null", "raw_orders", ro, "raw"),
        ("not_null", "raw_catalog", rc, "product_id"),
        ("unique", "raw_catalog", rc, "product_id"),
        ("not_null", "raw_returns", rr, "submission_id"),
        ("unique", "raw_returns", rr, "submission_id"),
    ]
    return checks.run_checks(tests)


def q_dq_not_null(spark, sf):
    return q_dq_checks(spark, sf).where(F.col("check") == "not_null") \
        .where(~F.col("model").startswith("raw_"))


def q_dq_unique(spark, sf):
    return q_dq_checks(spark, sf).where(F.col("check") == "unique") \
        .where(~F.col("model").startswith("raw_"))


def q_dq_landed(spark, sf):
    return q_dq_checks(spark, sf).where(F.col("model").startswith("raw_"))


def q_dq_malformed(spark, sf):
    return staging.malformed_line_numbers(inputs.raw_orders(spark, sf))


def q_dq_rejected(spark, sf):
    """Documents that do not parse, and malformed numbers outside the order lines."""
    now = testdata.FIXTURE_NOW
    parts = [checks.rejected(landing.rejected(docs(spark, sf), now), model) for docs, model in (
        (testdata.order_payloads, "raw_orders"), (testdata.catalog_payloads, "raw_catalog"),
        (testdata.return_payloads, "raw_returns"))]
    parts.append(staging.malformed_document_numbers(inputs.raw_orders(spark, sf), "stg_orders",
                                                    ["GrandTotal", "ShippingTotal", "FinalShippingFee"]))
    parts.append(staging.malformed_document_numbers(inputs.raw_catalog(spark, sf), "stg_catalog",
                                                    ["SitePrice", "LastCost", "WeightLbs"]))
    return reduce(DataFrame.unionByName, parts)


def q_int_order_items_costed_dropped(spark, sf):
    c = costing.costed_lines(inputs.raw_orders(spark, sf), inputs.channel_map(spark),
                             inputs.fee_rules(spark), EXCLUDED_CODES, drop_excluded_lines=True)
    return present(c.select(*costing.INT_COSTED_COLUMNS), COSTED_TYPES)


def q_upsert_stream_latest(spark, sf):
    from ..streaming.upsert_stream import events_latest_stream
    return present(events_latest_stream(spark, sf))


_EDITED = (r'"StatusCode":[0-9]+', f'"StatusCode":{UPSERT_NEW_STATUS}')


def _arrivals(at: Column) -> tuple[Column, Column]:
    """Whether an order's document is among the landed ones, and in the re-pulled window."""
    return at < F.lit(UPSERT_SNAPSHOT_BEFORE).cast("timestamp"), at >= F.lit(UPSERT_BATCH_FROM).cast("timestamp")


def _dated_orders(spark, sf) -> DataFrame:
    return testdata.order_payloads(spark, sf).withColumn("at", F.get_json_object("value", "$.CreatedOn").cast("timestamp"))


def _arriving_orders(spark, sf, run):
    """The order documents of three arrivals: landed ones, the re-pulled window as first paged
    and, after an edit, again.  The documents are made once, and kept in the folder ``run``."""
    from ..session import drop_shuffles
    made = f"{run}/documents"
    _dated_orders(spark, sf).write.option("compression", "zstd").parquet(made)
    drop_shuffles(spark)
    docs = spark.read.parquet(made)
    landed, again = _arrivals(F.col("at"))
    window = docs.where(again)
    edited = window.withColumn("value", F.regexp_replace("value", *_EDITED))
    return docs.where(landed).drop("at"), window.drop("at"), edited.drop("at")


def _arriving_files(spark, sf, run):
    """The documents of `_arriving_orders` as JSON-lines files, which arrive in the folder
    ``incoming`` of ``run``: each step is yielded when its files are there.

    The documents are made once, as the files of the first step: those that belong to
    it are moved to their place, and only the window is written again.
    """
    from ..session import drop_shuffles
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(run).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def write(docs: DataFrame, folder: str) -> None:
        # Files of a bounded number of documents: a compressed one is read by one task.
        (docs.write.option("compression", "gzip").option("maxRecordsPerFile", 100_000)
         .partitionBy(*(c for c in docs.columns if c != "value")).text(folder))

    docs = _dated_orders(spark, sf)
    landed, again = _arrivals(F.col("at"))
    of = F.when(landed & again, "both").when(landed, "first").when(again, "window")
    write(docs.select("value", of.alias("of")).where(F.col("of").isNotNull()), f"{run}/made")
    drop_shuffles(spark)
    window = []
    for kind, folder in (("first", f"{run}/incoming/step=0/first"), ("both", f"{run}/incoming/step=0/both"),
                         ("window", f"{run}/window")):
        made, to = (jvm.org.apache.hadoop.fs.Path(x) for x in (f"{run}/made/of={kind}", folder))
        if fs.exists(made):
            fs.mkdirs(to.getParent())
            if not fs.rename(made, to):
                raise OSError(f"{made} can't be moved to {to}")
            window += [folder] * (kind != "first")
    none = spark.createDataFrame([], "value string")
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{run}/incoming/step=0")):
        write(none, f"{run}/incoming/step=0")
    yield 0
    again = spark.read.text(window) if window else none
    write(again, f"{run}/incoming/step=1")
    yield 1
    write(again.withColumn("value", F.regexp_replace("value", *_EDITED)), f"{run}/incoming/step=2")
    yield 2


def q_upsert_stream_orders(spark, sf):
    """The same re-pull as ``upsert_orders``, as JSON-lines files that arrive in three steps:
    each step is a micro-batch, published as one version of a store."""
    import uuid

    from ..session import job_dir
    from ..sources.store import Store
    from ..streaming.documents import run_document_stream
    from . import land
    run = job_dir(spark, "marginlib", "documents", uuid.uuid4().hex)
    store = Store(spark, f"{run}/store")
    times = {0: testdata.FIXTURE_NOW, 1: "2001-08-03 05:00:00", 2: "2001-08-03 06:00:00"}
    for _ in _arriving_files(spark, sf, run):
        run_document_stream(store, "orders", f"{run}/incoming", f"{run}/checkpoint", times.__getitem__,
                            max_files_per_trigger=1_000_000)
    r = land.raw(store, "orders")
    return present(r.select("order_id", "status_code", "grand_total", "created_on", "extracted_at"))


def q_upsert_counts(spark, sf):
    """Counts of landing runs: orders, then the window pulled again with each document twice; the
    catalog with products that lost their id; return forms with text that is no document."""
    import uuid

    from ..session import job_dir
    from ..sources.store import Store
    from . import land
    run = job_dir(spark, "marginlib", "counts", uuid.uuid4().hex)
    store = Store(spark, f"{run}/store")
    first, window, edited = _arriving_orders(spark, sf, run)
    land.land_batch(store, "orders", first, testdata.FIXTURE_NOW)
    twice = window.withColumn("seq", F.col("seq") * 2).unionByName(edited.withColumn("seq", F.col("seq") * 2 + 1))
    land.land_batch(store, "orders", twice, "2001-08-03 06:00:00")
    seq = F.col("seq")
    products = testdata.catalog_payloads(spark, sf).withColumn("value", F.when(
        seq % 5 == 0, F.regexp_replace("value", '"(ProductID|Sku)":"[^"]*"', '"ProductID":""')).otherwise(F.col("value")))
    land.land_batch(store, "catalog", products, testdata.FIXTURE_NOW)
    forms = testdata.return_payloads(spark, sf).withColumn("value", F.when(
        seq % 7 == 0, F.concat(F.lit("<"), "value")).when(
        seq % 7 == 1, F.regexp_replace("value", r'"123":\{"answer":"[^"]*"', '"123":{"answer":"99,000,000,000.50"')).otherwise(F.col("value")))
    land.land_batch(store, "returns", forms, testdata.FIXTURE_NOW, after=RETURNS_SINCE)
    return present(store.read("landing_counts"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
