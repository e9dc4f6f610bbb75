"""Continuous latest-wins landing with Structured Streaming.

New landed files arrive in a folder; each key keeps its row with the
largest sequence.  The per-key latest row is kept by a streaming
aggregation (``max_by`` per key in the state store, checkpointed, so an
executor loss or a restart resumes exactly), and every micro-batch's
changed keys are merged into a Parquet snapshot written as a new version
named by the batch id (a retried batch rewrites the same version).
No event-time watermark: an edit of any age must still win.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import upsert
from ..session import job_dir
from ..sources import testdata


def latest_stream(stream: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Streaming frame of (keys, latest row) updated per micro-batch."""
    keys, seq = list(keys), list(seq)
    rest = [c for c in stream.columns if c not in keys]
    return (stream.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.struct(*seq)).alias("_r"))
            .select(*keys, "_r.*"))


def run_upsert_stream(spark: SparkSession, source_dir: str, schema, keys: Sequence[str],
                      seq: Sequence[str], table_dir: str, checkpoint: str,
                      max_files_per_trigger: int = 1,
                      partition_cols: Sequence[str] | None = None,
                      state_partitions: int | None = None) -> str:
    """Drain ``source_dir`` into the table at ``table_dir``; returns it.

    Without ``partition_cols`` each micro-batch writes a new snapshot
    version (small tables).  With them the table is partitioned and each
    micro-batch rewrites only the partitions its changed keys touch
    (``upsert.upsert_partitioned``); the rows emitted by the state store are
    already the latest per key, so the batch id serves as their sequence.

    ``state_partitions`` sets the number of state-store partitions (fixed
    by the checkpoint at the first start; Spark takes it from
    ``spark.sql.shuffle.partitions``, which is restored afterwards).
    """
    src = (spark.readStream.schema(schema)
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .parquet(source_dir))
    latest = latest_stream(src, keys, seq)
    cols = latest.columns

    def merge_partitioned(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select(*cols).withColumn("_batch", F.lit(batch_id))
        upsert.upsert_partitioned(spark, table_dir, changed, list(keys), list(partition_cols),
                                  seq="_batch")

    def merge(batch: DataFrame, batch_id: int) -> None:
        # A replayed batch starts from the version before it, as the first time.
        snap = upsert.read_snapshot(spark, table_dir, batch.schema, before=batch_id + 1)
        changed = batch.select(*cols)
        new = snap.join(changed.select(*keys), list(keys), "left_anti").unionByName(changed)
        upsert.write_snapshot(spark, new, table_dir, version=batch_id + 1)

    prev = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        q = (latest.writeStream.outputMode("update")
             .option("checkpointLocation", checkpoint)
             .foreachBatch(merge_partitioned if partition_cols else merge)
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    return table_dir


def events_latest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user, landed week by week through the stream."""
    run = job_dir(spark, "marginlib", "stream", uuid.uuid4().hex)
    ev = testdata.table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type",
                                                        "value")
    # Land the events as one file per week (the arriving files).
    wk = F.date_trunc("week", "ts")
    (ev.withColumn("week", F.date_format(wk, "yyyy-MM-dd"))
       .repartition("week").write.partitionBy("week").parquet(f"{run}/incoming"))
    schema = ev.schema.add("week", "string")
    # One state partition per core: the state is one row per user.
    table = run_upsert_stream(spark, f"{run}/incoming", schema, ["user_id"], ["ts", "event_id"],
                              f"{run}/table", f"{run}/checkpoint",
                              state_partitions=spark.sparkContext.defaultParallelism)
    snap = upsert.read_snapshot(spark, table, None)
    return snap.select("user_id", "event_id", "ts", "event_type", "value")
