"""Session helpers: the configuration every job in this package assumes."""

from __future__ import annotations

import contextlib
import gc
import os
import tempfile
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings that change results, not only speed: money and dates are computed
# in UTC, and ANSI mode makes bad casts fail loudly (we use try_cast where a
# bad value must become NULL instead).
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # A key that a JSON document repeats keeps its last value, as jsonb does.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for throughput.  AQE re-plans joins from runtime sizes (that is the
# size check behind every non-seed broadcast), coalesces small shuffle
# partitions and splits skewed ones.
PERF_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


# Settings for a large cluster (hundreds of executors, ~100 TB of landed
# documents).  Shuffle partition count is set high and AQE coalesces it to
# the advisory size at run time; file splits and shuffle partitions are
# sized to ~256 MB so a task's data fits comfortably in executor memory;
# streaming state (one row per key) lives in RocksDB instead of the JVM
# heap.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting settings to an existing session."""
    for k, v in RESULT_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, app: str = "marginlib",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Create (or reuse) a session with this package's settings
    (``cluster=True`` adds ``CLUSTER_CONF``)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {**RESULT_CONF, **PERF_CONF, **(CLUSTER_CONF if cluster else {}),
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_SCRATCH: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and job-written tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system).  Where it is unset, a local master (one machine, as in
    tests) gets a scratch folder per application; any other master is an
    error, since a machine-local folder is not seen by the other executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = sc.master
        if not (master.startswith("local[") or master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             f"executors share (master is {master})")
        d = _LOCAL_SCRATCH.get(sc.applicationId)
        if d is None:
            d = _LOCAL_SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="marginlib-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def job_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder (not created here)."""
    return "/".join([shared_dir(spark), *[p.strip("/") for p in parts]])


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path."""
    if is_local_path(path):
        return os.path.exists(path.replace("file:", "", 1))
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def drop_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of ended queries removed now.

    Spark removes them when the driver's garbage is collected, and a driver that leaves the
    work to executors may collect none for a long time: the files of all steps of a job pile up.
    """
    gc.collect()                # frames that Python holds
    with contextlib.suppress(Py4JJavaError):        # events of ended queries hold their plans
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    for pause in (0.2, 0):      # what threads let go of only then is left to the second one
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


def write_atomic(spark: SparkSession, df, path: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as Parquet at ``path`` via a temporary folder + rename.

    Readers never see a half-written table; a failed task is retried by
    Spark, a failed job leaves only the temporary folder behind.  An
    existing table at ``path`` is replaced after the new one is complete.
    """
    import uuid

    jvm = spark.sparkContext._jvm
    final = jvm.org.apache.hadoop.fs.Path(path)
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    tmp_str = f"{path.rstrip('/')}.__tmp-{uuid.uuid4().hex}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(tmp_str)
    tmp = jvm.org.apache.hadoop.fs.Path(tmp_str)
    if fs.exists(final):
        old = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.__old-{uuid.uuid4().hex}")
        fs.rename(final, old)
        fs.rename(tmp, final)
        fs.delete(old, True)
    else:
        fs.rename(tmp, final)
    return path
