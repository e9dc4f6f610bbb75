"""What the operators share: reading tables, per-batch maps, shared tables."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlib.session import shared_dir

BATCH_BYTES = 4 << 20       # bytes of an Arrow batch that a task holds
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of long texts have BATCH_BYTES at most, in this session."""
    if int(spark.conf.get(_BATCH).removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    The written table cuts the lineage: a lost executor costs a re-read, not
    a recomputation, and later steps may use it several times.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `stored` that nothing reads any more, and let Spark drop the
    shuffle files that no frame in use needs."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    gc.collect()
    for df in tables[:1]:
        df.sparkSession.sparkContext._jvm.System.gc()


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A text column of a batch; null becomes the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for `mapInArrow`, giving free memory back to the system when its task ends.

    Python workers are used again; what one step has held and freed would count
    against the next ones.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
            if trim:
                trim(0)
    return task


def map_batches(df: DataFrame, make: Callable[[], Callable], schema: str) -> DataFrame:
    """Apply a batch function in every task.

    ``make()`` runs once per task (set-up such as reading a vocabulary) and
    returns a function from a record batch to column lists in the order of
    ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    small_batches(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for part in slices(batch):
                columns = each(part)
                yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(lean(run), schema)


def slices(batch: pa.RecordBatch, bytes_most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that Python objects of few megabytes are alive at once."""
    n = batch.num_rows
    step = max(1, min(n, int(n * bytes_most / max(1, batch.nbytes)))) if n else 1
    for i in range(0, n, step):
        yield batch.slice(i, step)


def _spots(values: np.ndarray, bits: int) -> np.ndarray:
    """A number below 2**bits for each long; `id_bits` has the same in SQL."""
    return ((values ^ (values >> 17) ^ (values >> 34)) & ((1 << bits) - 1)).astype(np.int64)


def id_bits(ids: DataFrame, bits: int) -> np.ndarray:
    """A bit set of 2**bits bits (a fixed size) with a bit for each long in the
    first column; made by aggregation, so that no ids reach the driver."""
    v = F.col(ids.columns[0])
    spot = (v.bitwiseXOR(F.shiftright(v, 17)).bitwiseXOR(F.shiftright(v, 34))).bitwiseAND(F.lit((1 << bits) - 1)) + 1
    rows = (ids.where(v.isNotNull()).select(spot.alias("spot"))
            .groupBy(F.bitmap_bucket_number("spot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits")).collect())
    out = np.zeros(max(1 << (bits - 3), 4096), np.uint8)
    for r in rows:          # numbers and buckets count from 1; a bucket has 4 KB
        out[(r.bucket - 1) * 4096:r.bucket * 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


def in_bits(held: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bit of each value is set; false only for values not in the set."""
    at = _spots(values, bits)
    return ((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.bool_)
