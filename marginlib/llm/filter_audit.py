"""Filter interaction audit over a sparse document-term matrix.

1. Words are encoded globally (`lexicon`), and every shard of documents becomes
   a matrix in compressed sparse rows: for each document the numbers of its different
   words and how often each occurs.
2. Row sums are documents' words, nonzero counts their different words: they
   decide the filters A and B.
3. C and D come from the bytes of the text, E from digests of whole texts and the
   smallest doc_id of each; labels are joined.
4. Documents are counted by (source, filters failed).  What each filter removes in any
   order of filters follows from these counts, 32 for each source.

Filters fail a document: A: fewer than ``LEAST_WORDS`` words; B: different words
below ``LEAST_DISTINCT`` percent of them; C: capitals A-Z above ``MOST_CAPITALS``
percent of code points; D: a character of ``SYMBOLS``; E: the same text as a row of a
smaller doc_id.

Defined results: a null text counts as empty (it fails A, and E if another empty one
has a smaller doc_id); a null source counts as the empty one; a null doc_id comes after all
others, and rows without one don't fail each other; rows that repeat a doc_id don't fail
each other; a document is good or toxic if any of its label rows says 1; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from marginlib.llm import lexicon
from marginlib.llm.common import stored

LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 2, b"#$%&*|"
FILTERS = "ABCDE"

_ROW = "struct<doc_id:bigint,source:string,capitals:boolean,symbols:boolean,digest:binary>"
_SHARDS = f"shard long, bucket int, body binary, rows array<{_ROW}>"
_MATRIX = f"shard long, rows array<{_ROW}>, indptr binary, columns binary, counts binary"
_GAP = np.zeros(256, np.bool_)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, np.bool_)
_SYMBOL[list(SYMBOLS)] = True


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _at(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of ``mask`` lie between neighbouring bounds."""
    return np.diff(np.concatenate((np.zeros(1, np.int64), np.cumsum(mask)))[bounds])


def _shard(batch: pa.RecordBatch, shard: int, buckets: int) -> Iterator[tuple]:
    """Rows of the shard table for the documents of ``batch``."""
    data, bounds = lexicon.joined(batch.column(2), b"\n")
    words, starts = lexicon.split(data, _GAP[data])
    first = np.searchsorted(starts, bounds)
    codes, different, bucket = lexicon.encoded(words, buckets)
    # A number for each (document, word); equal ones in a row are one entry.
    width = max(1, len(different))
    entry = np.sort(np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(first)) * width + codes)
    new = np.flatnonzero(np.diff(entry, prepend=-1))
    counts = np.diff(new, append=len(entry))
    rows, columns = np.divmod(entry[new], width)
    indptr = np.searchsorted(rows, np.arange(batch.num_rows + 1))
    points = _at((data & 0xC0) != 0x80, bounds) - 1     # less the byte between texts
    capitals = 100 * _at((data >= 65) & (data <= 90), bounds) > MOST_CAPITALS * points
    symbols = _at(_SYMBOL[data], bounds) > 0
    raw, at = data.tobytes(), bounds.tolist()
    own = [{"doc_id": i, "source": s or "", "capitals": c, "symbols": d, "digest": hashlib.sha256(raw[a:b - 1]).digest()}
           for i, s, c, d, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), capitals.tolist(),
                                       symbols.tolist(), at, at[1:])]
    yield shard, -1, lexicon.pack(indptr, lexicon.narrow(columns), lexicon.narrow(counts)), own
    for b, body in lexicon.word_packs(different, bucket):
        yield shard, b, body, None


def shards(docs: DataFrame, buckets: int) -> DataFrame:
    """Shards of ``docs`` with their words still to be encoded."""
    schema = _arrow(_SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in (p for batch in batches for p in lexicon.cuts(batch)):
            for row in _shard(part, number, buckets):
                yield pa.record_batch([pa.array([x], f.type) for x, f in zip(row, schema, strict=True)], schema=schema)
            number += 1

    return docs.select("doc_id", "source", "text").mapInArrow(run, _SHARDS)


def _numbered(packs: DataFrame) -> DataFrame:
    """(shard, bucket, body): the numbers of each pack's words, in the pack's order.

    A word's number is its place in its bucket's dictionary times the number of
    buckets, plus the bucket: different words have different numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), group in lexicon.by_key(batches, "bucket"):
            seen: dict[bytes, int] = {}
            for shard, _, body in group:
                data, lengths = lexicon.unpack(body)
                words = lexicon.binaries(data, lengths.astype(np.int64)).to_pylist()
                places = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
                yield pa.record_batch([pa.array([shard], pa.int64()), pa.array([bucket], pa.int32()),
                                       pa.array([lexicon.pack(lexicon.narrow(places))])], ["shard", "bucket", "body"])

    # In the order of shards, so that a task that is run again gives the same numbers.
    return (packs.repartition("bucket").sortWithinPartitions("bucket", "shard")
            .mapInArrow(run, "shard long, bucket int, body binary"))


def matrix(docs: DataFrame) -> DataFrame:
    """The document-term matrix: a row for each shard with its documents and the
    arrays of compressed sparse rows (see `arrays`); columns are global word numbers."""
    buckets = lexicon.bucket_count(docs)
    held, schema = stored(shards(docs, buckets)), _arrow(_MATRIX)
    own = held.where("bucket < 0")
    numbers = _numbered(held.where("bucket >= 0").select("shard", "bucket", "body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard,), group in lexicon.by_key(batches, "shard"):
            _, _, body, rows = next(group)                  # bucket -1
            indptr, columns, counts = lexicon.unpack(body)
            ids = [lexicon.unpack(b)[0].astype(np.int64) * buckets + k for _, k, b, _ in group]
            ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
            csr = (lexicon.pack(indptr), lexicon.pack(ids[columns]), lexicon.pack(counts))
            yield pa.record_batch([pa.array([x], f.type) for x, f in zip((shard, rows, *csr), schema, strict=True)],
                                  schema=schema)

    return (own.unionByName(numbers, allowMissingColumns=True).repartition("shard")
            .sortWithinPartitions("shard", "bucket").mapInArrow(run, _MATRIX))


def arrays(indptr: bytes, columns: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The arrays of one shard's matrix: entries of row i are indptr[i]:indptr[i + 1]."""
    return tuple(lexicon.unpack(x)[0] for x in (indptr, columns, counts))


def row_sizes(shards_: DataFrame) -> DataFrame:
    """Row sums (n_words) and nonzero counts (n_distinct) of every document of a `matrix`."""
    rows = shards_.select("rows", "indptr", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                indptr, counts = (lexicon.unpack(batch.column(c)[k].as_py())[0] for c in (1, 2))
                total = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)))
                own = batch.column(0)[k].values
                yield pa.record_batch([*own.flatten(), pa.array(np.diff(total[indptr])), pa.array(np.diff(indptr))],
                                      [*(f.name for f in own.type), "n_words", "n_distinct"])

    return rows.mapInArrow(run, "doc_id long, source string, capitals boolean, symbols boolean, digest binary, "
                           "n_words long, n_distinct long")


def flags(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_words, n_distinct, a, b, c, d, e): which filters each row fails."""
    rows = stored(row_sizes(matrix(docs)).select(
        "doc_id", "source", "digest", "n_words", "n_distinct", (F.col("n_words") < LEAST_WORDS).alias("a"),
        (100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words")).alias("b"),
        F.col("capitals").alias("c"), F.col("symbols").alias("d")))
    first = stored(rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first_id")))
    # By digest and doc_id, which no large group of equal texts shares.
    by_id = (rows.where("doc_id is not null")
             .join(first, (rows.digest == first.digest) & (rows.doc_id == first.first_id), "left")
             .select(*rows, first.first_id.isNull().alias("e")))
    no_id = (rows.where("doc_id is null").join(first, rows.digest == first.digest, "left")
             .select(*rows, first.first_id.isNotNull().alias("e")))
    return by_id.union(no_id).drop("digest")


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by source and filters failed (a bit each)."""
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    mask = sum((F.col(f.lower()).cast("int") * (1 << k) for k, f in enumerate(FILTERS)), F.lit(0))
    return (flags(docs).join(said, "doc_id", "left").groupBy(F.col("source").alias("part"), mask.alias("mask"))
            .agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, for every source."""
    orders = ["".join(o) for o in itertools.permutations(FILTERS)]
    size = len(FILTERS)
    m, n = F.col("mask"), F.col("n")
    sets, bits = range(1 << size), [1 << k for k in range(size)]

    def total(value: Column, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, value)), F.lit(0))

    # Documents that pass all filters of a set, for each set; that fail one filter only; and
    # the orders that put a filter first among those that a document fails, which remove it.
    by_set = {f"left_{c}": [total(F.col(c), m.bitwiseAND(F.lit(s)) == 0) for s in sets] for c in ("n", "good", "toxic")}
    by_filter = {"only": [total(n, m == b) for b in bits],
                 "share": [total(n * F.expr(f"{len(orders)} div bit_count(mask)"), m.bitwiseAND(F.lit(b)) != 0) for b in bits]}
    wide = {f"{name}{k}": c for name, cs in {**by_set, **by_filter}.items() for k, c in enumerate(cs)}
    parts = (failures(docs, labels).groupBy("part").agg(*(c.alias(name) for name, c in wide.items()))
             .select("part", *(F.array(*(f"{name}{k}" for k in range(len(cs)))).alias(name)
                               for name, cs in {**by_set, **by_filter}.items())))
    at = parts.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(len(orders) * size - 1)))).select(
        *parts.columns, (F.col("at") % size + 1).alias("step"),
        F.substring(F.lit("".join(orders)), F.col("at") - F.col("at") % size + 1, F.lit(size)).alias("filter_order"))

    def place(step: Column) -> Column:
        return F.instr(F.lit(FILTERS), F.substring("filter_order", step, F.lit(1))) - 1

    bit = F.array(*map(F.lit, bits))
    rows = at.withColumns({
        "own": place(F.col("step")),
        "before": sum((F.when(F.col("step") > j, F.get(bit, place(F.lit(j)))).otherwise(0) for j in range(1, size)), F.lit(0))})
    rows = rows.withColumns({"bit": F.get(bit, "own"), "after": F.col("before") + F.get(bit, "own")})

    def lost(c: str) -> Column:
        return F.get(f"left_{c}", "before") - F.get(f"left_{c}", "after")

    return rows.select("part", "filter_order", "step", F.get("left_n", "after").alias("kept"), lost("n").alias("removed"),
                       (F.get("left_n", F.lit(0)) - F.get("left_n", "bit") - lost("n")).alias("redundant"),
                       F.get("only", "own").alias("unique_fails"), lost("good").alias("good_lost"),
                       lost("toxic").alias("toxic_lost"), F.get("share", "own").alias("shapley"))
