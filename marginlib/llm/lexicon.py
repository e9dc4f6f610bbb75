"""Global word numbers for texts: shards, packs of their words, and numbers back.

A *shard* is a slice of a task's documents, cut to ``SHARD_BYTES``.  Within it words are
encoded by Arrow; each different word then travels once for the shard, in a pack for
one of the ``buckets`` that words are dealt to by hash.  A bucket's task numbers its
words and sends the numbers back to the shards.  What is shuffled is thus the words
of shards, not the words of texts, and a word that is in every text is one entry
of each shard's pack.

Tables: every row has (shard, bucket, body); body is compressed.  Bucket -1 is the
shard's own row, whose body the operators define.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 8 << 20       # bytes of texts, about, in a shard
BUCKET_BYTES = 32 << 20     # bytes of texts, about, for each bucket of words
LEAST_BUCKETS = 16

_B = np.uint64(0x9E3779B97F4A7C15)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed body: sizes, types, then the values."""
    head = np.array([len(arrays)] + [x for a in arrays for x in (len(a), ord(a.dtype.char))], np.int64)
    raw = b"".join([head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(body: bytes) -> list[np.ndarray]:
    raw = pa.decompress(body[8:], decompressed_size=int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head, at, out = np.frombuffer(raw, np.int64, 1 + 2 * n), 8 * (1 + 2 * n), []
    for size, char in zip(head[1::2].tolist(), head[2::2].tolist(), strict=True):
        kind = np.dtype(chr(char))
        out.append(np.frombuffer(raw, kind, size, at))
        at += size * kind.itemsize
    return out


def narrow(x: np.ndarray) -> np.ndarray:
    """Non-negative integers in the smallest unsigned type that holds them."""
    most = int(x.max()) if len(x) else 0
    return x.astype(np.min_scalar_type(most))


def joined(column: pa.Array, between: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The texts of a column (null: empty) as bytes with ``between`` after each, and
    where each text starts, with the end."""
    texts = pc.fill_null(column, "").cast(pa.large_binary())
    rows = pc.binary_join_element_wise(texts, pa.scalar(between, pa.large_binary()),
                                       pa.scalar(b"", pa.large_binary()))
    # joined by the empty text: text + between
    offsets = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset:rows.offset + len(rows) + 1]
    held = rows.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None and len(rows) else np.zeros(0, np.uint8)
    return data, offsets - (offsets[0] if len(offsets) else 0)


def split(data: np.ndarray, gap: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The maximal runs of bytes outside ``gap``, as binaries, and their starts."""
    edges = np.concatenate((np.ones(1, np.bool_), gap, np.ones(1, np.bool_)))
    edge = np.flatnonzero(edges[1:] != edges[:-1])
    starts, ends = edge[0::2], edge[1::2]
    return binaries(data[~gap], ends - starts), starts


def binaries(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def parts(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and lengths of an array of large binaries."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    held = words.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(words) else data[:0], np.diff(offsets)


def encoded(words: pa.Array, buckets: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, different words, bucket of each): words are ordered by
    bucket, and codes count in this order."""
    coded = words.dictionary_encode()
    codes, different = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    data, lengths = parts(different)
    bucket = (word_hashes(data, lengths) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[codes], different.take(pa.array(order)), bucket[order]


def word_hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    if not len(lengths):
        return np.zeros(0, np.uint64)
    starts = np.cumsum(lengths) - lengths
    power = np.full(int(lengths.max()), _B)
    power[0] = 1
    power = np.cumprod(power)
    at = np.arange(len(data)) - np.repeat(starts, lengths)
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * power[at], starts)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_packs(different: pa.Array, bucket: np.ndarray, *more: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, body) for each bucket that has words; ``more`` are numbers of the words."""
    ends = np.flatnonzero(np.diff(bucket, append=-1)) + 1 if len(bucket) else []
    first = 0
    for end in ends:
        data, lengths = parts(different[first:end])
        yield int(bucket[first]), pack(data, narrow(lengths), *(narrow(x[first:end]) for x in more))
        first = end


def bucket_count(docs: DataFrame) -> int:
    """Buckets for the words of ``docs``: in proportion to the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-int(size) // BUCKET_BYTES))


def cuts(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about SHARD_BYTES of texts each, or one text that has more."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // SHARD_BYTES
    for _, rows in itertools.groupby(range(batch.num_rows), key=part.__getitem__):
        first = next(rows)
        last = first
        for last in rows:
            pass
        yield batch.slice(first, last - first + 1)


def by_key(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of rows that follow each other with equal values of ``names``."""
    def rows():
        for batch in batches:
            for k in range(batch.num_rows):
                yield tuple(c[k].as_py() for c in batch.columns), batch.schema.names
    def key(item):
        row, columns = item
        return tuple(row[columns.index(n)] for n in names)
    for values, group in itertools.groupby(rows(), key=key):
        yield values, (row for row, _ in group)
