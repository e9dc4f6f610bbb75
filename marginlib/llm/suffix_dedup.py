"""Removal of long repeated byte strings, by merged Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts in a
document with a smaller doc_id.  Texts are UTF-8 bytes; strings lie within one
text.

1. Each window of ``length`` bytes is named after the smallest hash of the
   ``GRAM``-byte strings in it.  Neighbouring windows of one name form a segment;
   equal windows have equal names in all documents.
2. Names that occur in two documents set a bit in a filter of fixed size.  Segments
   of other names have no repeated window.  (A full filter lets more segments
   through, which costs time only.)
3. Segments are dealt out by cells of names, of which there are more the larger the
   input is.  Equal ones are one; different ones of a name go, in shards, through `bwt`: their transforms are merged, and the intervals
   with common prefixes of ``length`` bytes give each window its smallest document.
   Segments of a name that occurs over MANY times are dealt out by their own hashes
   instead: their windows' smallest and largest documents are aggregated by Spark.
4. Each document takes back what holds for its segments and drops the bytes.

The segments that a task holds at a time are reduced to different ones before they
are shuffled, so a passage that very many documents share travels once for each HELD_BYTES
of a task; where the places of a frequent segment meet its result, the join is split.

Defined results: a null text counts as empty; texts shorter than ``length`` and
rows without doc_id lose nothing and take nothing from others; repeated rows
with one doc_id don't reduce each other; removal of part of a character leaves
bytes that aren't UTF-8; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlib.llm.bwt import least_by_window
from marginlib.llm.common import id_bits, in_bits, lean, slices, small_batches, stored

LENGTH = 50
GRAM = 24
NAME_BITS = 27              # bits (as a power of two) of the filter over names: 16 MB
KEY_BITS = 40               # bits of a name that its key keeps, whole bytes
HELD_KEYS = 1 << 21         # keys that a task holds before it hands them on
HELD_BYTES = 32 << 20       # bytes, about, of texts and segments that a task holds
CELL_KEYS = 1 << 17         # listed keys, about, whose segments are resolved at a time
PIECE = 128 << 10           # bytes of texts that are cut into segments at a time
ID_BITS = 24
MERGED = 1 << 16            # bytes of segments that are merged at a time
MANY = 1 << 12              # segments of a name, equal ones counted, that one task may resolve
MANY_BITS = 23              # bits (as a power of two) of the filter over names with more: 1 MB
SHARD = 1 << 14             # segments of such names, about, that are held at a time

_COUNT = 64 - KEY_BITS      # below a listed key: a bit if two documents have it, and a count
_TWO = np.uint64(1 << (_COUNT - 1))

_B = np.uint64(0x9E3779B97F4A7C15)


def _grams(raw: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM-byte strings."""
    h, size, power = raw.astype(np.uint64) + np.uint64(1), 1, int(_B)
    kept = {1: (h, _B)}
    while size * 2 <= GRAM:
        h = h[:-size] * np.uint64(power) + h[size:]
        power = power * power % (1 << 64)
        size *= 2
        kept[size] = (h, np.uint64(power))
    done, total = None, 0
    for part in sorted(kept, reverse=True):         # GRAM as a sum of powers of two
        while total + part <= GRAM:
            own, scale = kept[part]
            done = own if done is None else done[:len(own) - total] * scale + own[total:]
            total += part
    done = (done ^ (done >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    done ^= done >> np.uint64(32)
    return done


def _names(grams: np.ndarray, length: int) -> np.ndarray:
    """For each window of ``length`` bytes the smallest hash of its GRAM-byte strings."""
    low, size, width = grams, 1, length - GRAM + 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64; made when needed."""

    def __init__(self, base: int):
        self.bases, self.known = (base, pow(base, -1, 1 << 64)), None

    def up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.known is None or len(self.known[0]) < n:
            self.known = tuple(np.cumprod(np.append(np.uint64(1), np.full(n, b, np.uint64))) for b in self.bases)
        return self.known


_POWERS = (_Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F))


class _Segments:
    """Segments of a batch of texts, as arrays: name, row, start and end in the row."""

    def __init__(self, batch: pa.RecordBatch, length: int):
        ids = batch.column(0).to_pylist()
        raw = [(t or "").encode() if i is not None else b""
               for i, t in zip(ids, batch.column(1).to_pylist(), strict=True)]
        sizes = np.array([len(r) for r in raw], np.int64)
        self.flat = b"".join(raw)
        self.ids = np.array([i if i is not None else 0 for i in ids], np.int64)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        if len(self.flat) < length:
            self.name = np.zeros(0, np.uint64)
            self.row = self.first = self.last = self.start = np.zeros(0, np.int64)
            return
        self.grams = _grams(np.frombuffer(self.flat, np.uint8))
        names = _names(self.grams, length)
        row = np.repeat(np.arange(len(ids)), sizes)[:len(names)]
        inside = np.arange(len(names)) + length <= begins[row + 1]
        new = np.empty(len(names), np.bool_)
        new[0] = True
        new[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(new)
        end = np.append(first[1:], len(names)) + length - 1
        whole = inside[first]
        # Bytes from first to last (exclusive) of the joined texts.
        self.first, self.last = first[whole], end[whole]
        self.name, self.row = names[self.first], row[self.first]
        self.start = self.first - begins[self.row]

    @classmethod
    def of(cls, flat: bytes, first: np.ndarray, last: np.ndarray) -> _Segments:
        """Segments given by their places in joined texts."""
        s = cls.__new__(cls)
        s.flat, s.first, s.last = flat, first, last
        s.grams = _grams(np.frombuffer(flat, np.uint8))
        # Even numbers in a list of begins and ends belong to segments.
        edges = np.stack([first, last - GRAM + 1], axis=1).ravel()
        s.name = np.minimum.reduceat(np.append(s.grams, s.grams[-1:]), edges)[::2]
        return s

    def digests(self, at: np.ndarray) -> list[np.ndarray]:
        """Two hashes of each of the segments ``at``, from running sums over the
        hashes of their GRAM-byte strings."""
        if not len(at):
            return [np.zeros(0, np.int64)] * 2
        first, last, out = self.first[at], self.last[at] - GRAM + 1, []
        for powers in _POWERS:
            up, down = powers.up_to(len(self.grams))
            sums = np.append(np.uint64(0), np.cumsum(self.grams * up[:len(self.grams)]))
            h = (sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64)
            out.append((h ^ (h >> np.uint64(32))).view(np.int64))
        return out


def _pieces(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, _Segments]]:
    """Small parts of the batches, which fit a processor's cache, and their segments."""
    for batch in batches:
        for piece in slices(batch, PIECE):
            yield piece, _Segments(piece, length)


def _keys(names: np.ndarray) -> np.ndarray:
    """Evenly spread numbers of KEY_BITS bits for names, which as minima are small."""
    return (names * _B) >> np.uint64(64 - KEY_BITS)


def _planes(*numbers: np.ndarray) -> bytes:
    """Lists of numbers of one length, by planes of bytes, which compress well."""
    return b"".join(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for x in numbers)


def _numbers(raw: bytes, n: int) -> list[np.ndarray]:
    planes = np.frombuffer(raw, np.uint8).reshape(-1, 8, n)
    return [np.ascontiguousarray(x.T).view("<i8").ravel() for x in planes]


def _compressed(raw: bytes) -> bytes:
    return pa.compress(raw, codec="zstd", asbytes=True)


def _decompressed(raw: bytes, size: int) -> bytes:
    return pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True)


def _summed(listed: np.ndarray) -> np.ndarray:
    """Listed keys, sorted, each once: counts are added up (as far as they fit), and
    keys that were listed several times have two documents."""
    listed = np.sort(listed)
    keys = listed >> np.uint64(_COUNT)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    count = np.minimum(np.add.reduceat(listed & (_TWO - np.uint64(1)), first), _TWO - np.uint64(1))
    two = np.bitwise_or.reduceat(listed, first) & _TWO
    two[np.diff(first, append=len(listed)) > 1] = _TWO
    return keys[first] << np.uint64(_COUNT) | two | count


def _packed_bits(keys: np.ndarray, bits: int, range_bits: int) -> bytes:
    """Bits of the keys of one range in a filter of 2**bits bits."""
    out = np.zeros(1 << (bits - range_bits), np.uint8)
    out[(keys >> np.uint64(KEY_BITS - bits)).astype(np.int64) & (len(out) - 1)] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _shared_names(docs: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Bits of the names that occur in two documents or more, bits of those that
    occur over MANY times, the number of all listed keys, and how often the names
    with over MANY occur.

    Tasks hand on sorted lists of keys, a list for each range of keys, with counts and
    a bit for keys of two documents.  Of doc_ids nothing travels: names that
    rows with one doc_id share also set a bit, which costs time only.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    range_bits = min(16, max(4, parts.bit_length()))

    def of_part(s: _Segments) -> np.ndarray:
        keys = _keys(s.name)
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], s.ids[s.row[order]]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        several = np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first)
        return keys[first] << np.uint64(_COUNT) | several * _TWO | np.diff(first, append=len(keys)).astype(np.uint64)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def lists() -> pa.RecordBatch:
            keys = _summed(np.concatenate(held))
            held.clear()
            of = (keys >> np.uint64(64 - range_bits)).astype(np.int64)
            cuts = [*np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist(), len(keys)]
            steps = np.diff(keys, prepend=np.uint64(0))
            steps[cuts[:-1]] = keys[cuts[:-1]]
            rows = [(int(of[a]), b - a, _compressed(_planes(steps[a:b]))) for a, b in zip(cuts, cuts[1:], strict=False)]
            types = [pa.int32(), pa.int32(), pa.binary()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                   ["part", "n", "keys"])

        for _, s in _pieces(batches, length):
            if len(s.name):
                held.append(of_part(s))
            if sum(map(len, held)) >= HELD_KEYS:
                yield lists()
        if held:
            yield lists()

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for part, group in itertools.groupby(rows, key=lambda r: r[0]):
            keys = np.concatenate([np.cumsum(_numbers(_decompressed(raw, 8 * n), n)[0])
                                   for _, n, raw in group]).view(np.uint64)
            count = len(keys) + np.count_nonzero(keys & _TWO)
            keys = _summed(keys)
            keys = keys[(keys & _TWO) > 0]
            often = keys & (_TWO - np.uint64(1))
            keys >>= np.uint64(_COUNT)
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([count], pa.int64()),
                                   pa.array([int(often[often > MANY].sum())], pa.int64()),
                                   pa.array([_packed_bits(keys, NAME_BITS, range_bits)]),
                                   pa.array([_packed_bits(keys[often > MANY], MANY_BITS, range_bits)])],
                                  ["part", "n", "n_many", "bits", "many"])

    found = (docs.select("doc_id", "text").mapInArrow(lean(listed), "part int, n int, keys binary")
             .repartition("part").sortWithinPartitions("part")
             .mapInArrow(lean(repeated), "part int, n long, n_many long, bits binary, many binary").collect())
    out, many = np.zeros(1 << (NAME_BITS - 3), np.uint8), np.zeros(1 << (MANY_BITS - 3), np.uint8)
    for r in found:         # a fixed size in all: 2**NAME_BITS and 2**MANY_BITS bits
        for bits, own in ((out, r.bits), (many, r.many)):
            size = len(bits) >> range_bits
            bits[r.part * size:(r.part + 1) * size] = np.frombuffer(own, np.uint8)
    return out, many, sum(r.n for r in found), sum(r.n_many for r in found)


def _is_shared(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Whether the bit of each name is set in a filter."""
    spots = (_keys(names) >> np.uint64(KEY_BITS - (len(bits) * 8).bit_length() + 1)).astype(np.int64)
    return ((bits[spots >> 3] >> (spots & 7).astype(np.uint8)) & 1).astype(np.bool_)


RANGES = "ranges array<struct<start:int,end:int,low:long>>"


def _resolve(batches: Iterator[pa.RecordBatch], length: int, shards_from: int) -> Iterator[pa.RecordBatch]:
    """For each different segment the ranges of windows that a smaller document
    holds; cells follow each other, one is held at a time.  Cells from ``shards_from`` on
    are shards of names with many segments: theirs come back without ranges."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for cell, group in itertools.groupby(rows, key=lambda r: r[0]):
        flat, *segments = _different([(n, _decompressed(raw, size)) for _, n, size, raw in group])
        if cell < shards_from:
            for out in _resolve_cell(flat, *segments, length):
                none = pa.nulls(out.num_rows, pa.int64())
                yield pa.record_batch([*out.columns, none, none, none, pa.nulls(out.num_rows, pa.binary())], _RESOLVED)
            continue
        _, h1, h2, first, last, low, high = segments
        for i in range(0, len(h1), 10_000):
            own = slice(i, i + 10_000)
            texts = pa.array([flat[a:b] for a, b in zip(first[own].tolist(), last[own].tolist(), strict=True)], pa.binary())
            yield pa.record_batch([pa.array(h1[own]), pa.array(h2[own]), pa.nulls(len(texts), _RANGES),
                                   pa.array(np.full(len(texts), cell)), pa.array(low[own]), pa.array(high[own]), texts],
                                  _RESOLVED)


_RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("low", pa.int64())]))
_RESOLVED = ["h1", "h2", "ranges", "shard", "low", "high", "segment"]


def _different(packs: list[tuple[int, bytes]]) -> tuple:
    """Joined texts, and of the different segments: name, two hashes, begin and end in
    the texts, smallest and largest document."""
    numbers = [_numbers(raw[:24 * n], n) for n, raw in packs]
    flat = b"".join(raw[24 * n:] for n, raw in packs)
    size, low, more = (np.concatenate(c) for c in zip(*numbers, strict=True))
    high, last = low + more, np.cumsum(size)
    s = _Segments.of(flat, last - size, last)
    h1, h2 = s.digests(np.arange(len(size)))
    order = np.lexsort((h2, h1, s.name))
    name, h1, h2, first, last = (x[order] for x in (s.name, h1, h2, s.first, s.last))
    new = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
    low, high = np.minimum.reduceat(low[order], new), np.maximum.reduceat(high[order], new)
    return flat, *(x[new] for x in (name, h1, h2, first, last)), low, high


def _runs(of: np.ndarray, at: np.ndarray, least: np.ndarray, high: np.ndarray, length: int) -> list[np.ndarray]:
    """Neighbouring windows of one smallest document as ranges (segment, start, end,
    document), where a larger document has the segment."""
    change = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (of[1:] != of[:-1])))
    ends = np.append(change[1:], len(least)) - 1
    some = least[change] < high[of[change]]
    return [x[some] for x in (of[change], at[change], at[ends] + length, least[change])]


def _by_segment(h1: np.ndarray, h2: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray,
                least: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(row, kind="stable")
    row, start, end, least = (x[order] for x in (row, start, end, least))
    new = np.flatnonzero(np.append(True, row[1:] != row[:-1])[:len(row)])
    ranges = pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)),
                                         pa.array(least)], ["start", "end", "low"])
    offsets = pa.array(np.append(new, len(row)).astype(np.int32))
    return pa.record_batch([pa.array(h1[row[new]]), pa.array(h2[row[new]]),
                            pa.ListArray.from_arrays(offsets, ranges)], ["h1", "h2", "ranges"])


def _resolve_cell(flat: bytes, name: np.ndarray, h1: np.ndarray, h2: np.ndarray, first: np.ndarray, last: np.ndarray,
                  low: np.ndarray, high: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    alone = np.append(True, name[1:] != name[:-1])
    alone &= np.append(name[1:] != name[:-1], True)

    # The only segment of its name: what a smaller document holds, it holds whole.
    at = np.flatnonzero(alone & (low < high))
    found = [[at, np.zeros(len(at), np.int64), last[at] - first[at], low[at]]]
    several = np.flatnonzero(~alone)
    sizes = np.cumsum((last - first)[several])
    # Names that end in one stretch of MERGED bytes are merged together.
    fresh = np.append(True, name[several][1:] != name[several][:-1])
    stretch = (sizes // MERGED)[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(several) else several
    for own in np.split(several, np.flatnonzero(stretch[1:] != stretch[:-1]) + 1) if len(several) else []:
        texts = [flat[a:b] for a, b in zip(first[own].tolist(), last[own].tolist(), strict=True)]
        least = least_by_window(texts, low[own], length)
        counts = np.array([len(x) for x in least])
        at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        found.append(_runs(np.repeat(own, counts), at, np.concatenate(least), high, length))
    out = _by_segment(h1, h2, *(np.concatenate(x) for x in zip(*found, strict=True)))
    yield from (out.slice(i, 10_000) for i in range(0, out.num_rows, 10_000))


def _windows(segments: list[bytes], length: int) -> list[np.ndarray]:
    """Of each window of the segments: its segment, its place in it and two hashes."""
    sizes = np.array([len(x) for x in segments], np.int64)
    last = np.cumsum(sizes)
    s = _Segments.of(b"".join(segments), last - sizes, last)
    counts = sizes - length + 1
    of = np.repeat(np.arange(len(sizes)), counts)
    at = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    s.first = s.first[of] + at
    s.last = s.first + length
    return [of, at, *s.digests(np.arange(len(of)))]


def _resolve_shards(segments: DataFrame, length: int) -> DataFrame:
    """`_resolve` for shards: no task has all segments of a name.  A window travels once
    for each batch of a shard, whose segments get their ranges back together."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, HELD_BYTES >> 5):
                if not part.num_rows:
                    continue
                shard, low, high = (part.column(i).to_numpy() for i in range(3))
                of, _, w1, w2 = _windows(part.column(3).to_pylist(), length)
                order = np.lexsort((w2, w1, shard[of]))
                of, w1, w2 = of[order], w1[order], w2[order]
                own = shard[of]
                new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])))
                columns = (own[new], w1[new], w2[new], np.minimum.reduceat(low[of], new), np.maximum.reduceat(high[of], new))
                yield pa.record_batch([pa.array(c) for c in columns], ["shard", "w1", "w2", "low", "high"])

    def back(held: pa.Table, least: pa.Table) -> pa.Table:
        h1, h2, high = (held[c].to_numpy() for c in ("h1", "h2", "high"))
        of, at, w1, w2 = _windows(held["segment"].to_pylist(), length)
        w1, w2 = np.append(w1, least["w1"].to_numpy()), np.append(w2, least["w2"].to_numpy())
        value = np.append(np.full(len(of), np.iinfo(np.int64).max), least["least"].to_numpy())
        order = np.lexsort((w2, w1))
        a, b = w1[order], w2[order]
        new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        value[order] = np.repeat(np.minimum.reduceat(value[order], new), np.diff(new, append=len(order)))
        return pa.Table.from_batches([_by_segment(h1, h2, *_runs(of, at, value[:len(of)], high, length))])

    held = stored(segments.select("shard", "low", "high", "segment")
                  .mapInArrow(lean(windows), "shard long, w1 long, w2 long, low long, high long"))
    least = (held.groupBy("w1", "w2").agg(F.min("low").alias("least"), F.max("high").alias("most"))
             .where("least < most").drop("most"))
    met = held.select("shard", "w1", "w2").join(least, ["w1", "w2"])
    return (segments.select("shard", "h1", "h2", "high", "segment").groupBy("shard").cogroup(met.groupBy("shard"))
            .applyInArrow(back, f"h1 long, h2 long, {RANGES}"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, digest, covered): byte ranges, not yet joined, that go from each text."""
    spark = docs.sparkSession
    shared, many, n_keys, n_many = _shared_names(docs, length)
    bits, many = spark.sparkContext.broadcast(shared), spark.sparkContext.broadcast(many)
    # So many cells that one has some megabytes of segments, however large the input.
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cell_bits = min(30, max(parts, n_keys // CELL_KEYS).bit_length())
    below = np.uint64(KEY_BITS - cell_bits)
    shards = np.uint64(-(-n_many // SHARD))

    def dealt(names: np.ndarray, digests: np.ndarray) -> np.ndarray:
        """Keys, whose upper bits are the cell: of a name with many segments, a shard."""
        keys = _keys(names)
        if shards:
            at = np.flatnonzero(_is_shared(many.value, names))
            keys[at] = (np.uint64(1 << cell_bits) + digests[at].view(np.uint64) % shards) << below
        return keys

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = base = 0

        def packs() -> pa.RecordBatch:
            flats, keys, h1, h2, ids, first, last = zip(*held, strict=True)
            flat, columns = b"".join(flats), [np.concatenate(c) for c in (keys, h1, h2, ids, first, last)]
            held.clear()
            order = np.lexsort((columns[1], columns[0]))
            keys, h1, h2, ids, first, last = (c[order] for c in columns)
            new = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            low, high = np.minimum.reduceat(ids, new), np.maximum.reduceat(ids, new)
            of, first, last = (keys[new] >> below).astype(np.int64), first[new], last[new]
            cuts = [*np.flatnonzero(np.append(True, of[1:] != of[:-1])).tolist(), len(of)]
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                raw = _planes(last[a:b] - first[a:b], low[a:b], high[a:b] - low[a:b]) + b"".join(
                    flat[x:y] for x, y in zip(first[a:b].tolist(), last[a:b].tolist(), strict=True))
                out.append((int(of[a]), b - a, len(raw), _compressed(raw)))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                   ["cell", "n", "size", "segments"])

        for _, s in _pieces(batches, length):
            at = np.flatnonzero(_is_shared(bits.value, s.name))
            if not len(at):
                continue
            h1, h2 = s.digests(at)
            held.append((s.flat, dealt(s.name[at], h1), h1, h2, s.ids[s.row[at]], s.first[at] + base, s.last[at] + base))
            base += len(s.flat)
            size += len(s.flat) + 48 * len(at)
            if size >= HELD_BYTES:
                yield packs()
                size = base = 0
        if held:
            yield packs()

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, s in _pieces(batches, length):
            at = np.flatnonzero(_is_shared(bits.value, s.name))
            row = s.row[at]
            h1, h2 = s.digests(at)
            yield pa.record_batch([pa.array(s.ids[row]), piece.column(2).take(pa.array(row)),
                                   pa.array(s.start[at]), pa.array(h1), pa.array(h2)],
                                  ["doc", "digest", "at", "h1", "h2"])

    resolved = stored(docs.select("doc_id", "text")
                      .mapInArrow(lean(different), "cell long, n int, size long, segments binary")
                      .repartition(parts, "cell").sortWithinPartitions("cell")
                      .mapInArrow(lean(lambda batches: _resolve(batches, length, 1 << cell_bits)),
                                  f"h1 long, h2 long, {RANGES}, shard long, low long, high long, segment binary"))
    whole = resolved.where("shard is null").select("h1", "h2", "ranges")
    if shards:
        whole = whole.union(stored(_resolve_shards(resolved.where("shard is not null"), length)))
    held = (docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
            .mapInArrow(lean(places), "doc long, digest long, at long, h1 long, h2 long").join(whole, ["h1", "h2"]))
    mine = F.filter("ranges", lambda r: r["low"] < F.col("doc"))
    return (held.select("doc", "digest", "at", mine.alias("ranges")).where(F.size("ranges") > 0)
            .select("doc", "digest", F.transform("ranges", lambda r: F.struct(
                (F.col("at") + r["start"]).alias("start"), (F.col("at") + r["end"]).alias("end"))).alias("own"))
            .groupBy("doc", "digest").agg(F.flatten(F.collect_list("own")).alias("covered")))


def joined_spans(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching ranges, in order."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row, with the
    bytes that are left (`kept`) on request."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    spans = stored(repeated_spans(docs, length))
    bits = docs.sparkSession.sparkContext.broadcast(id_bits(spans.select("doc"), ID_BITS))
    schema = REMOVED + (", kept binary" if keep_text else "")

    def reduced(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        covered = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
        for doc, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), covered, strict=True):
            raw = (text or "").encode()
            runs = joined_spans([(r["start"], r["end"]) for r in own or ()])
            edges = [0, *(x for run in runs for x in run), len(raw)]
            kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((doc, len(raw), len(raw) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        names = [*("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), *["kept"] * keep_text]
        types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns[:len(names)], types, strict=False)], names)

    def part(touched: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = np.array([i if i is not None else -1 for i in batch.column(0).to_pylist()], np.int64)
                has = in_bits(bits.value, ids, ID_BITS) if len(ids) else np.zeros(0, np.bool_)
                own = batch.filter(pa.array(has == touched))
                yield own if touched else reduced(own)
        return run

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield reduced(batch)

    # Only texts that may have lost something are shuffled.
    maybe = docs.mapInArrow(lean(part(True)), "doc_id long, text string").withColumn("digest", F.xxhash64("text"))
    met = maybe.join(spans, (F.col("doc_id") == F.col("doc")) & (maybe.digest == spans.digest), "left")
    return (docs.mapInArrow(lean(part(False)), schema)
            .union(met.select("doc_id", "text", "covered").mapInArrow(lean(finish), schema)))
