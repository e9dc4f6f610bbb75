"""N-gram Jaccard join: T-occurrence search with DivideSkip.

A document's set holds its distinct word shingles (64-bit hashes).  Equal sets
form one class and are joined once.  Two classes link when
``100 * intersection >= percent * union``; each linked pair of classes lies in
one component.

1. Every class gets a prefix: its rarest shingles, so many that any two classes
   that can link share a given number of them, and one of the first few.
   Rarity comes from a sketch of shingle counts over all documents; its fixed
   size only affects speed, as any common order gives the same links.
2. Classes that agree in a minimum-hash key are compared with the first of them.
   This connects large groups of near copies in linear work.
3. What is not yet connected is searched by inverted lists for partners that
   occur at least T times: short lists are merged by a heap, long ones probed
   by bisection (DivideSkip).  The first search, over prefixes, gathers
   families; the second, over the whole sets of a family, finds the links.
   Large groups are cut into blocks and every pair of blocks is searched, so
   that no task holds a group, and nothing is left out.

Defined results: a null text counts as empty; without words a document has an
empty set, no links, and is its own component; fewer words than a shingle has
make one shingle of them all; repeated rows fall into one class; a null doc_id
takes part but never names a component unless all its members are null;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlib.llm import lexicon
from marginlib.llm.common import discard, id_bits, in_bits, lean, map_batches, slices, stored
from marginlib.llm.components import components

SHARED = 4              # shingles at least that two linkable classes share within their prefixes
KEYS = 4                # minimum-hash keys of a class
SKETCH_BITS = 22        # counters of the rarity sketch
SLICES = 64             # parts in which sketches are added up
BLOCK = 1_000           # classes of a group in each of the two blocks that a task holds
COUNTED = 4_096         # numbers in short lists from which they are merged by counting
PIECE = 1 << 20         # bytes of texts, about, that are hashed at once
KEY_BITS = 40           # bits of a shingle's key in packed lists
CELL_KEYS = 1 << 20     # keys, about, of a cell of packed lists
BIT_SET = 24            # bits (as a power of two) of the filter in front of text joins

_A = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, np.bool_)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_WORDS_MOST = 100_000


class _Words(dict):
    """Hashes of words; kept for each Python worker, dropped when there are many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_MOST:
            self.clear()
        out = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = out
        return out


_hash_of = _Words().__getitem__


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hash_of, words), np.uint64, len(words))
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for j in range(n):
        out = out * _A + h[j:len(h) - n + 1 + j]
    return np.unique(_mix(out))


def batch_shingles(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a column; other hashes than those of
    `shingles`, which hashes one text.  About a megabyte of texts is worked on at once."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    edge = [0, *(np.flatnonzero(np.diff(ends // PIECE)) + 1).tolist(), len(column)]
    return [s for a, b in zip(edge, edge[1:], strict=False) for s in _piece_shingles(column[a:b], size)]


def _piece_shingles(column: pa.Array, size: int) -> list[np.ndarray]:
    data, bounds = lexicon.joined(column, b"\n")
    data = _LOWER[data]
    words, starts = lexicon.split(data, _GAP[data])
    h = lexicon.word_hashes(*lexicon.parts(words))
    first = np.searchsorted(starts, bounds)
    out = np.full(max(0, len(h) - size + 1), np.uint64(size))
    for j in range(size):
        out = out * _A + h[j:len(h) - size + 1 + j]
    out, sets = _mix(out), []
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= size:
            sets.append(np.unique(out[a:b - size + 1]))
        elif b > a:                                     # all words are one shingle
            one = np.full(1, np.uint64(b - a))
            for x in h[a:b]:
                one = one * _A + x
            sets.append(_mix(one))
        else:
            sets.append(out[:0])
    return sets


def _class_of(s: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return (int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True))


# -- 1. sketch, classes, prefixes ---------------------------------------------------------------


def _sketch(docs: DataFrame, size: int) -> np.ndarray:
    """How often each of 2**SKETCH_BITS groups of shingles occurs in all documents."""
    cells = 1 << SKETCH_BITS
    step = cells // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.uint32)
        for batch in batches:
            for part in slices(batch):
                for s in batch_shingles(part.column(0), size):
                    total[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] += 1
        for i in range(SLICES):         # only the counters that a task has counted
            own = total[i * step:(i + 1) * step]
            at = np.flatnonzero(own)
            if len(at):
                body = lexicon.pack(lexicon.narrow(at), lexicon.narrow(own[at]))
                yield pa.record_batch([pa.array([i], pa.int32()), pa.array([body])], ["slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, n = lexicon.unpack(raw)
                sums.setdefault(k, np.zeros(step, np.uint64))[at] += n
        for k, v in sums.items():
            yield pa.record_batch([pa.array([k], pa.int32()),
                                   pa.array([np.minimum(v, 65535).astype(np.uint16).tobytes()])],
                                  ["slice", "counts"])

    schema = "slice int, counts binary"
    parts = (docs.select("text").mapInArrow(lean(count), schema)
             .repartition(min(SLICES, 16), "slice").mapInArrow(lean(add), schema).collect())
    out = np.zeros(cells, np.uint16)
    for r in parts:     # fixed size: 2**SKETCH_BITS counters of two bytes
        out[r.slice * step:(r.slice + 1) * step] = np.frombuffer(r.counts, np.uint16)
    return out


def _partner(n: int, pct: int) -> int:
    """Least size of a set that links with one of n, and least intersection."""
    return -(-pct * n // 100)


def _shared(n: int, pct: int) -> int:
    """Shingles that the prefix of n holds beyond those that a partner may lack."""
    return max(SHARED, -(-n * (100 - pct) // 200))


def _prefix_length(n: int, pct: int) -> int:
    return min(n, n - _partner(n, pct) + _shared(n, pct))


def _occurrences(n: int, pct: int) -> int:
    """Shingles that any partner's prefix has in common with that of n."""
    least = _partner(n, pct)
    return min(least, _shared(least, pct))


def _signatures(docs: DataFrame, size: int, pct: int) -> DataFrame:
    """A row for each document: class, number of shingles, keys and prefix."""
    counts = docs.sparkSession.sparkContext.broadcast(_sketch(docs, size))
    shift = np.uint64(64 - SKETCH_BITS)
    bins = (np.arange(2 * KEYS, dtype=np.uint64) << np.uint64(64 - (2 * KEYS - 1).bit_length()))

    def make():
        seen = counts.value

        def one(s: np.ndarray):
            n = len(s)
            if not n:
                return 0, 0, 0, [], [], 0
            ranks = np.argsort(seen[(s >> shift).astype(np.int64)], kind="stable")
            prefix = s[ranks[:_prefix_length(n, pct)]]
            # The smallest hash in each part of the hash range; two parts make a key.
            at = np.searchsorted(s, bins)
            ends = [*at[1:].tolist(), n]
            least = [int(s[i]) if i < e else 0 for i, e in zip(at.tolist(), ends, strict=True)]
            keys = [hash((k, least[2 * k], least[2 * k + 1])) for k in range(KEYS)
                    if least[2 * k] or least[2 * k + 1]]
            return (n, *_class_of(s), keys, prefix.view(np.int64), _occurrences(n, pct))

        def each(batch: pa.RecordBatch):
            rows = [one(s) for s in batch_shingles(batch.column(1), size)]
            return [batch.column(0), *(zip(*rows) if rows else [[]] * 6)]
        return each

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, n long, c1 long, c2 long, "
                       "keys array<long>, prefix array<long>, t long")


# -- 2. comparison with the first of each key ---------------------------------------------------


def _key_pairs(classes: DataFrame, pct: int) -> DataFrame:
    """Pairs (x, y) of each class and the first class that has the same key."""
    rows = classes.select("doc", "n", F.explode("keys").alias("key"))
    first = (rows.groupBy("key").agg(F.min(F.struct("doc", "n")).alias("first"), F.count("*").alias("rows"))
             .where("rows > 1").select("key", "first"))
    return (rows.join(first, "key")
            .where(F.col("doc") != F.col("first.doc"))
            .where(_sizes_fit(F.col("n"), F.col("first.n"), pct))
            .select(F.col("doc").alias("x"), F.col("first.doc").alias("y")).distinct())


def _sizes_fit(a, b, pct: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * pct


# -- 3. T-occurrence search ---------------------------------------------------------------------


def t_occurrence(lists: list[np.ndarray], t: int) -> list[int]:
    """Numbers that occur in at least ``t`` of the ascending lists.

    DivideSkip: the longest lists are set aside, the more of them the longer
    they are; the others are merged; what occurs there often enough to reach t
    with the long lists is looked up in those by bisection.  A heap merges,
    and jumps ahead to the next number that can still occur often enough.  (Many
    long lists of a dense group are merged by counting, which is the same.)
    """
    lists = sorted((x for x in lists if len(x)), key=len)
    if t < 1 or len(lists) < t:
        return []
    aside = min(int(t / (1 + 0.1 * np.log2(len(lists[-1]) + 1))), t - 1)
    short, long = lists[:len(lists) - aside], lists[len(lists) - aside:]
    total = sum(map(len, short))
    if total > COUNTED:
        counts = np.bincount(np.concatenate(short))
        found = np.flatnonzero(counts >= t - aside)
        seen = counts[found]
        for x in long:
            at = np.minimum(np.searchsorted(x, found), len(x) - 1)
            seen += x[at] == found
        return found[seen >= t].tolist()
    return _heap_merge([x.tolist() for x in short], [x.tolist() for x in long], t)


def _heap_merge(short: list[list[int]], long: list[list[int]], t: int) -> list[int]:
    need, out = t - len(long), []
    heap = [(x[0], k, 0) for k, x in enumerate(short)]
    heapq.heapify(heap)
    while len(heap) >= need:
        value, taken = heap[0][0], []
        while heap and heap[0][0] == value:
            taken.append(heapq.heappop(heap))
        if len(taken) >= need:
            found = len(taken)
            for k, x in enumerate(long):
                if found >= t or found + len(long) - k < t:
                    break
                at = bisect_left(x, value)
                found += at < len(x) and x[at] == value
            if found >= t:
                out.append(value)
            reach = value + 1
        else:
            # With need - 1 lists off the heap, numbers below its new top
            # can't occur need times.
            while len(taken) < need - 1:
                taken.append(heapq.heappop(heap))
            reach = heap[0][0]
        for _, k, at in taken:
            at = bisect_left(short[k], reach, at)
            if at < len(short[k]):
                heapq.heappush(heap, (short[k][at], k, at))
    return out


class _Index:
    """Inverted lists: shingle -> ascending record numbers."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(flat, kind="stable")
        self.keys, starts = np.unique(flat[order], return_index=True)
        self.starts, self.of = [*starts.tolist(), len(flat)], of[order]

    def lists(self, shingles: np.ndarray) -> list[np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, shingles), max(0, len(self.keys) - 1))
        at = at[self.keys[at] == shingles] if len(self.keys) else []
        return [self.of[self.starts[i]:self.starts[i + 1]] for i in at]


class _Union:
    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _families(docs, comps, sizes, ts, prefixes, pct: int):
    """Links (x, y) that join into one family all records whose prefixes share t
    shingles, as a spanning forest: a record that is already joined to all
    others is not searched for."""
    union = _Union()
    for d, c in zip(docs, comps, strict=True):
        union.join(("c", c), ("d", d))
    index, left = _Index(prefixes), len({*comps})
    for k in range(len(docs)):
        if left == 1:
            return
        for j in t_occurrence(index.lists(prefixes[k]), ts[k]):
            fits = 100 * min(sizes[k], sizes[j]) >= pct * max(sizes[k], sizes[j])
            if fits and union.join(("d", docs[k]), ("d", docs[j])):
                left -= 1
                yield docs[k], docs[j]


def _links(left: list[tuple], right: list[tuple] | None, pct: int):
    """Links (x, y) between records (doc, comp, set) of ``left`` and of ``right``
    (None: within ``left``), as a spanning forest.  Two sets link if they
    share pct / (100 + pct) of their joint size.  Records of the largest
    component are searched for only, as no link within it is new."""
    union = _Union()
    for d, c, _ in [*left, *(right or [])]:
        union.join(("c", c), ("d", d))
    inside = right is None
    records = left if inside else right
    index = _Index([r[2] for r in records])
    largest = Counter(r[1] for r in records).most_common(1)[0][0] if inside and records else None
    for doc, comp, own in left:
        if inside and comp == largest:
            continue
        n = len(own)
        # The least intersection with any set that can link; then the exact one.
        for j in t_occurrence(index.lists(own), -(-pct * n // 100)):
            other = records[j][2]
            if union.find(("d", doc)) == union.find(("d", records[j][0])):
                continue
            same = len(np.intersect1d(own, other, assume_unique=True))
            if 100 * same >= pct * (n + len(other) - same):
                union.join(("d", doc), ("d", records[j][0]))
                yield doc, records[j][0]


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """((key, low, high), doc, comp, n, t, prefix) of each row."""
    *columns, prefixes = batch.columns
    key, low, high, doc, comp, n, t = (c.to_pylist() for c in columns)
    offsets, values = prefixes.offsets.to_pylist(), prefixes.values.to_numpy()
    for i in range(batch.num_rows):
        yield (key[i], low[i], high[i]), doc[i], comp[i], n[i], t[i], values[offsets[i]:offsets[i + 1]]


def _between(rows: DataFrame) -> DataFrame:
    """Keys of ``rows`` (key, comp) that occur in two components or more."""
    return (rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                    F.count("*").alias("rows"))
            .where("low < high").select("key", "rows"))


def _dealt(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` (key, doc, ...) of ``keys`` (key, rows), large groups cut: each of
    their blocks goes to every pair of blocks that it is in."""
    cut = keys.select("key", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    return (rows.join(cut, "key").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
            .drop("blocks", "other"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of (numbers, counts), a number once."""
    numbers, at = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
    return numbers, np.bincount(at, np.concatenate([n for _, n in parts]), len(numbers)).astype(np.int64)


def _able(named: DataFrame) -> DataFrame:
    """Classes (doc) whose prefix shares t shingles or more with other components.

    Shingles travel as packed lists of keys with the places of their classes, a pack for each cell of
    keys, of which there are more the more shingles there are.  Keys have 40 bits of a
    hash: should two shingles have one key, more classes are searched, with the same result.
    """
    total = int(named.agg(F.sum(F.size("prefix").cast("long"))).first()[0] or 0)
    bits = min(24, max(4, (total // CELL_KEYS).bit_length()))
    buckets = 1 << max(4, bits - 4)             # of classes, to whom their shared keys are added up

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 16 << 20):
                docs, comps, prefixes = part.columns
                offsets = prefixes.offsets.to_numpy()
                keys = prefixes.values.to_numpy()[offsets[0]:offsets[-1]].view(np.uint64) & np.uint64((1 << KEY_BITS) - 1)
                of = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                order = np.argsort(keys, kind="stable")
                keys, of = keys[order], of[order]
                cell = (keys >> np.uint64(KEY_BITS - bits)).astype(np.int64)
                edge = np.flatnonzero(np.diff(cell, prepend=-1, append=-1)) if len(cell) else []
                docs, comps = docs.to_numpy(), comps.to_numpy()
                for a, b in zip(edge, edge[1:], strict=False):
                    own, at = np.unique(of[a:b], return_inverse=True)
                    steps = np.diff(keys[a:b], prepend=np.uint64(0))
                    body = lexicon.pack(lexicon.narrow(steps), lexicon.narrow(at), docs[own], comps[own])
                    yield pa.record_batch([pa.array([int(cell[a])]), pa.array([body])], ["cell", "body"])

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in lexicon.by_key(batches, "cell"):
            keys, docs, comps = [], [], []
            for _, body in group:
                steps, at, own, of = lexicon.unpack(body)
                keys.append(np.cumsum(steps, dtype=np.uint64))
                docs.append(own[at])
                comps.append(of[at])
            keys, docs, comps = map(np.concatenate, (keys, docs, comps))
            order = np.argsort(keys, kind="stable")
            keys, docs, comps = keys[order], docs[order], comps[order]
            start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            apart = np.minimum.reduceat(comps, start) < np.maximum.reduceat(comps, start)
            found, n = np.unique(docs[np.repeat(apart, np.diff(start, append=len(keys)))], return_counts=True)
            bucket = _mix(found.view(np.uint64)) % np.uint64(buckets)
            for b in np.unique(bucket).tolist():
                own = bucket == b
                body = lexicon.pack(np.diff(found[own], prepend=0), lexicon.narrow(n[own]))
                yield pa.record_batch([pa.array([b], pa.int64()), pa.array([body])], ["bucket", "body"])

    def total_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in lexicon.by_key(batches, "bucket"):
            held, waiting = (np.zeros(0, np.int64), np.zeros(0, np.int64)), []
            for _, body in group:
                steps, n = lexicon.unpack(body)
                waiting.append((np.cumsum(steps), n.astype(np.int64)))
                if sum(len(x) for x, _ in waiting) > CELL_KEYS:
                    held, waiting = _added([held, *waiting]), []
            held = _added([held, *waiting])
            yield pa.record_batch([pa.array(x) for x in held], ["doc", "found"])

    packs = named.select("doc", "comp", "prefix").mapInArrow(lean(deal), "cell long, body binary")
    counts = packs.repartition("cell").sortWithinPartitions("cell").mapInArrow(lean(shared), "bucket long, body binary")
    found = counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lean(total_of), "doc long, found long")
    return named.select("doc", "t").join(found, "doc").where("found >= t").select("doc")


def _search(docs: DataFrame, classes: DataFrame, comps: DataFrame, size: int, pct: int) -> DataFrame:
    """Links (a, b) that connect what ``comps`` leaves apart.

    A class whose prefix shares fewer than t shingles with other components has
    no partner there.  The others form families, connected by prefixes that
    share t shingles; every linked pair lies within one family, whose whole
    sets are then searched.
    """
    # First among all classes, each for itself, without a shuffle of whole rows; what is
    # left, with the components.
    alone = stored(_able(classes.select("doc", F.col("doc").alias("comp"), "t", "prefix")))
    some = _held(classes.select("doc", "n", "t", "prefix"), alone)
    some = stored(some.join(comps, some.doc == comps.node, "left")
                  .select("doc", F.coalesce("component", "doc").alias("comp"), "n", "t", "prefix"))
    named = stored(_held(some, stored(_able(some))))
    discard(some)
    # Of the shingles that other components have too, in their common order, a pair that
    # shares t has one among the first of each that leave t - 1 behind them.
    keyed = named.select("doc", "comp", "t", F.posexplode("prefix").alias("place", "key"))
    shared = (keyed.join(_between(keyed.select("key", "comp")).select("key"), "key").groupBy("doc", "comp", "t")
              .agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("shared")))
    first = F.greatest(F.size("shared") - F.col("t").cast("int") + 1, F.lit(0))
    lists = stored(shared.select("doc", "comp", F.explode(F.slice("shared", F.lit(1), first)).alias("s"))
                   .select("doc", "comp", F.col("s.key").alias("key")))
    # A key's records meet in the group of the smallest of them.  Near copies share most of their
    # keys, so a record is sent with its prefix to few groups, not once for each key.
    leaders = (lists.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("doc").alias("leader"))
               .where("low < high").select("key", "leader"))
    groups = stored(lists.join(leaders, "key").select(F.col("leader").alias("key"), "doc").distinct())
    dealt = _dealt(groups, groups.groupBy("key").agg(F.count("*").alias("rows"))).join(named, "doc")

    keys = ["key", "low", "high"]

    def join_families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in _rows(b))
        for _, group in itertools.groupby(rows, key=lambda r: r[0]):
            _, docs_, comps_, sizes, ts, prefixes = zip(*group, strict=True)
            pairs = list(_families(docs_, comps_, sizes, ts, prefixes, pct))
            if pairs:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], ["a", "b"])

    # Most groups have two or three records: they follow each other in a sorted
    # stream, which costs far less than a call for each.
    joined = (dealt.select(*keys, "doc", "comp", "n", "t", "prefix").repartition(*keys)
              .sortWithinPartitions(*keys).mapInArrow(lean(join_families), "a long, b long").distinct())
    own = named.select(F.col("doc").alias("a"), F.col("comp").alias("b"))
    families = stored(components(joined.union(own)).withColumnsRenamed({"node": "doc", "component": "key"}))
    members = (named.select("doc", "comp").join(families, "doc"))
    members = stored(members.join(_between(members.select("key", "comp")).select("key"), "key", "left_semi"))
    whole = members.join(_texts_of(docs, members.select("doc")), "doc")

    def search_family(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        parts: dict[int, list] = defaultdict(list)
        for block, doc, comp, text in zip(frame.own, frame.doc, frame.comp, frame.text, strict=True):
            parts[block].append((doc, comp, shingles(text, size)))
        _, low, high = key
        pairs = _links(parts[low], None if low == high else parts[high], pct)
        return pd.DataFrame(list(pairs), columns=["a", "b"])

    return (_dealt(whole, members.groupBy("key").agg(F.count("*").alias("rows")))
            .groupBy("key", "low", "high").applyInPandas(search_family, "a long, b long"))


# -- checks on whole texts -------------------------------------------------------------------


def _held(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose doc is in ``ids`` (column doc).

    A bit set of fixed size over ids keeps most other rows out of the
    shuffle; the join behind it is exact.
    """
    sent = rows.sparkSession.sparkContext.broadcast(id_bits(ids.select("doc"), BIT_SET))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bits(sent.value, batch.column(0).to_numpy(), BIT_SET)))

    return rows.mapInArrow(lean(run), rows.schema).join(ids.distinct(), "doc", "left_semi")


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc, text) of the rows of ``docs`` whose doc_id is in ``ids`` (column doc)."""
    return _held(docs.select(F.col("doc_id").alias("doc"), "text"), ids)


def _linked(pairs: DataFrame, docs: DataFrame, size: int, pct: int) -> DataFrame:
    """The pairs (x, y) whose texts link, as (a, b)."""
    text = _texts_of(docs, pairs.select(F.col("x").alias("doc")).union(pairs.select("y")))
    both = (pairs.join(text.withColumnsRenamed({"doc": "x", "text": "x_text"}), "x")
            .join(text.withColumnsRenamed({"doc": "y", "text": "y_text"}), "y"))

    def make():
        last: list = [None, None]

        def of(t: str) -> np.ndarray:       # the same y follows itself
            if last[0] != t:
                last[:] = t, shingles(t, size)
            return last[1]

        def each(batch: pa.RecordBatch):
            a, b = [], []
            for x, y, tx, ty in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sx, sy = shingles(tx or "", size), of(ty or "")
                same = len(np.intersect1d(sx, sy, assume_unique=True))
                if same and 100 * same >= pct * (len(sx) + len(sy) - same):
                    a.append(x)
                    b.append(y)
            return [a, b]
        return each

    return map_batches(both.select("x", "y", "x_text", "y_text"), make, "a long, b long")


def near_copies(docs: DataFrame, size: int = 5, pct: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    Two documents link when their sets of ``size``-word shingles have a
    Jaccard similarity of ``pct`` percent or more; component_id is the smallest
    doc_id reachable by links.
    """
    docs = docs.select("doc_id", "text")
    whole = stored(_signatures(docs, size, pct))
    # One class for equal sets; its smallest doc_id stands for it.
    classes = stored(whole.where("n > 0 and doc_id is not null").groupBy("c1", "c2")
                     .agg(F.min("doc_id").alias("doc"), F.min("n").alias("n"),
                          F.first("keys").alias("keys"), F.first("prefix").alias("prefix"),
                          F.min("t").alias("t")))     # first: they are equal
    rows = stored(whole.select("doc_id", "n", "c1", "c2"))
    discard(whole)
    texts_of = docs.where("doc_id is not null")
    near = stored(_linked(stored(_key_pairs(classes, pct)), texts_of, size, pct))
    more = _search(texts_of, classes, components(near), size, pct)
    comps = components(near.union(more))
    named = (classes.join(comps, classes.doc == comps.node, "left")
             .select("c1", "c2", F.coalesce("component", "doc").alias("component")))
    return (rows.select("doc_id", "n", "c1", "c2").join(named, ["c1", "c2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("component", "doc_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, size: int = 5, pct: int = 80) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (null: the largest).

    Rows are compared one by one: rows that share a doc_id but no link all stay, and
    rows without a doc_id take part.  Rows without words stay.
    """
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        heads = near_copies(docs, size, pct).where("doc_id = component_id").select("doc_id")
        return docs.join(heads, "doc_id", "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
    # A number for each row, in a table, so that it stays the same.
    whole = stored(docs.select(F.monotonically_increasing_id().alias("number"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")))
    linked = near_copies(whole.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")), size, pct)
    ids = whole.select("number", F.col("row.doc_id").alias("own"))
    heads = (linked.join(ids, linked.doc_id == ids.number)
             .groupBy("component_id").agg(F.min(F.struct(F.col("own").isNull(), "own", "number")).alias("head")).select("head.number"))
    return whole.join(heads, "number", "left_semi").select("row.*")
