"""Benchmark decontamination by greedy string tiling.

Texts are sequences of lower-case words.  Documents and benchmark items are
joined on shared runs of ``tile_words`` words (the seeds); for each pair that
shares one, running Karp-Rabin greedy string tiling covers the item with the
longest common runs that don't overlap, longest first.  A document whose tiles
cover enough of an item's words is contaminated, in whatever order the passages
stand.

The benchmark is the stated query set: it goes to the tasks in blocks of
bounded size, and each block meets every document in one narrow pass, so that
no document text, seed or pair is shuffled and a passage which a third of all
documents share makes no hot key.

Defined results: a null text counts as empty; texts and items without words
match nothing; an item shorter than ``tile_words`` words matches as one run of
its own length; a benchmark row repeated with the same id and words counts once,
repeated documents are reported each by itself; ties between runs of equal length go to the earlier place in the item,
then in the document; empty tables give empty results; extra columns are not
read by `find_leaks` and passed on unchanged by `drop_leaks`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlib.llm.common import lean

TILE_WORDS = 5
COVERAGE_PCT = 60
BLOCK_WORDS = 2_000_000         # benchmark words sent to the tasks at once (16 MB)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_PRIME = (1 << 61) - 1
_GAP = None                     # stands between parts of a document that aren't adjacent


def words(text: str | Column) -> Column:
    """Hashes of a text's words: runs of letters and digits, lower case."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(parts, ""), lambda w: F.xxhash64(w))


def tile(item: list, doc: list, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item start, document start, length) of each tile.

    In each round all common unmarked runs of at least ``size`` words are found
    through rolling hashes of their first ``size`` words; the longest are
    marked first; then ``size`` shrinks.  A run over twice the size restarts
    the round with its length.
    """
    if not item or not doc or least < 1:
        return []
    free_item, free_doc = [True] * len(item), [w is not _GAP for w in doc]
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), 4 * least))
    while True:
        runs = _common_runs(item, doc, free_item, free_doc, size)
        longest = max((n for n, _, _ in runs), default=0)
        if longest > 2 * size:
            size = longest
            continue
        _mark(runs, free_item, free_doc, size, tiles)
        if size == least:
            return tiles
        size = max(least, size // 2)


def _windows(seq: list, free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of every run of ``size`` free words."""
    top = pow(31, size - 1, _PRIME)
    value = length = 0
    for i, w in enumerate(seq):
        if not free[i]:
            value = length = 0
            continue
        if length == size:
            value = (value - seq[i - size] * top) % _PRIME
            length -= 1
        value = (value * 31 + w) % _PRIME
        length += 1
        if length == size:
            yield i - size + 1, value


def _common_runs(item, doc, free_item, free_doc, size) -> list[tuple[int, int, int]]:
    """(length, item start, document start) of runs that can't grow to the left."""
    at = defaultdict(list)
    for i, value in _windows(item, free_item, size):
        at[value].append(i)
    runs = []
    for j, value in _windows(doc, free_doc, size):
        for i in at.get(value, ()):
            if i and j and free_item[i - 1] and free_doc[j - 1] and item[i - 1] == doc[j - 1]:
                continue
            n = 0
            while (i + n < len(item) and j + n < len(doc) and free_item[i + n] and free_doc[j + n]
                   and item[i + n] == doc[j + n]):
                n += 1
            if n >= size:       # equal hashes of different words end here
                runs.append((n, i, j))
    return runs


def _mark(runs, free_item, free_doc, size, tiles) -> None:
    """Mark runs, longest first; what an earlier tile cuts goes back as its free parts."""
    by_length = defaultdict(list)
    for n, i, j in runs:
        by_length[n].append((i, j))
    while by_length:
        n = max(by_length)
        for i, j in sorted(set(by_length.pop(n))):
            free = [k for k in range(n) if free_item[i + k] and free_doc[j + k]]
            if len(free) == n:
                for k in range(n):
                    free_item[i + k] = free_doc[j + k] = False
                tiles.append((i, j, n))
                continue
            for start, length in _stretches(free):
                if length >= size:
                    by_length[length].append((i + start, j + start))


def _stretches(numbers: list[int]) -> list[tuple[int, int]]:
    """(first, length) of each run of consecutive numbers in an ascending list."""
    out: list[tuple[int, int]] = []
    for k in numbers:
        if out and sum(out[-1]) == k:
            out[-1] = (out[-1][0], out[-1][1] + 1)
        else:
            out.append((k, 1))
    return out


@dataclass
class Block:
    """A bounded part of the benchmark, indexed by seed."""

    ids: list
    items: list[list[int]]
    lengths: list[int]                      # seed lengths that occur
    seeds: dict[int, tuple]                 # length -> (sorted hashes, starts, items, filter)

    @classmethod
    def of(cls, rows: list, tile_words: int) -> Block:
        ids, items = [r[0] for r in rows], [list(r[1]) for r in rows]
        found = defaultdict(lambda: defaultdict(set))
        for k, item in enumerate(items):
            n = min(tile_words, len(item))
            for value in _rolling(np.array(item, np.int64), n).tolist() if n else ():
                found[n][value].add(k)
        seeds = {}
        for n, by_hash in found.items():
            hashes = np.array(sorted(by_hash), np.uint64)
            lists = [sorted(by_hash[h]) for h in hashes.tolist()]
            flags = np.zeros(1 << 20, np.bool_)
            flags[(hashes >> np.uint64(44)).astype(np.int64)] = True
            seeds[n] = (hashes, lists, flags)
        return cls(ids, items, sorted(seeds), seeds)

    def pairs(self, flat: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """(document, item) -> places in the document where a shared seed starts."""
        out = defaultdict(list)
        for n in self.lengths:
            hashes, lists, flags = self.seeds[n]
            rolled = _rolling(flat, n)
            at = np.flatnonzero(flags[(rolled >> np.uint64(44)).astype(np.int64)])
            if not len(at):
                continue
            where = np.searchsorted(hashes, rolled[at])
            where[where == len(hashes)] = 0
            hit = hashes[where] == rolled[at]
            at, where = at[hit], where[hit]
            doc = np.searchsorted(offsets, at, side="right") - 1
            inside = at + n <= offsets[doc + 1]
            for a, w, d in zip(at[inside].tolist(), where[inside].tolist(), doc[inside].tolist()):
                for k in lists[w]:
                    out[d, k].append(a)
        return out


def _rolling(flat: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of n words, modulo 2 to the 64th."""
    flat = flat.view(np.uint64)
    if len(flat) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(flat) - n + 1, np.uint64)
    for j in range(n):
        out *= _BASE
        out += flat[j:len(flat) - n + 1 + j]
    return out * _BASE


def blocks(benchmark: DataFrame, tile_words: int, block_words: int) -> list[Block]:
    """The benchmark in blocks of at most ``block_words`` words (or one item)."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).distinct()
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    if not total:
        return []
    n = -(-total // block_words)
    while True:
        part = F.pmod(F.xxhash64("item_id", "words"), F.lit(n))
        sizes = items.groupBy(part.alias("part")).agg(F.sum(F.size("words")).alias("size"),
                                                       F.count("*").alias("rows"))
        if n == 1 or not sizes.where((F.col("size") > block_words) & (F.col("rows") > 1)).count():
            break
        n *= 2
    return [Block.of(items.where(part == i).collect(), tile_words) for i in range(n)]


def _leaks(block: Block, batch: pa.RecordBatch, column: str, tile_words: int, pct: int):
    """(row, item, covered words, tiles) of each contaminated row of a batch."""
    lists = batch.column(batch.schema.get_field_index(column))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy()[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    for (row, k), starts in block.pairs(flat, offsets).items():
        item = block.items[k]
        least = min(tile_words, len(item))
        # Only places within a shared seed can be part of a tile.
        places = np.unique(np.add.outer(np.unique(starts), np.arange(least)))
        doc, at = [], []
        for p in places.tolist():
            if at and p != at[-1] + 1:
                doc.append(_GAP)
                at.append(p - 1)
            doc.append(int(flat[p]))
            at.append(p)
        tiles = [(i, at[j] - int(offsets[row]), n) for i, j, n in tile(item, doc, least)]
        covered = sum(n for _, _, n in tiles)
        if 100 * covered >= pct * len(item):
            yield row, k, covered, tiles


LEAKS = ("doc_id long, item_id long, n_item_words long, n_covered long, "
         "tiles array<struct<item_start:long,doc_start:long,n_words:long>>")


def find_leaks(docs: DataFrame, benchmark: DataFrame, tile_words: int = TILE_WORDS,
               coverage_pct: int = COVERAGE_PCT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each (document, item) whose tiles cover at least
    ``coverage_pct`` percent of the item's words, with the tiles."""
    spark = docs.sparkSession
    prepared = docs.select("doc_id", words(F.col("text")).alias("words"))

    def one(block: Block) -> DataFrame:
        sent = spark.sparkContext.broadcast(block)

        def run(batches):
            for batch in batches:
                ids, found = batch.column(0).to_pylist(), []
                for row, k, covered, tiles in _leaks(sent.value, batch, "words", tile_words, coverage_pct):
                    found.append({"doc_id": ids[row], "item_id": sent.value.ids[k],
                                  "n_item_words": len(sent.value.items[k]), "n_covered": covered,
                                  "tiles": [{"item_start": i, "doc_start": j, "n_words": n}
                                            for i, j, n in sorted(tiles)]})
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=_LEAKS_ARROW)

        return prepared.mapInArrow(lean(run), LEAKS)

    out = spark.createDataFrame([], LEAKS)
    for block in blocks(benchmark, tile_words, block_words):
        out = out.union(one(block))
    return out


_LEAKS_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item_words", pa.int64()),
    ("n_covered", pa.int64()),
    ("tiles", pa.list_(pa.struct([("item_start", pa.int64()), ("doc_start", pa.int64()),
                                  ("n_words", pa.int64())]))),
])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, tile_words: int = TILE_WORDS,
               coverage_pct: int = COVERAGE_PCT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without contaminated rows; a narrow pass for each block."""
    spark, schema = docs.sparkSession, docs.schema
    own = "__words"
    while own in docs.columns:
        own += "_"

    def one(left: DataFrame, block: Block) -> DataFrame:
        sent = spark.sparkContext.broadcast(block)

        def run(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, np.bool_)
                for row, *_ in _leaks(sent.value, batch, own, tile_words, coverage_pct):
                    keep[row] = False
                yield batch.select(batch.schema.names[:-1]).filter(pa.array(keep))

        return left.withColumn(own, words(F.col("text"))).mapInArrow(lean(run), schema)

    for block in blocks(benchmark, tile_words, block_words):
        docs = one(docs, block)
    return docs
