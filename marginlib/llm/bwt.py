"""Merging Burrows-Wheeler transforms by interleave refinement.

Each shard of byte strings has its own transform, whose letters are blocks of up to
``BLOCK`` bytes: what stands before each suffix.  The merged order starts as one shard
behind the other; every round sorts it stably by the blocks of the transforms, after
which it is right for as many more bytes as a block has.  Neighbours that some round
parted differ within these bytes, so that intervals of suffixes which share `depth`
bytes come out without sorting all suffixes again.
"""

from __future__ import annotations

import numpy as np


BLOCK = 7                   # bytes, of nine bits with the end mark, that one number holds


class Shard:
    """Strings, joined by an end mark, with the order of their suffixes."""

    def __init__(self, strings: list[bytes], depth: int):
        marked = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8).astype(np.uint16) + 1
        ends = np.cumsum([len(s) + 1 for s in strings]) - 1
        marked[ends] = 0
        # The letters from each place on, as a number; they make the first rank, each round doubles their number.
        self.blocks, size = np.zeros(len(marked), np.int64), BLOCK
        for k in range(size):
            self.blocks = (self.blocks << 9) | np.roll(marked, -k)
        rank = np.unique(self.blocks, return_inverse=True)[1].astype(np.int64)
        while size < depth:
            pair = rank * (int(rank.max()) + 1) + np.roll(rank, -size)
            rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
            size *= 2
        self.order = np.argsort(rank, kind="stable")

    def transform(self, width: int) -> np.ndarray:
        """The ``width`` letters before each suffix, in the order of suffixes."""
        return np.roll(self.blocks >> (9 * (BLOCK - width)), width)[self.order]

    def __len__(self) -> int:
        return len(self.order)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(source, parted): the shard of each suffix in merged order, and whether it differs
    within ``depth`` bytes from the one before it (true for the first)."""
    source = np.repeat(np.arange(len(shards), dtype=np.min_scalar_type(len(shards))), [len(s) for s in shards])
    n = len(source)
    cuts = np.cumsum([len(s) for s in shards])[:-1]
    group, parted = np.zeros(n, np.int32), np.arange(n) == 0
    rounds, rest = divmod(depth, BLOCK)
    for width, times in ((rest, int(rest > 0)), (BLOCK, rounds)):
        if not times:
            continue
        # Ranks of blocks: small numbers sort by counting.
        values, rank = np.unique(np.concatenate([s.transform(width) for s in shards]), return_inverse=True)
        own = np.split(rank.astype(np.min_scalar_type(len(values))), cuts)
        # Every round sorts the same blocks: their borders never change.
        border = np.zeros(n, np.bool_)
        border[np.cumsum(np.bincount(rank))[:-1]] = True
        border[:1] = True
        letters = np.empty(n, own[0].dtype)
        for _ in range(times):
            for k, transform in enumerate(own):
                letters[source == k] = transform
            moved = np.argsort(letters, kind="stable")
            source, before = source[moved], group[moved]
            parted = border.copy()
            parted[1:] |= before[1:] != before[:-1]
            group = np.cumsum(parted, dtype=np.int32)
    return source, parted


def least_by_window(strings: list[bytes], owners: np.ndarray, depth: int, shards: int = 2) -> list[np.ndarray]:
    """For each string the smallest owner, among all strings that hold it, of
    each of its ``depth``-byte windows."""
    cuts = [len(strings) * i // shards for i in range(shards + 1)]
    parts = [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]
    built = [Shard(strings[a:b], depth) for a, b in parts]
    source, parted = merge(built, depth)
    lengths = np.array([len(s) + 1 for s in strings])
    starts = np.concatenate([[0], np.cumsum(lengths)])
    place = np.empty(len(source), np.int64)         # of each suffix in all joined strings
    for k, (a, _) in enumerate(parts):
        place[source == k] = built[k].order + starts[a]
    of = np.repeat(np.arange(len(strings)), lengths)
    whole = np.arange(starts[-1]) + depth < starts[of + 1]      # windows that end within their string
    none = np.iinfo(np.int64).max
    value = np.where(whole, owners[of], none)[place]
    first = np.flatnonzero(parted)
    least = np.minimum.reduceat(value, first)
    out = np.empty(len(source), np.int64)
    out[place] = np.repeat(least, np.diff(np.append(first, len(source))))
    return [out[a:max(a, b - depth)] for a, b in zip(starts, starts[1:], strict=False)]
