"""Counting quotient filters over packed word-number n-grams, without loss.

An n-gram of up to three word numbers of ``bits`` bits (0: no word) is one number of
``3 * bits`` bits.  A Feistel network permutes such numbers; it can be undone, so that
nothing is lost, and spreads them evenly.  A permuted number is cut into a
quotient, its first bits, and the remainder, all the others.  A filter keeps for
each quotient how many remainders it has (its run), the remainders in order, and a
counter for each.  Quotients are not stored: they follow from the runs.  Filters of shards are
sorted alike, so they merge like sorted lists, adding the counters of equal numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from marginlib.llm.lexicon import narrow, pack, unpack

# Keys of the rounds.
_ROUNDS = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_ONE = np.uint64(1)


def half_bits(bits: int) -> int:
    """Bits of each half of a packed n-gram."""
    return -(-3 * bits // 2)


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def _round(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x + key) * _u(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _u(33))) * _u(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _u(29))


def permute(a: np.ndarray, b: np.ndarray, c: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The halves (left, right) of each permuted n-gram (a, b, c)."""
    h = half_bits(bits)
    a, b, c = (x.astype(np.uint64) for x in (a, b, c))
    low = _u(h - bits)                  # bits of b that the right half has
    right = ((b & ((_ONE << low) - _ONE)) << _u(bits)) | c
    left = (a << _u(2 * bits - h)) | (b >> low)
    mask = (_ONE << _u(h)) - _ONE
    for key in _ROUNDS:
        left, right = right, left ^ (_round(right, key) & mask)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams (a, b, c) of permuted ones."""
    h = half_bits(bits)
    mask = (_ONE << _u(h)) - _ONE
    for key in reversed(_ROUNDS):
        left, right = right ^ (_round(left, key) & mask), left
    low, one = _u(h - bits), (_ONE << _u(bits)) - _ONE
    b = ((left << low) & one) | (right >> _u(bits))
    return tuple(x.astype(np.int64) for x in (left >> _u(2 * bits - h), b, right & one))


def counted(left: np.ndarray, right: np.ndarray, counts: np.ndarray | None, bits: int):
    """Distinct permuted numbers in order, with their (summed) counts."""
    h = half_bits(bits)
    if not len(left):
        return left, right, np.zeros(0, np.int64)
    if 2 * h <= 64:
        key = (left << _u(h)) | right
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")      # merges sorted stretches
            key, counts = key[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        left, right = key[first] >> _u(h), key[first] & ((_ONE << _u(h)) - _ONE)
    else:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        counts = counts if counts is None else counts[order]
        first = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
        left, right = left[first], right[first]
    if counts is None:
        counts = np.diff(first, append=len(order) if 2 * h > 64 else len(key))
    else:
        counts = np.add.reduceat(counts, first)
    return left, right, counts


@dataclass
class Filter:
    """``bits`` of a word number; ``held`` bits of the left half that all numbers share
    (their cell); ``quotient`` bits that follow; the arrays of the filter."""

    bits: int
    held: int
    cell: int
    quotient: int
    runs: np.ndarray
    high: np.ndarray        # what the quotient leaves of the left half
    low: np.ndarray         # the right half
    counts: np.ndarray

    @classmethod
    def of(cls, left, right, counts, bits: int, held: int, cell: int) -> Filter:
        """The filter of sorted distinct numbers of one cell."""
        rest = half_bits(bits) - held
        quotient = min(rest, max(0, len(left).bit_length() - 1))
        own = left & ((_ONE << _u(rest)) - _ONE)
        runs = np.bincount((own >> _u(rest - quotient)).astype(np.int64), minlength=1 << quotient)
        return cls(bits, held, cell, quotient, runs, own & ((_ONE << _u(rest - quotient)) - _ONE), right, counts)

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """The permuted numbers, in order."""
        rest = half_bits(self.bits) - self.held
        quotients = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        left = (_u(self.cell) << _u(rest)) | (quotients << _u(rest - self.quotient)) | self.high
        return left, self.low

    def merge(self, *others: Filter) -> Filter:
        """One filter with the counters of this and ``others``, of the same cell."""
        filters = [self, *others]
        numbers = [f.numbers() for f in filters]
        left, right = (np.concatenate(x) for x in zip(*numbers, strict=True))
        return Filter.of(*counted(left, right, np.concatenate([f.counts for f in filters]), self.bits),
                         self.bits, self.held, self.cell)

    def body(self) -> bytes:
        return pack(np.array([self.bits, self.held, self.cell, self.quotient]), narrow(self.runs),
                    narrow(self.high), narrow(self.low), narrow(self.counts))

    @classmethod
    def read(cls, body: bytes) -> Filter:
        head, runs, high, low, counts = unpack(body)
        return cls(*head.tolist(), runs.astype(np.int64), high.astype(np.uint64), low.astype(np.uint64),
                   counts.astype(np.int64))


def filters(left: np.ndarray, right: np.ndarray, bits: int, held: int):
    """A filter for each cell (the first ``held`` bits) of the permuted numbers."""
    left, right, counts = counted(left, right, None, bits)
    cells = (left >> _u(half_bits(bits) - held)).astype(np.int64)
    edge = np.flatnonzero(np.diff(cells, prepend=-1, append=-1)) if len(cells) else []
    for a, b in zip(edge, edge[1:], strict=False):
        yield Filter.of(left[a:b], right[a:b], counts[a:b], bits, held, int(cells[a]))
