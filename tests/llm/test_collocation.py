"""Quotient filters by round trips; collocations against brute force."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from marginlib.llm import collocation, quotient

DOCS = "doc_id long, text string, lang string, rank long, n long, phrase string"


@pytest.mark.parametrize("bits", [1, 2, 7, 20, 21, 22, 31, 42])
def test_permutation_loses_nothing(bits):
    rng = np.random.default_rng(bits)
    most = (1 << bits) - 1
    grams = [np.concatenate((rng.integers(0, most + 1, 5000), [0, most, most])) for _ in range(3)]
    left, right = quotient.permute(*grams, bits)
    h = quotient.half_bits(bits)
    assert int(left.max()) < 1 << h and int(right.max()) < 1 << h
    assert all((a == b).all() for a, b in zip(quotient.restore(left, right, bits), grams, strict=True))
    different = len(set(zip(*(g.tolist() for g in grams), strict=True)))
    assert len(set(zip(left.tolist(), right.tolist(), strict=True))) == different


@pytest.mark.parametrize("bits", [3, 12, 22, 30])
@pytest.mark.parametrize("held", [0, 3])
def test_filters_count_and_merge(bits, held):
    rng = np.random.default_rng(bits)
    total, merged = Counter(), {}
    for _ in range(6):
        grams = [rng.integers(0, min(1 << bits, 12), 3000) for _ in range(3)]
        total.update(zip(*(g.tolist() for g in grams), strict=True))
        for f in quotient.filters(*quotient.permute(*grams, bits), bits, held):
            f = quotient.Filter.read(f.body())
            merged.setdefault(f.cell, []).append(f)
    got = Counter()
    for cell, parts in merged.items():
        one = parts[0].merge(*parts[1:]) if len(parts) > 1 else parts[0]
        assert one.cell == cell and int(one.runs.sum()) == len(one.counts) == len(one.low)
        for *g, n in zip(*(x.tolist() for x in quotient.restore(*one.numbers(), bits)), one.counts.tolist(), strict=True):
            assert tuple(g) not in got
            got[tuple(g)] = n
    assert got == total


def test_no_numbers():
    none = np.zeros(0, np.int64)
    assert list(quotient.filters(*quotient.permute(none, none, none, 9), 9, 2)) == []


def brute(rows, least, best):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    able = {p: x for p, x in f.items() if len(p[1]) > 1 and x >= least}
    longest = Counter()
    for (lang, p), x in able.items():
        if len(p) == 3:
            for q in (p[:2], p[1:]):
                longest[lang, q] = max(longest[lang, q], x)
    out = {}
    for (lang, p), a in able.items():
        if 100 * longest.get((lang, p), 0) >= 50 * a:
            continue
        cuts = [(int(Fraction(10**6 * a * a, f[lang, p[:k]] * f[lang, p[k:]])), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:best], 1))


def mined(df, least, best):
    return sorted(tuple(r) for r in collocation.mine(df, least, best).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["Ä", "É", "ZZ", "zz"]

    def text():
        return "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " ", " ", "\r\n"])
                       for _ in range(rng.randint(0, 120)))

    rows = [(rng.choice([None, k]), rng.choice([None, ""]) if k % 9 == 0 else text(),
             rng.choice([None, "und", "en", "en", "en"]), 0, 0, "") for k in range(120)]
    rows += [(500, "one two three four " * 40, "en", 0, 0, ""), (500, "one two three four " * 40, "en", 0, 0, "")]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    for best in (7, 2000):
        want = brute([r[1:3] for r in rows], 10, best)
        assert want and mined(df, 10, best) == want


def test_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mined(empty, 10, 2000) == []
    rare = spark.createDataFrame([(1, "a b c", "en", 0, 0, ""), (2, None, None, 0, 0, "")], DOCS)
    assert mined(rare, 10, 2000) == []
    long = spark.createDataFrame([(1, "a b " * 60_000, "en", 0, 0, ""), (2, "x" * 100_000, None, 0, 0, "")], DOCS)
    assert mined(long, 10, 2000) == brute([("a b " * 60_000, "en")], 10, 2000)


def test_large_counts_are_exact(spark):
    """Products past 64 bits."""
    a, left, right = 3_037_000_499_123, 3_037_000_500_001, 9_037_000_500_017
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    from pyspark.sql import functions as F
    assert row.select(collocation._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (left * right)


def test_tasks_give_memory_back(spark, monkeypatch):
    frame = type(spark.range(0))
    steps, plain = [], frame.mapInArrow

    def recorded(self, func, *args, **kwargs):
        steps.append(func.__qualname__)
        return plain(self, func, *args, **kwargs)

    monkeypatch.setattr(frame, "mapInArrow", recorded)
    docs = spark.createDataFrame([(k, "one two three", "en") for k in range(12)], "doc_id long, text string, lang string")
    assert [r.phrase for r in collocation.mine(docs).collect()] == ["one two three"]
    assert len(steps) == 4 and all(s.startswith("lean.") for s in steps)
