"""The filter audit against brute force over rows, and on edge cases."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest

from marginlib.llm import filter_audit, lexicon

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, shard long, n_words long"
LABELS = "doc_id long, quality int, toxic int"
LONG = "wort " * 300_000
EDGE = [(1, None, "s", 1, 1), (2, "", None, 2, 2), (3, LONG, "s", 3, 3), (4, "A b", "", 4, 4), (4, "A b", "", 4, 4),
        (None, "A b", "s", 5, 5), (6, "\n \t\x0b", "s", None, None), (7, "# x", "s", 1, 1), (None, "#", "s", 1, 1),
        (None, "#", "s", 1, 1), (9, "é ü é ü " * 60, "t", 1, 1)]


def brute(docs, labels):
    """{(part, order, step): counts} from (doc_id, text, source) and (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    rows = []
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": (t in first) if i is None else i > first[t]}
        rows.append((source or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        share = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                share[f] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(f in r[1] for r in gone),
                    sum(r[1] == {f} for r in rows if r[0] == part), sum(r[2] for r in removed), sum(r[3] for r in removed)]
                gone += removed
        for (p, order, step), v in out.items():
            if p == part:
                v.append(share[order[step - 1]])
    return out


def audited(docs, labels):
    rows = filter_audit.audit(docs, labels).collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                              r.shapley] for r in rows}
    assert len(out) == len(rows)
    return out


def test_edge_rows(spark):
    labels = [(1, 1, 0), (1, 0, 1), (7, None, 1), (None, 1, 1), (3, 1, None), (99, 1, 1)]
    want = brute([r[:3] for r in EDGE], labels)
    assert audited(spark.createDataFrame(EDGE, DOCS), spark.createDataFrame(labels, LABELS)) == want


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).count() == 0
    assert audited(spark.createDataFrame(EDGE, DOCS), labels) == brute([r[:3] for r in EDGE], [])


def test_large_group_of_copies(spark):
    rows = [(k, "same text" if k % 3 else f"text {k}", f"s{k % 2}", 0, 0) for k in range(900)]
    assert audited(spark.createDataFrame(rows, DOCS).repartition(7), spark.createDataFrame([], LABELS)) == brute(
        [r[:3] for r in rows], [])


def test_matrix(spark):
    """Rows of the matrix hold the words of the documents, under one number in all shards."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows, documents = {}, {}
    for r in filter_audit.matrix(docs).collect():
        indptr, columns, counts = filter_audit.arrays(r.indptr, r.columns, r.counts)
        assert len(indptr) == len(r.rows) + 1
        for row, a, b in zip(r.rows, indptr, indptr[1:], strict=False):
            rows[row.doc_id] = dict(zip(columns[a:b].tolist(), counts[a:b].tolist(), strict=True))
            for c in columns[a:b].tolist():
                documents.setdefault(c, set()).add(row.doc_id)
    words = {}
    for i, t in texts.items():
        own = Counter(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        assert sorted(own.values()) == sorted(rows[i].values())
        for w in own:
            words.setdefault(w, set()).add(i)
    assert len(words) == len(documents)
    assert Counter(map(frozenset, words.values())) == Counter(map(frozenset, documents.values()))


def test_packs():
    arrays = [np.arange(5), np.zeros(0, np.uint8), np.array([1, 70_000], np.uint32)]
    back = lexicon.unpack(lexicon.pack(*arrays))
    assert all(a.dtype == b.dtype and (a == b).all() for a, b in zip(arrays, back, strict=True))


@pytest.mark.parametrize("size", [1, 3, 10_000])
def test_cuts(spark, monkeypatch, size):
    import pyarrow as pa
    monkeypatch.setattr(lexicon, "SHARD_BYTES", size)
    batch = pa.record_batch([pa.array(["ab", None, "", "abcdef", "x" * 50, "y"])], ["text"])
    parts = list(lexicon.cuts(batch))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert list(lexicon.cuts(batch.slice(0, 0))) == []
