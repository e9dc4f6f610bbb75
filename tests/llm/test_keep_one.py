"""One row of each group of near copies: by rows, against all pairs."""

import pytest

from marginlib.llm import jaccard

DOCS = "doc_id long, text string, `a.b` long, number long, row string"
BASE = [f"word{k}" for k in range(60)]


def variant(n, at=0):
    """BASE with n words from ``at`` replaced."""
    return " ".join(BASE[:at] + [f"x{k}" for k in range(n)] + BASE[at + n:])


def expected(rows, size=5, pct=80):
    """Kept (doc_id, text), by all pairs of rows."""
    sets = []
    for _, text, *_ in rows:
        w = (text or "").lower().split()
        n = min(size, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= pct * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    kept = {}
    for (doc, text, *_), g in zip(rows, group, strict=True):
        rank = (doc is None, doc or 0)
        if g not in kept or rank < kept[g][0]:
            kept[g] = rank, doc
    return sorted(((doc is None, doc or 0) for _, doc in kept.values()))


def kept(spark, rows):
    out = jaccard.keep_one(spark.createDataFrame(rows, DOCS).repartition(3))
    assert out.columns == ["doc_id", "text", "a.b", "number", "row"]
    return sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())


def row(doc, text):
    return doc, text, 1, 2, "z"


@pytest.mark.parametrize("rows", [
    [row(1, variant(0)), row(2, variant(2)), row(3, variant(30)), row(4, ""), row(5, None), row(6, "a b")],
    # One doc_id with two unlike texts: both stay; the copy of one of them goes.
    [row(1, variant(0)), row(1, "quite another text of some words"), row(2, variant(1))],
    # Equal rows without a doc_id are one; their near copy has one.
    [row(None, variant(0)), row(None, variant(0)), row(7, variant(1, 20)), row(None, "alone here")],
    [row(3, variant(0)), row(3, variant(0)), row(3, ""), row(3, "")],
    [],
])
def test_rows(spark, rows):
    assert kept(spark, rows) == expected(rows)


def test_unlike_text_of_a_repeated_id_is_not_lost(spark):
    rows = [row(1, variant(0)), row(1, "quite another text of some words"), row(2, variant(1))]
    out = jaccard.keep_one(spark.createDataFrame(rows, DOCS))
    assert sorted(r.text for r in out.collect()) == sorted([variant(0), "quite another text of some words"])


def test_shingles_of_a_batch(spark):
    """Sizes and overlaps of the two ways to hash shingles agree."""
    import pyarrow as pa
    texts = [None, "", "a", "a b", variant(0), variant(3), "A  b\tC\nd " * 40, "\x0b", "é É " * 9]
    for size in (1, 3, 5):
        many = jaccard.batch_shingles(pa.array(texts), size)
        single = [jaccard.shingles(t or "", size) for t in texts]
        assert [len(x) for x in many] == [len(x) for x in single]
        for i in range(len(texts)):
            for j in range(i):
                assert len(set(many[i].tolist()) & set(many[j].tolist())) == len(set(single[i].tolist()) & set(single[j].tolist()))
