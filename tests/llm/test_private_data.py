"""Personal data: base spans against `re`, found ones by planted contexts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from marginlib.llm import private_data

DOCS = "doc_id long, text string, spans string, row long, base string"
KINDS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in text.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def base(text):
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(KINDS)
                  for m in re.finditer(p, text or "") if holds(kind, m[0]))


def scanned(spark, texts):
    rows = [(k, t, "x", 1, "y") for k, t in enumerate(texts)]
    return {r.doc_id: ([tuple(s) for s in r.base], [tuple(s) for s in r.spans])
            for r in private_data.scan(spark.createDataFrame(rows, DOCS).repartition(3)).collect()}


def test_base_spans(spark):
    rng = random.Random(5)
    bits = ["a@b.c", "x.y+z@m-1.example.com", "@", ".", "..", "1.2.3.4", "255.255.0.1", "256.1.1.1", "0001.02.3.4", "1",
            "4111 1111 1111 1111", "4111-1111-1111-1111", "5500005555555559", "+1 (523) 555-1055", "+49 ", "+", "12345678",
            " ", "-", "é", "\U0001F600", "\n", "word", "_x", "5", "(", ")", "AKIA1"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", "", " "]) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    texts += [None, "", "a" * 3_000, "7 " * 20_000, "1." * 5_000, "a@b.c_d@e.f", "a@b@c.d", "+" * 5_000, "é" * 300 + "1.2.3.4"]
    got = scanned(spark, texts)
    for k, t in enumerate(texts):
        assert got[k][0] == base(t), t
        assert [s for s in got[k][1] if s[1] < len(KINDS)] == got[k][0]


def test_many_matches(spark):
    text = "a@b.cd " * 30_000
    (own, spans), = scanned(spark, [text]).values()
    assert own == spans == [(7 * k, 0, 7 * k + 6) for k in range(30_000)]


def test_running(spark):
    rows = [(list(range(n)),) for n in (0, 1, 2, 3, 10, 101)]
    df = spark.createDataFrame(rows, "x array<int>").select("x", private_data.running(F.col("x")).alias("r"))
    for r in df.collect():
        assert r.r == [sum(r.x[:k]) for k in range(len(r.x))]


def planted():
    texts = [f"please call me on +1 (523) 555-{k:04d} this week {k}x" for k in range(1000, 1009)]
    texts += ["please call me on 0523 555 7777 this week",          # unseen form in a sure pattern
              "we sold 0523 555 7777 pieces of it",                 # no pattern
              "they dial 0523 555 7777 at night", "it was +1 (523) 555-0001 or so", "it was 4444 or so"]
    texts += [f"user id: bob{k}@mail.example.com wrote" for k in range(8)] + ["user id: bob99999 wrote"]
    return texts


def brute_found(texts):
    """Plain-Python rounds over the same patterns."""
    token = re.compile(private_data._TOKEN.replace("++", "+").replace("}+", "}"))
    uses = []
    for row, t in enumerate(texts):
        known = base(t)
        other = [(m.start(), 4, m.end()) for m in token.finditer(t) if "@" in m[0] or len(re.sub("[^0-9]", "", m[0])) >= 4]
        other = [s for s in other if not any(a < s[2] and s[0] < e for a, _, e in known)]
        for a, kind, e in known + other:
            left = re.sub("[0-9]", "0", t[:a].lower()).split()
            right = re.sub("[0-9]", "0", t[e:].lower()).split()
            names = []
            if len(left) > 1:
                names.append(f"{left[-2]} {left[-1]} _")
            if left and right:
                names.append(f"{left[-1]} _ {right[0]}")
            if left and left[-1][-1] in ":=#":
                names.append(f"{left[-1]} _")
            uses += [(n, t[a:e].lower(), kind, row, a, e) for n in names]
    values = {}
    for n, v, *_ in uses:
        values.setdefault(n, set()).add(v)
    edges = {(n, v, k) for n, v, k, *_ in uses if len(values[n]) >= private_data.SUPPORT}

    def sure(scores):
        out = {}
        for n, vs in values.items():
            for kind in range(4):
                hits = [1 for a, _, k in edges if a == n and k == kind] + [
                    scores[v, kind] for a, v, k in edges if a == n and k == 4 and (v, kind) in scores]
                if len(hits) >= private_data.SUPPORT and sum(hits) / (len(vs) + 1) >= private_data.CONFIDENCE:
                    out[n, kind] = sum(hits) / (len(vs) + 1)
        return out

    now, count = sure({}), -1
    for _ in range(private_data.ROUNDS):
        if len(now) == count:
            break
        count, scores = len(now), {}
        for n, v, k in edges:
            for kind in range(4):
                if k == 4 and (n, kind) in now:
                    scores[v, kind] = 1 - (1 - scores.get((v, kind), 0)) * (1 - min(now[n, kind], 0.999))
        now = sure(scores)
    best = {}
    for n, v, k, row, a, e in uses:
        for kind in range(4):
            if k == 4 and (n, kind) in now:
                best[row, a, e] = max(best.get((row, a, e), (0, 0)), (now[n, kind], -kind))
    return {(row, a, 4 - kind, e) for (row, a, e), (_, kind) in best.items()}


def test_found_by_context(spark):
    texts = planted()
    got = scanned(spark, texts)
    found = {(k, *s) for k, (_, spans) in got.items() for s in spans if s[1] >= 4}
    assert found == brute_found(texts)
    by_row = {k: [texts[k][a:e] for row, a, _, e in found if row == k] for k in got}
    assert by_row[9] == ["0523 555 7777"] and by_row[10] == [] and by_row[11] == []
    assert any(texts[k][a:e] == "bob99999" and private_data.NAMES[kind] == "found_email" for k, a, kind, e in found)


def test_values_carry_scores_to_other_patterns(spark):
    """A pattern that has no seed but the values that a sure pattern has is found in a later round."""
    numbers = [f"0523 555 {k:04d}" for k in range(1000, 1012)]
    texts = [f"call me on +1 (523) 555-{k:04d} now" for k in range(1000, 1080)]
    texts += [f"call me on {x} now" for x in numbers] + [f"our line is {x} always" for x in numbers]
    texts += ["our line is 0523 555 4242 always"]
    got = scanned(spark, texts)
    found = {(k, *s) for k, (_, spans) in got.items() for s in spans if s[1] >= 4}
    assert found == brute_found(texts)
    assert any(k == len(texts) - 1 for k, *_ in found)


@pytest.mark.parametrize("rows", [[], [(1, None, "x", 1, "y"), (1, None, "x", 1, "y"), (None, "a@b.c", None, None, None)]])
def test_edge_tables(spark, rows):
    out = private_data.scan(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    assert {(r.doc_id, len(r.base), len(r.spans)) for r in out} == {(r[0], len(base(r[1])), len(base(r[1]))) for r in rows}


def test_written(spark):
    df = spark.createDataFrame([([(1, 0, 3), (4, 7, 9)],)], f"s {private_data.SPAN}")
    assert df.select(private_data.written(F.col("s"))).first()[0] == "email:1:3,found_phone:4:9"


def test_no_python_in_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.c")], "doc_id long, text string")
    plan = private_data.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
