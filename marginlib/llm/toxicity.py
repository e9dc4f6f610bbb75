"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

Features of a text are densities of two learned lexicons (words and word
beginnings that are typical of toxic texts), how near they stand to
second-person words, and rates of capitals, punctuation and obfuscation.  Labelled
texts are parted by a hash of doc_id: held-out rows teach nothing; of the
others one part teaches lexicon and trees, the other calibrates.  Labels are read
for these parts only; lang, source and doc_id are no features.

Training uses at most about ``TRAIN_ROWS`` labelled rows for each part, chosen
by hash; all labelled rows if there are fewer.  Scoring is one narrow pass over
the texts and a join-free model application.

Defined results: a null text counts as empty and has a score like any other;
labels without a document, or null ones, are ignored; a document with several
label rows takes the largest; repeated documents are scored each; without both
labels in the training rows every score is the share of toxic labels (0 if there
are none); a row without doc_id is scored and has held_out null; an empty table
gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlib.llm.common import map_batches, stored, texts

TRAIN_ROWS = 20_000         # labelled rows that teach lexicon and trees, and as many that calibrate
LEXICON = 400               # terms of a lexicon
STEMS = (4, 5, 6)           # lengths of word beginnings that may enter it
THRESHOLD = 0.7

# Second-person words.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os".split())
# Characters that stand for letters.
LEET = str.maketrans("013457@$!", "oieastasi")

_WORD = re.compile(r"\w+")
_ODD = re.compile(r"[^\W\d_]+[\d@$*!#]+[^\W\d_]+")
FEATURES = ("strong_density", "strong_count", "strong_kinds", "weak_density", "near_you", "you_density",
            "capitals", "shouted", "punctuation", "exclaims", "obfuscated", "leet_hits", "log_words")


def part_of(doc_id: Column) -> Column:
    """0: teaches, 1: held out, 2: calibrates."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)).cast("int")


class Lexicon:
    """Terms with a tier: 2 strong, 1 weak.  A term that ends in * is a beginning."""

    def __init__(self, tiers: dict[str, int]):
        self.tiers = tiers
        self.known: dict[str, int] = {}

    def tier(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            found = max([self.tiers.get(word, 0), *(self.tiers.get(word[:k] + "*", 0) for k in STEMS)])
            if len(self.known) >= 500_000:
                self.known.clear()
            self.known[word] = found
        return found


def measure(text: str, lexicon: Lexicon) -> list[float]:
    low = text.lower()
    words = _WORD.findall(low)
    n = max(1, len(words))
    tier = lexicon.tier
    tiers = [tier(w) for w in words]
    strong = [i for i, t in enumerate(tiers) if t == 2]
    weak = tiers.count(1)
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near = 0
    if strong and you:
        at = np.searchsorted(you, strong)
        you_at = np.array([-1000, *you, 10**9])
        near = int(((np.array(strong) - you_at[at] <= 5) | (you_at[at + 1] - np.array(strong) <= 5)).sum())
    odd = _ODD.findall(low)
    letters = max(1, sum(map(len, words)))
    capitals = len(text) - len(text.translate(_NO_CAPITALS))
    exclaims = text.count("!") + text.count("?")
    marks = exclaims + text.count(".") + text.count(",") + text.count("*") + text.count("#")
    return [100 * len(strong) / n, float(np.log1p(len(strong))), float(len({words[i] for i in strong})),
            100 * weak / n, 100 * near / n, 100 * len(you) / n, capitals / letters,
            float(text.isupper()), marks / n, exclaims / n, 100 * len(odd) / n,
            float(sum(tier(w.translate(LEET)) == 2 for w in odd)), float(np.log1p(len(words)))]


_NO_CAPITALS = {c: None for c in [*range(65, 91), *range(0xC0, 0xDF)]}


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, part) of labelled rows that may teach."""
    teach = (labels.where("doc_id is not null and toxic is not null")
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .withColumn("part", part_of(F.col("doc_id"))).where("part != 1"))
    sizes = dict(teach.groupBy("part").count().collect())
    picked = F.lit(False)
    for part, size in sizes.items():
        share = min(1.0, TRAIN_ROWS / size)
        spot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("teach")), F.lit(1_000_000))
        picked = picked | ((F.col("part") == part) & (spot < int(share * 1_000_000)))
    # About 2 * TRAIN_ROWS rows of two numbers, whatever the input: texts stay where they are.
    return docs.join(F.broadcast(teach.where(picked)), "doc_id").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic", "part")


def learn_lexicon(taught: DataFrame) -> dict[str, int]:
    """Terms of toxic texts: strong where nine of ten texts that hold one are
    toxic, weak where it makes toxicity three times likelier.

    ``taught`` has text and toxic; a term counts once a text.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, toxic = [], []
            for text, label in zip(texts(batch), batch.column(1).to_pylist(), strict=True):
                own = set(_WORD.findall(text.lower()))
                own |= {w[:k] + "*" for w in own for k in STEMS if len(w) >= k}
                terms.extend(own)
                toxic.extend([label] * len(own))
            yield pa.record_batch([pa.array(terms, pa.string()), pa.array(toxic, pa.int32())], ["term", "toxic"])

    totals = taught.agg(F.sum("toxic"), F.count("*")).first()
    if not totals[0] or totals[0] == totals[1]:
        return {}
    base = totals[0] / totals[1]
    counted = (taught.select("text", "toxic").mapInArrow(count, "term string, toxic int")
               .groupBy("term").agg(F.sum("toxic").alias("hits"), F.count("*").alias("texts"))
               .where("hits >= 5").withColumn("share", F.col("hits") / F.col("texts")))

    def best(rows: DataFrame, tier: int) -> dict[str, int]:
        top = rows.orderBy(F.desc("hits"), "term").limit(LEXICON)   # a lexicon of bounded size
        return {r.term: tier for r in top.collect()}

    strong = best(counted.where("share >= 0.9"), 2)
    weak = best(counted.where((F.col("share") < 0.9) & (F.col("share") >= min(0.85, 3 * base))), 1)
    return weak | strong


def features(docs: DataFrame, lexicon: dict[str, int], *extra: str) -> DataFrame:
    """doc_id, further columns (named with their type), and the features of each text."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)
    names = [e.split()[0] for e in extra]

    def make():
        own = Lexicon(sent.value)

        def each(batch: pa.RecordBatch):
            rows = [measure(t, own) for t in texts(batch)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(FEATURES)
            return [batch.column(0), *(batch.column(2 + i) for i in range(len(names))), *columns]
        return each

    schema = ", ".join(["doc_id long", *extra, *(f"{f} double" for f in FEATURES)])
    return map_batches(docs.select("doc_id", "text", *names), make, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    docs = docs.select("doc_id", "text")
    taught = stored(_labelled(docs, labels))
    lexicon = learn_lexicon(taught.where("part = 0"))
    known = stored(features(taught, lexicon, "toxic int", "part int"))
    rows = features(docs, lexicon)
    counts = {tuple(r[:2]): r[2] for r in known.groupBy("part", "toxic").count().collect()}
    out = [F.col("doc_id"), (part_of(F.col("doc_id")) == 1).alias("held_out")]
    if not (counts.get((0, 0)) and counts.get((0, 1))):
        all_rows = sum(counts.values())
        share = sum(v for (_, toxic), v in counts.items() if toxic == 1) / all_rows if all_rows else 0.0
        return rows.select(*out, F.lit(share).alias("score"), F.lit(int(share >= THRESHOLD)).alias("predicted"))

    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
    trees = GBTClassifier(featuresCol="vector", labelCol="toxic", maxIter=15, maxDepth=3, stepSize=0.3,
                          subsamplingRate=1.0, seed=7)
    model = trees.fit(vector.transform(known.where("part = 0")))

    def raw(rows: DataFrame) -> DataFrame:
        scored = model.transform(vector.transform(rows))
        return scored.withColumn("raw", vector_to_array("probability")[1])

    calibrate = raw(known.where("part = 2"))
    # One weighted point for each of 10,001 scores, whatever the number of rows.
    points = (calibrate.groupBy(F.round("raw", 4).alias("raw"))
              .agg(F.avg("toxic").alias("label"), F.count("*").cast("double").alias("weight")))
    scored = raw(rows)
    score = F.col("raw")
    if counts.get((2, 0)) and counts.get((2, 1)):
        curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight",
                                   predictionCol="calibrated").fit(points)
        scored = curve.transform(scored.drop("prediction"))
        # The share of the raw score parts documents that the steps of the curve join.
        score = 0.999 * F.col("calibrated") + 0.001 * F.col("raw")
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))
    return scored.withColumn("score", score).select(
        *out, "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
