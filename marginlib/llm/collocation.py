"""Phrase collocations by counting quotient filters.

Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and those
into words; counts are per language.

1. Shards of documents of one language encode their words (`lexicon`).  A bucket's
   task adds up its words' counts, numbers those with ``least`` occurrences in a
   language, and sends numbers back; rarer words are in no phrase that counts.
2. Each shard packs the numbers of its phrases of two and three words into counting
   quotient filters (`quotient`), one for each cell of the number space.
3. The filters of a (language, cell) merge; phrases with ``least`` occurrences leave
   them.  Cells grow in number with the input, and phrases are spread over them
   evenly, so a language with most of the texts or a phrase that is everywhere makes no
   large group.
4. Joins give each phrase the counts of its parts; scores are exact, in decimals.

Defined results: a null text counts as empty; a null lang counts as ``und``; repeated
rows count each; an empty table, or one without frequent phrases, gives no rows; a
language with fewer phrases than asked for gives what it has; doc_id and extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from marginlib.llm import lexicon, quotient
from marginlib.llm.common import lean, stored

LEAST = 10                  # occurrences of a phrase that counts
BEST = 2000                 # phrases of each language
COVERED = 50                # percent of a phrase's occurrences within a longer one that drop it
CELL = 1 << 20              # phrases, about, whose filters are merged at a time

_SHARDS = "shard long, bucket int, lang string, n long, body binary"
_NUMBERS = ("shard long, bucket int, lang string, body binary, "
            "words array<struct<id:bigint,word:string,f:bigint>>")
_GRAMS = "lang string, a long, b long, c long, f long"

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_CLEAN[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 10
_CLEAN[9] = 32


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                           schema=schema)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, and which of them begin a piece."""
    data = _CLEAN[lexicon.joined(texts, b"\n")[0]]
    words, starts = lexicon.split(data, (data == 10) | (data == 32))
    piece = np.searchsorted(np.flatnonzero(data == 10), starts)
    return words, np.diff(piece, prepend=-1) > 0


def shards(docs: DataFrame, buckets: int) -> DataFrame:
    """Shards of texts of one language, with their words still to be numbered."""
    schema = _arrow(_SHARDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for part in (p for batch in batches for p in lexicon.cuts(batch)):
            langs = part.column(0).dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                words, new = _words(part.column(1).filter(pc.equal(langs.indices, k)))
                codes, different, bucket = lexicon.encoded(words, buckets)
                times = np.bincount(codes, minlength=len(different))
                body = lexicon.pack(lexicon.narrow(codes), np.packbits(new))
                yield _batch([(number, -1, lang, len(codes), body),
                              *((number, b, lang, None, packed)
                                for b, packed in lexicon.word_packs(different, bucket, times))], schema)
                number += 1

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(lean(run), _SHARDS)


def _numbered(packs: DataFrame, buckets: int, least: int) -> DataFrame:
    """Numbers of the words of each pack (0: rare), and the words, with counts, of
    each language (rows without a shard)."""
    schema = _arrow(_NUMBERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), group in lexicon.by_key(batches, "bucket"):
            seen: dict[bytes, int] = {}
            langs: dict[str, int] = {}
            own, times = [], []
            for shard, _, lang, body in group:
                data, lengths, counts = lexicon.unpack(body)
                words = lexicon.binaries(data, lengths.astype(np.int64)).to_pylist()
                own.append((shard, lang, np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))))
                times.append((langs.setdefault(lang, len(langs)), counts))
            # Counts of each (language, word).
            spots = np.concatenate([k * len(seen) + at for (k, _), (*_, at) in zip(times, own, strict=True)])
            spot, back = np.unique(spots, return_inverse=True)
            f = np.zeros(len(spot), np.int64)
            np.add.at(f, back, np.concatenate([c.astype(np.int64) for _, c in times]))
            spot, f = spot[f >= least], f[f >= least]
            known = np.unique(spot % len(seen))
            ids = np.zeros(len(seen), np.int64)
            ids[known] = 1 + np.arange(len(known)) * buckets + bucket
            for shard, lang, at in own:
                yield _batch([(shard, bucket, lang, lexicon.pack(lexicon.narrow(ids[at])), None)], schema)
            texts, names = list(seen), list(langs)
            for k, lang in enumerate(names):
                for at, times_ in _slices(spot // len(seen) == k, spot, f):
                    yield _batch([(None, bucket, lang, None, [
                        {"id": i, "word": texts[w].decode(), "f": n} for i, w, n in
                        zip(ids[at % len(seen)].tolist(), (at % len(seen)).tolist(), times_.tolist(), strict=True)])], schema)

    # In the order of shards, so that a task that is run again gives the same numbers.
    return (packs.repartition("bucket").sortWithinPartitions("bucket", "shard").mapInArrow(lean(run), _NUMBERS))


def _slices(mask: np.ndarray, *arrays: np.ndarray, size: int = 1 << 16) -> Iterator[tuple]:
    at = np.flatnonzero(mask)
    for k in range(0, len(at), size):
        yield tuple(x[at[k:k + size]] for x in arrays)


def _phrases(ids: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of two and three numbered words within pieces, as (a, b, c)."""
    two = (ids[:-1] > 0) & (ids[1:] > 0) & ~new[1:]
    three = two[:-1] & two[1:]
    at, more = np.flatnonzero(two), np.flatnonzero(three)
    return (np.concatenate((ids[at], ids[more])), np.concatenate((ids[at + 1], ids[more + 1])),
            np.concatenate((np.zeros(len(at), np.int64), ids[more + 2])))


def _filters(own: DataFrame, numbers: DataFrame, bits: int, held: int) -> DataFrame:
    """(lang, cell, body): the filters of each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in lexicon.by_key(batches, "shard"):
            _, _, lang, body = next(group)                  # bucket -1
            codes, flags = lexicon.unpack(body)
            ids = [lexicon.unpack(b)[0].astype(np.int64) for *_, b in group]
            stream = np.concatenate(ids)[codes] if ids else np.zeros(0, np.int64)
            new = np.unpackbits(flags, count=len(codes)).astype(np.bool_)
            if len(stream) > 1:
                found = quotient.permute(*_phrases(stream, new), bits)
                rows = [(lang, x.cell, x.body()) for x in quotient.filters(*found, bits, held)]
                if rows:
                    yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["lang", "cell", "body"])

    columns = ["shard", "bucket", "lang", "body"]
    return (own.select(*columns).union(numbers.select(*columns)).repartition("shard")
            .sortWithinPartitions("shard", "bucket").mapInArrow(lean(run), "lang string, cell long, body binary"))


def _frequent(filters: DataFrame, bits: int, least: int) -> DataFrame:
    """Phrases with ``least`` occurrences, of the merged filters of each (lang, cell)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (lang, _), group in lexicon.by_key(batches, "lang", "cell"):
            merged, waiting, size = None, [], 0
            for *_, body in group:
                waiting.append(quotient.Filter.read(body))
                size += len(waiting[-1].counts)
                if size > CELL:
                    merged, waiting, size = _merged(merged, waiting), [], 0
            merged = _merged(merged, waiting)
            enough = merged.counts >= least
            left, right = merged.numbers()
            grams = quotient.restore(left[enough], right[enough], bits)
            n = len(grams[0])
            if n:
                yield pa.record_batch([pa.array([lang] * n, pa.string()), *map(pa.array, grams),
                                       pa.array(merged.counts[enough])], ["lang", "a", "b", "c", "f"])

    return (filters.repartition("lang", "cell").sortWithinPartitions("lang", "cell").mapInArrow(lean(run), _GRAMS))


def _merged(first: quotient.Filter | None, others: list[quotient.Filter]) -> quotient.Filter:
    whole = ([first] if first else []) + others
    return whole[0].merge(*whole[1:]) if len(whole) > 1 else whole[0]


def counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, words, phrases): words of each language (lang, n); frequent words (lang, id, word,
    f); frequent phrases of two (c: 0) and three words (lang, a, b, c, f)."""
    buckets = lexicon.bucket_count(docs)
    held = stored(shards(docs, buckets))
    own = held.where("bucket < 0")
    sizes = stored(own.groupBy("lang").agg(F.sum("n").alias("n")).where("n > 0"))
    numbers = stored(_numbered(held.where("bucket >= 0").select("shard", "bucket", "lang", "body"), buckets, least))
    words = stored(numbers.where("shard is null").select("lang", F.explode("words").alias("w")).select("lang", "w.*"))
    most, total = words.agg(F.max("id")).first()[0], sizes.agg(F.sum("n")).first()[0]
    if most is None:
        return sizes, words, docs.sparkSession.createDataFrame([], _GRAMS)
    bits = int(most).bit_length()
    cells = min(quotient.half_bits(bits), max(0, (2 * int(total) // CELL).bit_length()))
    found = _filters(own, numbers.where("shard is not null"), bits, cells)
    return sizes, words, stored(_frequent(found, bits, least))


# -- scores ----------------------------------------------------------------------------------


def _score(a: Column, first: Column, rest: Column) -> Column:
    """floor(1000000 * a * a / (first * rest)), exactly."""
    wide = "decimal(15,0)"
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a.cast(wide) * a.cast(wide)),
                           first.cast(wide) * rest.cast(wide))


def _with_word(rows: DataFrame, words: DataFrame, of: str) -> DataFrame:
    """``rows`` with the word that column ``of`` numbers, and its count."""
    own = words.select("lang", F.col("id").alias(of), F.col("word").alias(f"word_{of}"), F.col("f").alias(f"f_{of}"))
    return rows.join(own, ["lang", of])


def candidates(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases that no longer one covers."""
    two = phrases.where("c = 0").drop("c")
    three = phrases.where("c > 0")
    inside = three.select("lang", "f", F.explode(F.array(F.struct("a", "b"), F.struct(
        F.col("b").alias("a"), F.col("c").alias("b")))).alias("p")).select("lang", "p.*", "f")
    longer = inside.groupBy("lang", "a", "b").agg(F.max("f").alias("longer"))
    left = stored(two.join(longer, ["lang", "a", "b"], "left")
                  .where(F.coalesce(100 * F.col("longer") < COVERED * F.col("f"), F.lit(True))).drop("longer"))
    left = _with_word(_with_word(left, words, "a"), words, "b")
    of_two = left.select("lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("f").alias("a"),
                         F.col("f_a").alias("l"), F.col("f_b").alias("r"))
    of_two = of_two.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    front = two.select("lang", "a", "b", F.col("f").alias("f_ab"))
    back = two.select("lang", F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("f_bc"))
    wide = three.join(front, ["lang", "a", "b"]).join(back, ["lang", "b", "c"])
    for x in "abc":
        wide = _with_word(wide, words, x)
    cuts = [F.struct(_score(F.col("f"), F.col(x), F.col(y)).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r"))
            for k, (x, y) in enumerate((("f_a", "f_bc"), ("f_ab", "f_c")), 1)]
    of_three = wide.select("lang", F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"),
                           F.col("f").alias("a"), F.least(*cuts).alias("cut"))
    return of_two.union(of_three.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def mine(docs: DataFrame, least: int = LEAST, best: int = BEST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language."""
    sizes, words, phrases = counts(docs, least)
    found = stored(candidates(words, phrases))
    total = found.count()
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First the best of parts, then of the language: neither sorts much more than
    # the root of best * total rows at once.
    split = max(1, int((total / best) ** 0.5))
    part = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(split)))
    some = (part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
            .where(F.col("rank") <= best))
    ranked = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("rank") <= best))
    return (ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             "n", "score"))
