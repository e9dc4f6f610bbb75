r"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Addresses, network addresses, card and phone numbers of known form (``KINDS``) are
found wherever they stand.  They are the seeds of what has another form:

1. Each seed, and each other token that looks like an identifier (four digits or an @),
   is used in lexical patterns: the two words before it; the words around it; and the word before it
   alone, if that ends like a label (``:``, ``=``, ``#``).
2. Patterns and the values used in them form a graph.  A pattern's confidence in a kind is the
   share of its different values, each with its score, that are of the kind; seeds score 1.
3. Patterns of high confidence and enough values score the other values in them (1 minus the product
   of what the patterns leave open), and these scores count for all other patterns, until
   no pattern is new or ``ROUNDS`` are over.
4. Identifiers in the place of a pattern of high confidence are reported (``found_`` and the
   kind of which the pattern is surest).

The work on texts is one pass; the graph holds values and patterns only, summed up before each
shuffle, and a pattern with fewer than ``SUPPORT`` values is left out, as it
can never be sure enough.

Positions are code points, ends exclusive.  A context doesn't reach over the match
of the same kind before or after it.

Defined results: a null text counts as empty and has no spans; rows are scanned one by one, equal rows
with equal results (their values count once in the graph); an empty table gives an empty
result; only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginlib.llm.common import stored

# Kinds in their order, with pattern.  A match may begin only where a run of
# the first part's characters does, or where a match ends, so that a long run
# without a match is read once; repeated groups don't give back what they took.
KINDS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
_T = "[A-Za-z0-9._%+@-]"
_TOKEN = (rf"(?<!{_T})(?:\(?[0-9]{{2,}}+\)?(?:[\x20.-]\(?[0-9]{{2,}}+\)?)++"
          rf"|(?=[A-Za-z._%+-]*[0-9@])[A-Za-z0-9]{_T}{{3,}}[A-Za-z0-9])")
NAMES = tuple(k for k, _ in KINDS) + tuple(f"found_{k}" for k, _ in KINDS)
OTHER = len(KINDS)          # kind of tokens that look like identifiers
CONTEXT = 48                # code points read on each side
SUPPORT = 5                 # different values that a pattern needs
CONFIDENCE = 0.7
ROUNDS = 5
SPAN = "array<struct<start:int,kind:int,end:int>>"
_HIT = "array<struct<start:int,kind:int,end:int,value:string,left:string,right:string>>"


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(sizes: Column) -> Column:
    """For each place of an array of sizes the sum of those before it.

    In blocks of about the root of their number, so that no array grows with each of
    very many steps.
    """
    none = F.array(F.lit(0))

    def sums(values: Column, size) -> Column:
        return F.aggregate(values, none, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + size(x))))

    def blocks(x: Column) -> Column:
        step = F.greatest(F.ceil(F.sqrt(F.size(x))).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(1), F.greatest(F.size(x), F.lit(1)), step),
                           lambda at: sums(F.slice(x, at, step), lambda y: y))

    def moved(b: Column) -> Column:
        heads = F.slice(sums(b, lambda y: F.element_at(y, -1)), 1, F.size(b))
        return F.flatten(F.zip_with(b, heads, lambda y, h: F.transform(F.slice(y, 1, F.size(y) - 1), lambda v: v + h)))

    return _let(sizes, lambda x: _let(blocks(x), moved))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.when(n.between(12, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(F.lit(False))


def _holds(value: Column, kind: int) -> Column:
    """Whether a match of a kind's pattern is one."""
    name = NAMES[kind] if kind < OTHER else ""
    if name == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if name == "card":
        return _luhn(_digits(value))
    if name == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == OTHER:
        return value.contains("@") | (F.length(_digits(value)) >= 4)
    return F.lit(True)


def _hits(text: Column, kind: int) -> Column:
    """Matches of one kind that hold, with their places and contexts."""
    pattern = KINDS[kind][1] if kind < OTHER else _TOKEN

    def hit(x: Column) -> Column:
        start = x["at"] + F.length(x["left"])
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(x["value"])).alias("end"),
                        x["value"].alias("value"), F.substring(x["left"], -CONTEXT, CONTEXT).alias("left"),
                        F.substring(x["right"], 1, CONTEXT).alias("right"))

    def hits(x: Column) -> Column:
        values, between = x["values"], x["between"]
        at = running(F.zip_with(between, values, lambda b, v: F.length(b) + F.coalesce(F.length(v), F.lit(0))))
        rows = F.arrays_zip(values.alias("value"), between.alias("left"), at.alias("at"),
                            F.slice(between, 2, F.size(between)).alias("right"))
        return F.transform(F.filter(rows, lambda r: r["value"].isNotNull() & _holds(r["value"], kind)), hit)

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"),
                     F.split(text, pattern, -1).alias("between"))
    sure = {0: text.contains("@"), 3: text.contains("+")}.get(kind, F.lit(True))
    return F.when(sure & text.rlike(pattern), _let(found, hits)).otherwise(F.array()).cast(_HIT)


def _scanned(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, other) of each row: spans of known form, and tokens that look
    like identifiers."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("t"))
    rows = rows.select("row", "doc_id", *(_hits(F.col("t"), k).alias(f"k{k}") for k in range(OTHER + 1)))
    return rows.select("row", "doc_id", F.array_sort(F.concat(*(f"k{k}" for k in range(OTHER)))).alias("base"),
                       F.col(f"k{OTHER}").alias("other"))


def _alone(spans: DataFrame) -> DataFrame:
    """``spans`` (row, start, kind, end, ...) without identifiers that overlap a known form."""
    known = F.col("kind") < OTHER
    before = Window.partitionBy("row").orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, 0)
    after = (Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind"), F.desc("end"))
             .rowsBetween(Window.unboundedPreceding, 0))
    return (spans.withColumns({"taken": F.max(F.when(known, F.col("end"))).over(before),
                               "next": F.min(F.when(known, F.col("start"))).over(after)})
            .where(known | ((F.coalesce("taken", F.lit(0)) <= F.col("start")) & (F.coalesce("next", "end") >= F.col("end"))))
            .drop("taken", "next"))


def _patterns() -> Column:
    """The patterns of a use (left, right)."""
    def words(side: str) -> Column:
        return F.filter(F.split(F.regexp_replace(F.lower(side), "[0-9]", "0"), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    left, right = words("left"), words("right")
    last, former, following = F.get(left, F.size(left) - 1), F.get(left, F.size(left) - 2), F.get(right, F.lit(0))
    blank = F.lit(" ")
    return F.array_compact(F.array(F.concat(former, blank, last, F.lit(" _")), F.concat(last, F.lit(" _ "), following),
                                   F.when(last.rlike("[:=#]$"), F.concat(last, F.lit(" _")))))


def _graph(scanned: DataFrame) -> DataFrame:
    """(pattern, value, kind, row, start, end): uses of values in patterns with enough values."""
    some = scanned.where((F.size("base") > 0) | (F.size("other") > 0))
    spans = some.select("row", F.explode(F.concat("base", "other")).alias("s")).select("row", "s.*")
    uses = stored(_alone(spans).select("row", "start", "end", "kind", F.lower("value").alias("value"),
                                       F.explode(_patterns()).alias("pattern")))
    able = stored(uses.select("pattern", "value").distinct().groupBy("pattern")
                  .agg(F.count("*").alias("size")).where(F.col("size") >= SUPPORT))
    return stored(uses.join(able, "pattern"))


def _sure(hits: DataFrame) -> DataFrame:
    """(pattern, kind, confidence) of high confidence; ``hits`` has (pattern, size, kind, score, n)."""
    confidence = F.col("score") / (F.col("size") + 1)
    return (hits.groupBy("pattern", "size", "kind").agg(F.sum("score").alias("score"), F.sum("n").alias("n"))
            .where(F.col("n") >= SUPPORT).select("pattern", "kind", confidence.alias("confidence"))
            .where(F.col("confidence") >= CONFIDENCE))


def patterns(uses: DataFrame) -> DataFrame:
    """Patterns of high confidence (pattern, kind, confidence), scored in rounds."""
    edges = stored(uses.select("pattern", "size", "value", "kind").distinct())
    seeds = stored(edges.where(F.col("kind") < OTHER).groupBy("pattern", "size", "kind")
                   .agg(F.count("*").cast("double").alias("score"), F.count("*").alias("n")))
    others = edges.where(F.col("kind") == OTHER).drop("kind")
    sure, known = stored(_sure(seeds)), -1
    for _ in range(ROUNDS):
        count = sure.count()
        if count == known:
            break
        known = count
        values = stored(others.join(sure, "pattern").groupBy("value", "kind")
                        .agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))))).alias("score")))
        more = (others.join(values, "value").groupBy("pattern", "size", "kind")
                .agg(F.sum("score").alias("score"), F.count("*").alias("n")))
        sure = stored(_sure(seeds.unionByName(more)))
    return sure


def _found(uses: DataFrame, sure: DataFrame) -> DataFrame:
    """(row, found): identifiers in the place of a pattern of high confidence."""
    best = F.max_by("kind", F.struct("confidence", -F.col("kind")))
    spans = (uses.where(F.col("kind") == OTHER).select("row", "start", "end", "pattern").join(sure, "pattern")
             .groupBy("row", "start", "end").agg((best + OTHER).alias("kind")))
    return spans.groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).cast(SPAN).alias("found"))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of each row: arrays of (start, kind, end), where kind is
    the place in ``NAMES``, by start, then kind."""
    scanned = stored(_scanned(docs))
    uses = _graph(scanned)
    found = _found(uses, patterns(uses))
    base = F.transform("base", lambda h: F.struct(h["start"], h["kind"], h["end"])).cast(SPAN)
    return (scanned.select("row", "doc_id", base.alias("base")).join(found, "row", "left")
            .select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("found", F.array().cast(SPAN)))).alias("spans")))


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, NAMES))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))
