r"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong spans are reported wherever they stand: values assigned to a secret's
name (`assign`), access key identifiers (`access`) and long hexadecimal strings
(`hex`).  Weak parts (account names, `account`; mixed strings that may be keys,
`key`; service addresses, `endpoint`) are reported only when complementary
parts lie in the same scope, that is at most ``SCOPE`` characters apart:
an account beside a secret, a key beside an access identifier or an endpoint, an
endpoint beside both.  Parts meet in an interval join over blocks of ``SCOPE``
characters, each of which holds few parts, so that no document, however long
or often copied, forms a large group.

Positions are code points, ends exclusive.  Spark has no function for the
places of all matches: the text between matches (split) and the matches
themselves (regexp_extract_all) alternate, and their lengths add up to places.

Defined results: a null text counts as empty and has no spans; rows are scanned
one by one, equal rows with equal results; an empty table gives an empty result;
`scan` reads doc_id and text only, `redact` passes all other columns on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginlib.llm.common import stored

SCOPE = 200
MARK = "[SECRET]"

# Kinds in their order, with pattern, and the group whose length counts.
KINDS = (
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("account", r"(?i)(username|user|login|account|client_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9_.@-]+)", 2, 3),
    ("key", r"[A-Za-z0-9+/_-]{20,}", 0, 20),
    ("endpoint", r"(?i)(https?|ftp|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x20\x09-\x0D\"'<>]+", 0, 10),
)
STRONG, WEAK = ("assign", "access", "hex"), ("account", "key", "endpoint")
_ORDER = {k: i for i, (k, *_) in enumerate(KINDS)}
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _found(text: Column, kind: str) -> Column:
    """Spans of one kind: leftmost matches that don't overlap, then the length test."""
    _, pattern, group, least = KINDS[_ORDER[kind]]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("before"), whole.alias("whole"),
                         counted.alias("counted"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(state, x):
        start = state["at"] + F.length(x["before"])
        end = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        ok = F.length(x["counted"]) >= least
        if kind == "key":
            for letters in ("[0-9]", "[A-Z]", "[a-z]"):
                ok = ok & x["whole"].rlike(letters)
        span = F.struct(start.alias("start"), F.lit(_ORDER[kind]).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"),
                        F.when(ok, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate(parts, zero, step, lambda state: state["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPANS))


def _free(weak: Column, strong: Column) -> Column:
    """Weak spans that don't overlap a strong one."""
    return F.filter(weak, lambda w: ~F.exists(
        strong, lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))


def _parts(docs: DataFrame, key: list[Column]) -> DataFrame:
    """Key columns, strong spans and weak parts of each row."""
    text = F.coalesce("text", F.lit(""))
    out = docs.select(*key, text.alias("own_text"))
    out = out.select(*[c for c in out.columns if c != "own_text"],
                     *(_found(F.col("own_text"), k).alias(k) for k, *_ in KINDS))
    strong = F.array_sort(F.concat(*STRONG))
    keys = [c for c in out.columns if c not in _ORDER]
    return (out.select(*keys, strong.alias("strong"), F.concat(*WEAK).alias("weak"))
            .withColumn("weak", _free(F.col("weak"), F.col("strong"))))


def _is(kind: Column, *kinds: str) -> Column:
    return kind.isin([_ORDER[k] for k in kinds])


def _linkable(strong: Column, weak: Column) -> Column:
    """Whether a row has parts that can complement each other at all."""
    def some(*kinds):
        return F.exists(F.concat(strong, weak), lambda s: _is(s["kind"], *kinds))
    secret, access = some("assign", "hex", "key"), some("access", "account")
    return (F.size(weak) > 0) & secret & (access | some("endpoint"))


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """(doc_id, digest, weak): the weak parts to report, of rows that have any.

    ``parts`` has doc_id, digest, strong and weak.
    """
    spans = (parts.where(_linkable(F.col("strong"), F.col("weak"))).select("doc_id", "digest", "strong", "weak")
             .distinct().select("doc_id", "digest", F.explode(F.concat("strong", "weak")).alias("s"))
             .select("doc_id", "digest", "s.*"))
    row = ["doc_id", "digest", "start", "kind", "end"]
    weak = spans.where(_is(F.col("kind"), *WEAK)).withColumn("block", F.explode(F.sequence(
        F.floor((F.greatest(F.col("start") - scope, F.lit(0))) / scope),
        F.floor((F.col("end") + scope) / scope))))
    # Of a long span only the ends can be the nearest place to a part in another block.
    other = (spans.withColumnsRenamed({"start": "o_start", "kind": "o_kind", "end": "o_end"})
             .withColumn("block", F.explode(F.sequence(F.floor(F.col("o_start") / scope),
                                                       F.floor((F.col("o_end") - 1) / scope))))
             .withColumnsRenamed({"doc_id": "o_doc", "digest": "o_digest", "block": "o_block"}))
    near = (F.col("o_start") <= F.col("end") + scope) & (F.col("start") <= F.col("o_end") + scope)
    met = weak.join(other, F.col("doc_id").eqNullSafe(F.col("o_doc")) & (F.col("digest") == F.col("o_digest"))
                    & (F.col("block") == F.col("o_block")) & near
                    & ((F.col("o_start") != F.col("start")) | (F.col("o_kind") != F.col("kind"))))
    beside = met.groupBy(*row).agg(
        F.max(_is(F.col("o_kind"), "assign", "hex", "key")).alias("secret"),
        F.max(_is(F.col("o_kind"), "access", "account")).alias("access"),
        F.max(_is(F.col("o_kind"), "endpoint")).alias("endpoint"))
    kind = F.col("kind")
    good = (F.when(_is(kind, "account"), F.col("secret"))
            .when(_is(kind, "key"), F.col("access") | F.col("endpoint"))
            .otherwise(F.col("secret") & F.col("access")))
    return (beside.where(good).groupBy("doc_id", "digest")
            .agg(F.collect_list(F.struct("start", "kind", "end")).alias("reported")))


def _with_reported(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` (doc_id, digest, strong, ...) with all spans, in order."""
    linked = linked.withColumnsRenamed({"doc_id": "l_doc", "digest": "l_digest"})
    joined = rows.join(linked, F.col("doc_id").eqNullSafe(F.col("l_doc"))
                       & (F.col("digest") == F.col("l_digest")), "left")
    none = F.array().cast(_SPANS)
    return (joined.withColumn("spans", F.array_sort(F.concat("strong", F.coalesce("reported", none))))
            .drop("l_doc", "l_digest", "reported"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, strong, spans) of each row: arrays of (start, kind, end), where
    kind is the place in ``KINDS``, ordered by start, then kind."""
    key = [F.col("doc_id"), F.xxhash64("text").alias("digest")]
    parts = stored(_parts(docs.select("doc_id", "text"), key))
    return _with_reported(parts, _linked(parts, scope)).select("doc_id", "strong", "spans")


def written(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*(F.lit(k) for k, *_ in KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def _without(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by a mark."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        new = s["start"] >= state["at"]
        before = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(new, F.concat(state["out"], before, F.lit(MARK)))
                        .otherwise(state["out"]).alias("out"))

    end = F.lit(2**31 - 1)
    joined = F.aggregate(spans, zero, step,
                         lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, end)))
    return F.when(F.size(spans) > 0, joined).otherwise(text)


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with a mark in place of every reported span; n_chars, where there
    is such a column, counts the new text.

    Rows without parts to link keep their place; only the others, which are few,
    are shuffled to meet their linked parts.
    """
    whole = F.struct(*docs.columns).alias("row")
    key = [F.col("doc_id"), F.xxhash64("text").alias("digest"), whole]
    parts = _parts(docs, key)
    linked = stored(_linked(parts.drop("row"), scope))
    linkable = _linkable(F.col("strong"), F.col("weak"))
    alone = parts.where(~linkable).select("row", F.col("strong").alias("spans"))
    rest = _with_reported(parts.where(linkable), linked).select("row", "spans")
    text = _without(F.col("row.text"), F.col("spans"))
    new = {"text": text, "n_chars": F.when(F.size("spans") > 0, F.length(text).cast(dict(docs.dtypes).get("n_chars", "long")))
           .otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return alone.union(rest).select(*(
        (new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
