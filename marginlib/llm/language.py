"""Language of web pages by Bayesian evidence fusion.

Evidence for each language: the likelihood of the page's text under byte
trigram counts of labelled documents; the declared markup language; the address
suffix; and a prior of the page's host.  How far declarations and suffixes are to
be trusted, and the priors, come from grouped counts of what the texts of all
pages say; a host's prior is smoothed by its site's, and that by all pages'.  A
page's own text is taken out of the counts that it meets.

Counts are summed before each shuffle; a host with a third of all pages is a
third of the rows of a join with one row for each host.

Defined results: a null html or url counts as empty; without text, declaration
and address a page gets the commonest language of all pages (ties: the first
by name); repeated rows count each; without labelled documents the result is
empty, as no language is known; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

import html as html_module
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginlib.llm.common import map_batches, stored

CELLS = 1 << 16             # hashed trigrams
SLICES = 16                 # parts in which counts are summed
LANGUAGES_MOST = 300        # more different labels are an error, not a model
TEMPER = 1 / 3              # trigrams overlap, so each counts a third
STRENGTH = 20.0             # pages that a smoothed prior weighs

_HIDDEN = re.compile(r"<!--.*?-->|<(script|style|nav|noscript|template)\b.*?</\1\s*>", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_HTML = re.compile(r"<html\b[^>]*", re.I)
_LANG = re.compile(r"""\blang\s*=\s*["']?\s*([A-Za-z]{2,3})\b""", re.I)
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)")


def shown(html: str) -> str:
    """A page without comments, scripts and the like."""
    return _HIDDEN.sub(" ", html)


def page_text(page: str) -> str:
    """Text of a page as `shown`."""
    return html_module.unescape(_TAG.sub(" ", page))


def declared(page: str) -> str:
    """Language of the html element, wherever it opens in a page as `shown`."""
    for element in _HTML.finditer(page):
        m = _LANG.search(element[0])
        if m:
            return m[1].lower()
    return ""


def host_of(url: str) -> str:
    m = _HOST.match(url.strip())
    return m[1].lower().rstrip(".") if m else ""


def site_of(host: str) -> str:
    return ".".join(host.split(".")[-2:])


def suffix_of(host: str) -> str:
    return host.rsplit(".", 1)[-1]


def trigrams(text: str) -> np.ndarray:
    """Cells of the byte trigrams of a lower-case text, white space as one space."""
    raw = np.frombuffer(" ".join(["", *text.lower().split(), ""]).encode("utf-8", "replace"), np.uint8)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = (raw[:-2].astype(np.uint32) << 16) | (raw[1:-1].astype(np.uint32) << 8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, and the log-likelihood of each cell in each of them, from all
    labelled texts.  What reaches the driver has ``CELLS`` counts a language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in sums:
                    sums[lang] = np.zeros(CELLS, np.int64)
                    if len(sums) > LANGUAGES_MOST:
                        raise ValueError(f"over {LANGUAGES_MOST} languages")
                sums[lang] += np.bincount(trigrams(text), minlength=CELLS)
        step = CELLS // SLICES
        rows = [(k, i, v[i * step:(i + 1) * step].tobytes()) for k, v in sums.items() for i in range(SLICES)]
        if rows:
            yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["lang", "slice", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for lang, k, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[lang, k] = sums.get((lang, k), 0) + np.frombuffer(raw, np.int64)
        for (lang, k), v in sums.items():
            yield pa.record_batch([pa.array([lang]), pa.array([k], pa.int64()), pa.array([v.tobytes()])],
                                  ["lang", "slice", "counts"])

    schema = "lang string, slice long, counts binary"
    parts = (docs.where("lang is not null and text is not null").select(F.lower(F.trim("lang")), "text")
             .mapInArrow(count, schema).repartition(SLICES, "slice").mapInArrow(add, schema).collect())
    names = sorted({r.lang for r in parts})
    if len(names) > LANGUAGES_MOST:
        raise ValueError(f"over {LANGUAGES_MOST} languages")
    counts = np.zeros((len(names), CELLS))
    step = CELLS // SLICES
    for r in parts:
        counts[names.index(r.lang), r.slice * step:(r.slice + 1) * step] = np.frombuffer(r.counts, np.int64)
    smooth = counts + 0.5
    return names, np.log(smooth / smooth.sum(1, keepdims=True)).T if names else counts


def _read(pages: DataFrame, model: np.ndarray) -> DataFrame:
    """Evidence of each page by itself: addresses, declaration, text."""
    sent = pages.sparkSession.sparkContext.broadcast(model.astype(np.float64))

    def make():
        table = sent.value

        def one(url: str, html: str):
            host = host_of(url)
            page = shown(html)
            likelihood = TEMPER * table[trigrams(page_text(page))].sum(0)
            likelihood -= likelihood.max()
            guess = int(likelihood.argmax()) if likelihood.any() else -1
            return host, site_of(host), suffix_of(host), declared(page), likelihood, guess

        def each(batch: pa.RecordBatch):
            rows = [one(u or "", h or "") for u, h in zip(batch.column(1).to_pylist(),
                                                          batch.column(2).to_pylist(), strict=True)]
            return [batch.column(0), *(zip(*rows, strict=True) if rows else [[]] * 6)]
        return each

    return map_batches(pages.select("page_id", "url", "html"), make,
                       "page_id long, host string, site string, suffix string, declared string, "
                       "likelihood array<double>, guess int")


LEVELS = ("host", "site", "suffix", "declared")
RESULT = "page_id long, lang string, probability double, text_lang string, declared string, host string"


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, lang, probability, text_lang, declared, host) of each page."""
    names, model = train(docs)
    if not names:
        return pages.sparkSession.createDataFrame([], RESULT)
    read = stored(_read(pages, model))
    n = len(names)
    count = F.array(*(F.sum((F.col("guess") == i).cast("long")) for i in range(n)))
    joined = read
    for level in LEVELS:        # a row for each host, site, suffix, declaration
        counts = stored(read.groupBy(level).agg(count.alias(f"{level}_counts")))
        joined = joined.join(counts, level)
    every = np.array(read.agg(count.alias("c")).first().c or [0] * n, np.float64)

    def share(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
        return (counts + STRENGTH * below) / (counts.sum(1, keepdims=True) + STRENGTH)

    def make():
        def each(batch: pa.RecordBatch):
            of = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            rows = batch.num_rows
            if not rows:
                return [[]] * 6
            guess = of["guess"].to_numpy()
            own = np.zeros((rows, n))
            own[np.flatnonzero(guess >= 0), guess[guess >= 0]] = 1
            # Without the page itself; what is empty then falls back to the level below.
            counts = {x: np.array(of[f"{x}_counts"].to_pylist(), np.float64) - own for x in LEVELS}
            overall = (every - own + 1) / (every.sum() - own.sum(1, keepdims=True) + n)
            prior = share(counts["host"], share(counts["site"], overall))
            post = np.array(of["likelihood"].to_pylist()) + np.log(prior)
            for x in ("suffix", "declared"):
                stated = np.array([bool(v) for v in of[x].to_pylist()])[:, None]
                post += np.where(stated, np.log(share(counts[x], overall) / overall), 0)
            best = post.argmax(1)
            weight = np.exp(post - post.max(1, keepdims=True))
            return [of["page_id"], [names[i] for i in best], 1 / weight.sum(1),
                    [names[i] if i >= 0 else None for i in guess], of["declared"], of["host"]]
        return each

    return map_batches(joined.select("page_id", "declared", "host", "suffix", "likelihood", "guess",
                                     *(f"{x}_counts" for x in LEVELS)), make, RESULT)
