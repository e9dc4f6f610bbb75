"""Quality rules, line first.

Every line of a text is judged by itself (punctuation, navigation and
boilerplate rules); failing lines are removed; a document that loses too much
of its text with them is rejected.  A few whole-text counts (repeated word
windows, length) reject a document before its lines are looked at.

Defined results: a null text counts as empty; an empty text has no words and is
rejected; rows are judged one by one, so repeated rows give repeated results;
an empty table gives an empty table; extra columns are not read by `judge` and
are passed on unchanged by `clean`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from marginlib.llm.common import lean, map_batches, slices, texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"

# Phrases of site boilerplate, lower case.
BOILERPLATE = (
    "all rights reserved",
    "accept cookies",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "sign up for our newsletter",
    "skip to content",
    "terms of service",
    "terms of use",
)


@dataclass(frozen=True)
class Rules:
    """Thresholds; shares are percentages, as integers, so that they are exact."""

    min_words: int = 20             # fewer words reject a text
    window: int = 8                 # words in a window that may not repeat
    max_repeat_pct: int = 30        # words in repeated windows
    symbol_pct: int = 30            # a line's symbols in 100 words: over this it fails
    separators: int = 3             # menu separators that make a line navigation
    separator_pct: int = 20         # ... and their share of its words
    exclaim_pct: int = 30           # words that end in an exclamation or question mark
    shout_words: int = 5            # a line of so many words in capitals only fails
    boilerplate_words: int = 25     # longest line that one phrase makes boilerplate
    distinct_words: int = 20        # a line of so many words ...
    distinct_pct: int = 20          # ... needs this share of different ones
    max_lost_pct: int = 30          # words lost with failing lines: over this rejects


def repeated_words(words: list[bytes], k: int) -> int:
    """Words that lie in a k-word window which the text holds twice or more.

    Exact: windows are ranked by doubling (ranks of 1, 2, 4, ... words), no
    hashing.
    """
    n = len(words)
    if n <= k:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    if len(seen) == n:
        return 0
    size = 1
    while size < k:
        step = min(size, k - size)
        pair = rank[: len(rank) - step] * n + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        size += step
    twice = np.bincount(rank)[rank] > 1
    if not twice.any():
        return 0
    at = np.flatnonzero(twice)
    edge = np.bincount(at, minlength=n + 1) - np.bincount(at + k, minlength=n + 1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def line_fails(line: str, raw: bytes, words: list[bytes], rules: Rules) -> bool:
    """One line's verdict; a line without words never fails."""
    n = len(words)
    if not n:
        return False
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    if 100 * symbols > rules.symbol_pct * n and symbols >= rules.separators:
        return True
    bars = raw.count(b"|") + raw.count("»".encode()) + raw.count("·".encode())
    if bars >= rules.separators and 100 * bars > rules.separator_pct * n:
        return True
    if raw.count(b"!") + raw.count(b"?") >= rules.separators:
        marks = sum(w.endswith((b"!", b"?")) for w in words)
        if marks >= rules.separators and 100 * marks > rules.exclaim_pct * n:
            return True
    if n >= rules.shout_words and line.isupper():
        return True
    if n >= rules.distinct_words and 100 * len(set(words)) < rules.distinct_pct * n:
        return True
    if n <= rules.boilerplate_words:
        low = line.lower()
        return any(p in low for p in BOILERPLATE)
    return False


def measure(text: str, rules: Rules) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, words lost, cleaned text)."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(text) - (len(raw) - len(raw.translate(None, SPACES)))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[str] = set()
    duplicates = lost = 0
    left = []
    for line in text.split("\n"):
        part = line.encode("utf-8", "surrogatepass")
        own = part.split()
        if own:
            duplicates += line in seen
            seen.add(line)
        if line_fails(line, part, own, rules):
            lost += len(own)
        else:
            left.append(line)
    repeated = repeated_words(words, rules.window)
    failed = n < rules.min_words or 100 * repeated > rules.max_repeat_pct * n
    kept = not failed and 100 * lost <= rules.max_lost_pct * n and n - lost >= rules.min_words
    return n, chars, symbols, duplicates, repeated, failed, kept, lost, "\n".join(left)


JUDGED = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, n_lost_words long")


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Counts and verdict for each row of ``docs`` (columns doc_id, text).

    One narrow pass, no shuffle: the work splits with the input files and a
    hot source or group of copies changes nothing.
    """
    def make():
        def each(batch: pa.RecordBatch):
            rows = [measure(t, rules)[:8] for t in texts(batch)]
            return [batch.column(0), *(zip(*rows) if rows else [[]] * 8)]
        return each

    return map_batches(docs.select("doc_id", "text"), make, JUDGED)


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` without rejected rows, and without the failing lines of kept
    ones; n_chars, where there is such a column, counts the text that is left."""
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                rows = [measure(t, rules) for t in texts(batch)]
                keep = pa.array([r[6] for r in rows], pa.bool_())
                text = pa.array([r[8] for r in rows], batch.schema.field(at).type)
                batch = batch.set_column(at, batch.schema.field(at), text)
                if "n_chars" in names:
                    i = names.index("n_chars")
                    f = batch.schema.field(i)
                    batch = batch.set_column(i, f, pc.utf8_length(text).cast(f.type))
                yield batch.filter(keep)

    return docs.mapInArrow(lean(run), docs.schema)
