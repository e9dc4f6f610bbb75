"""Token counts by count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton enumerates the vocabulary pieces that end at each
place; dynamic programming carries the best score to that place and the number
of pieces on the way there, never the pieces.  Rules of the tokenizer that are
kept exactly: of equal scores the piece that starts first wins; a character
without a piece of its own is an unknown of the lowest score less 10; unknowns
in a row are one piece, or with byte pieces as many as they have bytes.

White space other than the space is ordinary text.  Spaces become the
vocabulary's mark, and one mark is put in front.  Where no piece holds the mark
behind other characters, text between marks is independent, so that each
distinct word of a worker is counted once; scores must be whole numbers for this,
as their sums are then exact in any order.  Other vocabularies take each text whole.

Defined results: a null text counts as empty; an empty text has no tokens and
score 0; repeated rows and empty tables need no care; extra columns are not
read.
"""

from __future__ import annotations

import functools
import re
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from marginlib.llm.common import map_batches, texts

MARK = "▁"
CACHED = 800_000            # words kept per worker; cleared when full, which costs time only
UNKNOWN_PENALTY = 10.0

_SEGMENTS = re.compile(f"{MARK}+[^{MARK}]*")


class Unigram:
    """Pieces with scores; ``unknown`` is the id of the unknown piece."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int):
        scores = [s for _, s in pieces]
        self.unknown_score = min(scores) - UNKNOWN_PENALTY
        self.unknown = unknown
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        known = {p for p, _ in pieces}
        self.bytes_known = all(f"<0x{b:02X}>" in known for b in range(256))
        inside = re.compile(f"[^{MARK}]{MARK}")
        self.by_word = (MARK in known and all(float(s).is_integer() for s in scores)
                        and not any(inside.search(p) for p in known))
        self.cache: dict[str, tuple[int, float]] = {}

    def best(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best path over a text."""
        n = len(text)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        matches = self.automaton.iter(text)
        last, found = next(matches, (n, None))
        for end in range(1, n + 1):
            top, of, single = None, -1, False
            while last == end - 1:                  # longest first: earliest start
                length, own, i = found
                value = own + score[end - length]
                if top is None or value > top:
                    top, of, start = value, i, end - length
                single |= length == 1
                last, found = next(matches, (n, None))
            if not single:
                value = self.unknown_score + score[end - 1]
                if top is None or value > top:
                    top, of, start = value, self.unknown, end - 1
            score[end], unknown[end] = top, of == self.unknown
            if not unknown[end]:
                count[end] = count[start] + 1
            elif self.bytes_known:
                count[end] = count[start] + len(text[start:end].encode())
            else:
                count[end] = count[start] + (not unknown[start])
        return count[n], score[n]

    def count(self, texts: list[str]) -> list[tuple[int, float]]:
        """(tokens, score) of each text."""
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        if not self.by_word:
            return [self.best(t) for t in marked]
        split = [_SEGMENTS.findall(t) for t in marked]
        words = set(chain.from_iterable(split))
        new = words.difference(self.cache)
        if len(self.cache) + len(new) > CACHED:
            self.cache.clear()
            new = words
        for w in new:
            self.cache[w] = self.best(w)
        out = []
        for parts in split:
            each = [self.cache[w] for w in parts]
            out.append((sum(c for c, _ in each), float(sum(s for _, s in each))))
        for w in new:
            if len(w) > 64:
                del self.cache[w]
        return out


@functools.lru_cache(maxsize=2)
def read_model(path: str) -> Unigram:
    """The pieces and scores of a SentencePiece file, read as a unigram model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]
    return Unigram(pieces, model.unk_id())


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, score) of each row: one narrow pass."""
    def make():
        model = read_model(path)

        def each(batch: pa.RecordBatch):
            found = model.count(texts(batch))
            return [batch.column(0), [c for c, _ in found], [s for _, s in found]]
        return each

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, n_tokens long, score double")
