"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last of its
encoding.  `PrefixTable` stores that token for each prefix: it is the suffix
token whose left neighbour, the stored last token of the prefix before it,
would stay separate from it (the two-token string encodes to just the two).
Following the stored tokens back from the end gives the encoding; appending
bytes extends the table; after an edit only the entries from the edit to the
point where the old and new tables agree again are computed.

Defined results: a null text counts as empty; an empty text has no tokens
(digests of the empty string); invalid vocabularies (a byte without a token)
raise; rows are encoded one by one, so ties, repeats, empty tables and extra
columns need no care.
"""

from __future__ import annotations

import base64
import functools
import gc
import hashlib
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from marginlib.llm.common import map_batches, texts

CACHED_PIECES = 1_000_000   # per Python worker; when full, those of the present batch stay
CACHED_PAIRS = 2_000_000
CACHED_CHARS = 48           # longer pieces are encoded each time


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Ranks, which double as ids, and the tests that the table needs."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for bytes {missing[:5]}")
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        # The two parts that a token's last merge joins.  Tokens that merging
        # alone doesn't yield have none; they occur only as whole pieces.
        self.halves: dict[int, tuple[int, int]] = {}
        self.reached: dict[bytes, int] = {}
        for data, i in ranks.items():
            parts = [data] if len(data) == 1 else self.merged(data, 2)
            if len(parts) == 2 and data == parts[0] + parts[1]:
                self.halves[i] = (ranks[parts[0]], ranks[parts[1]])
            if len(parts) < 3:
                self.reached[data] = i

    def merged(self, data: bytes, enough: int = 1) -> list[bytes]:
        """Plain merging of short strings: lowest rank first, leftmost first."""
        ranks = self.ranks
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > enough:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens' string encodes to just these two."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._never_joined(left, right)
        return known

    def _never_joined(self, left: int, right: int) -> bool:
        """Run the merges of both tokens backwards.  What touches the boundary
        at some time must not have merged across it before that time ended;
        of equal ranks the left one merges first."""
        until = None
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and (until is None or joined < until):
                return False
            in_left, in_right = self.halves.get(left), self.halves.get(right)
            if in_left is None and in_right is None:
                return True
            if in_right is None or (in_left is not None and left > right):
                until, left = left, in_left[1]
            else:
                until, right = right + 1, in_right[0]


class PrefixTable:
    """The last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []       # last[i]: of the prefix of i + 1 bytes
        self.append(data)

    def _fill(self, stop: int) -> None:
        """Entries up to the prefix of ``stop`` bytes."""
        vocabulary, data, last = self.vocabulary, self.data, self.last
        token_of, known, longest = vocabulary.reached.get, vocabulary.pairs.get, vocabulary.longest
        for end in range(len(last) + 1, stop + 1):
            for start in range(max(0, end - longest), end):
                token = token_of(data[start:end])
                if token is None:
                    continue
                if start:
                    apart = known((last[start - 1], token))
                    if apart is None:
                        apart = vocabulary.stay_apart(last[start - 1], token)
                    if not apart:
                        continue
                last.append(token)
                break
            else:
                raise ValueError("the vocabulary doesn't cover the bytes")

    def append(self, more: bytes) -> None:
        self.data += more
        self._fill(len(self.data))

    def cut(self, length: int) -> None:
        """Keep the first ``length`` bytes."""
        self.data = self.data[:length]
        del self.last[length:]

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace data[start:end]; returns how many entries were computed.

        Entries before the edit stay.  An entry depends on the bytes and
        entries of the ``longest`` places before it, so once that many in a
        row behind the edit equal the old ones, all later ones do.
        """
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[:start]
        same = done = 0
        for stop in range(start + 1, len(self.data) + 1):
            self._fill(stop)
            done += 1
            behind = stop > start + len(new)
            same = same + 1 if behind and self.last[-1] == old[stop - 1 - shift] else 0
            if same >= self.vocabulary.longest:
                self.last.extend(old[stop - shift:])
                break
        return done

    def tokens(self) -> list[int]:
        out, end, size = [], len(self.data), self.vocabulary.bytes_of
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(size[token])
        return out[::-1]


class Encoder:
    """Encodes texts piece by piece, as the pattern splits them.

    What stands between single spaces is encoded once and kept.  The words
    of a batch that are new are taken in sorted order through one prefix
    table: each keeps the entries of the beginning that it shares with the
    word before and appends the rest.
    """

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary(read_ranks(path))
        self.split = regex.compile(pattern).findall
        self.after_space: dict[str, tuple[int, ...] | None] = {}
        self.digits = {i: str(i) for i in self.vocabulary.bytes_of}

    def piece(self, data: bytes) -> list[int]:
        whole = self.vocabulary.ranks.get(data)
        return [whole] if whole is not None else PrefixTable(self.vocabulary, data).tokens()

    def _pieces(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(self.piece(p.encode()) for p in self.split(text)))

    def _learn(self, words: set[str]) -> None:
        """Encode words that follow a space, and keep the results."""
        known = self.after_space
        ends, letters = [], set()
        for w in words:
            if not w or w[0].isspace() or w[-1].isspace():
                known[w] = None                     # pieces may cross the spaces beside it
            elif w.isalpha():                         # one piece, space included
                letters.add(w)
            elif w[-1] in ".,;:!?" and w[:-1].isalpha():
                ends.append(w)                      # two pieces
                if w[:-1] not in known:
                    letters.add(w[:-1])
            else:
                known[w] = self._pieces(" " + w)
        ranks, table = self.vocabulary.ranks, PrefixTable(self.vocabulary)
        for data in sorted(b" " + w.encode() for w in letters):
            whole = ranks.get(data)
            if whole is not None:
                known[data[1:].decode()] = (whole,)
                continue
            old = table.data
            shared = min(len(old), len(data))
            if old[:shared] != data[:shared]:
                shared = next(i for i in range(shared) if old[i] != data[i])
            table.cut(shared)
            table.append(data[shared:])
            known[data[1:].decode()] = tuple(table.tokens())
        for w in ends:
            known[w] = known[w[:-1]] + (ranks[w[-1].encode()],)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text.  A single space between two words always starts
        a piece, so what follows each space can be encoded by itself."""
        known = self.after_space
        parts = [t.split(" ") for t in texts]
        words = set(chain.from_iterable(p[1:] for p in parts))
        new = words.difference(known)
        if len(known) + len(new) > CACHED_PIECES:
            known = self.after_space = {w: known[w] for w in words if w in known}
        self._learn(new)
        out = []
        for text, part in zip(texts, parts, strict=True):
            first = part[0]
            if len(part) > 1 and (not first or first[-1].isspace()):
                out.append(list(self._pieces(text)))
                continue
            ids = list(self._pieces(first))
            try:
                ids.extend(chain.from_iterable(map(known.__getitem__, islice(part, 1, None))))
            except TypeError:                       # None: a piece may cross spaces
                ids = list(self._pieces(text))
            out.append(ids)
        for w in new:
            if len(w) > CACHED_CHARS:
                known.pop(w, None)
        return out

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker, so that its caches outlive a task."""
    return Encoder(path, pattern)


ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, text -> ids and bytes: (doc_id, ids array, decoded binary)."""
    def make():
        enc = encoder(path, pattern)

        def each(batch: pa.RecordBatch):
            ids = enc.encode_all(texts(batch))
            return [batch.column(0), ids, [enc.decode(i) for i in ids]]
        return each

    return map_batches(docs.select("doc_id", "text"), make, "doc_id long, ids array<int>, decoded binary")


def digest_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token counts and digests of each row, without moving the ids.

    One narrow pass; nothing is shuffled or broadcast.  The vocabulary (a file
    of fixed size, installed on every machine) is read once per worker.
    """
    def make():
        enc = encoder(path, pattern)
        gc.freeze()     # the caches hold no cycles; don't walk them again and again

        def each(batch: pa.RecordBatch):
            counts, id_sums, byte_sums = [], [], []
            for ids in enc.encode_all(texts(batch)):
                counts.append(len(ids))
                id_sums.append(hashlib.sha256(",".join(map(enc.digits.__getitem__, ids)).encode()).hexdigest())
                byte_sums.append(hashlib.sha256(enc.decode(ids)).hexdigest())
            return [batch.column(0), counts, id_sums, byte_sums]
        return each

    return map_batches(docs.select("doc_id", "text"), make, ENCODED)
