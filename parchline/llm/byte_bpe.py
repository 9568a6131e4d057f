"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string there is exactly one token that can stand last in its encoding:
the token that ends there, fits the last token of the prefix before it, and leaves a valid pair.
The table of these last tokens is built from left to right; reading it from the end backwards gives
the encoding. Because no entry depends on what follows, bytes are appended exactly by carrying the
table on, and after an edit only the entries from the edit up to the place where old and new
entries agree again are worked out anew.

Two tokens are a valid pair if no merge across their border is due before the merges inside them
are done. The two spines along the border are walked upwards together in the order of the ranks.

Texts are split by the tokenizer's pattern first; each piece is encoded separately. Pieces repeat
a lot, so a task keeps the ids of up to twice ``KEPT_PIECES`` short ones.

Defined results: null and empty texts have no ids; every byte sequence has an encoding because
all single bytes are tokens. Rows are answered one by one; ids and other columns are only carried.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from . import words as W

KEPT_PIECES = 1 << 17
KEPT_PAIRS = 1 << 18
#: Longer pieces are not kept.
KEPT_LENGTH = 64

_NEVER = 1 << 60
STORE = "byte bpe"


class Vocabulary:
    """Tokens by rank, the two parts that each is merged from, and its parent merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.longest = max(map(len, ranks))
        #: Last three bytes of tokens to the length of the longest token that ends in them.
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            if len(token) > 2:
                self.reach[token[-3:]] = max(len(token), self.reach.get(token[-3:], 0))
        self.parts: dict[int, tuple[int, int]] = {}
        self.merges: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                self.parts[rank] = pair = self._last_merge(token, rank)
                self.merges[pair] = rank
        self.kept_pairs: dict[int, bool] = {}

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens left over when all merges before this token's own are done."""
        pieces = [self.ranks[token[i : i + 1]] for i in range(len(token))]
        while len(pieces) > 2:
            due = [self.merges.get(p, _NEVER) for p in zip(pieces, pieces[1:])]
            best = min(due)
            if best >= rank:
                raise ValueError(f"token {rank} is not reached by merges")
            i = due.index(best)
            pieces[i : i + 2] = [best]
        return pieces[0], pieces[1]

    def fits(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes together is just these two tokens."""
        known = self.kept_pairs.get(left << 32 | right)
        if known is None:
            if len(self.kept_pairs) > KEPT_PAIRS:
                self.kept_pairs.clear()
            known = self.kept_pairs[left << 32 | right] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        # Spines along the border from the whole token down to one byte, then walked upwards.
        lefts, rights = [left], [right]
        while lefts[-1] in self.parts:
            lefts.append(self.parts[lefts[-1]][1])
        while rights[-1] in self.parts:
            rights.append(self.parts[rights[-1]][0])
        while True:
            x, y = lefts.pop(), rights.pop()
            grow_left = lefts[-1] if lefts else _NEVER
            grow_right = rights[-1] if rights else _NEVER
            across = self.merges.get((x, y), _NEVER)
            # Of equal merges the one further left comes first: one inside the left token wins a
            # tie, one inside the right token loses it.
            if across < grow_left and across <= grow_right and across < _NEVER:
                return False
            if grow_left == grow_right == _NEVER:
                return True
            if grow_left <= grow_right:
                rights.append(y)
            else:
                lefts.append(x)


class Prefixes:
    """The last token of every prefix of a byte string, open to appending and editing."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _entry(self, data: bytes, end: int, last: list[int]) -> int:
        known = self.vocabulary
        ranks, valid = known.ranks, known.kept_pairs
        for start in range(max(0, end - known.longest), end):
            token = ranks.get(data[start:end])
            if token is None:
                continue
            if not start:
                return token
            pair = (last[start - 1], token)
            fits = valid.get(pair)
            if fits or fits is None and known.fits(*pair):
                return token
        raise ValueError("a byte is not in the vocabulary")

    def append(self, more: bytes) -> None:
        data, last, known = self.data + more, self.last, self.vocabulary
        token_at, valid, fits = known.ranks.get, known.kept_pairs.get, known.fits
        reach = known.reach.get
        for end in range(len(self.data) + 1, len(data) + 1):
            low = end - reach(data[end - 3 : end], 2) if end > 2 else 0
            for start in range(low if low > 0 else 0, end):
                token = token_at(data[start:end])
                if token is None:
                    continue
                if start:
                    before = last[start - 1]
                    if not (valid(before << 32 | token) or fits(before, token)):
                        continue
                last.append(token)
                break
            else:
                raise ValueError("a byte is not in the vocabulary")
        self.data = data

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replace data[start:end]; returns how many entries had to be worked out anew.

        Entries before the edit stay. Behind it, an entry is decided by the bytes and entries one
        longest token back; once so many new entries equal the old ones, the rest are the old ones.
        """
        old, tail, longest = self.last, self.data[end:], self.vocabulary.longest
        self.last, self.data = old[:start], self.data[:start]
        self.append(new)
        agree = done = 0
        while done < len(tail) and agree < longest:
            self.append(tail[done : done + 1])
            agree = agree + 1 if self.last[-1] == old[end + done] else 0
            done += 1
        self.data += tail[done:]
        self.last += old[end + done :]
        return len(new) + done

    def become(self, data: bytes) -> None:
        """The table of other bytes; what belongs to a common prefix stays."""
        shared = len(commonprefix((self.data, data)))
        self.data = data[:shared]
        del self.last[shared:]
        self.append(data[shared:])

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.tokens[token])
        return out[::-1]


class Encoder:
    """Texts to ids, piece by piece; short pieces are encoded once and kept."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern, self.known = vocabulary, regex.compile(pattern), _Pieces(vocabulary)

    def encode(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, known = [], self.known
        for start in range(0, len(texts), 256):
            split = [self.pattern.findall(t) if t else [] for t in texts[start : start + 256]]
            found = [list(map(known.__getitem__, pieces)) for pieces in split]
            if known.missing:
                fresh = known.learn()
                for i, ids in enumerate(found):
                    if None in ids:
                        found[i] = [fresh[p] if x is None else x for p, x in zip(split[i], ids)]
            out += map(b"".join, found)
        return out


class _Pieces(dict):
    """Ids of pieces. Unknown ones are noted and learned together.

    When full, the store becomes the older half, from which pieces in use come back.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older, self.missing = vocabulary, {}, set()

    def __missing__(self, piece: str) -> bytes | None:
        found = self.older.get(piece)
        if found is None:
            self.missing.add(piece)
        else:
            self[piece] = found
        return found

    def learn(self) -> dict[str, bytes]:
        """Ids of the missing pieces. In order of their bytes, each goes on from the prefix it shares with the last one."""
        fresh, table = {}, Prefixes(self.vocabulary)
        for data, piece in sorted((p.encode("utf-8"), p) for p in self.missing):
            table.become(data)
            ids = table.ids()
            fresh[piece] = struct.pack(f"<{len(ids)}I", *ids)
        self.missing.clear()
        if len(self) + len(fresh) > KEPT_PIECES:
            self.older = dict(self)
            self.clear()
        self.update((p, x) for p, x in fresh.items() if len(p) <= KEPT_LENGTH)
        return fresh


def read_ranks(lines: Iterator[bytes]) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a rank file that each machine has, built once per Python process."""
    loaded = W.process_store(STORE)
    if path not in loaded:
        with open(path, "rb") as lines:
            loaded[path] = Vocabulary(read_ranks(lines))
    return loaded[path]


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python process, so that the tasks of a worker share the kept pieces."""
    made = W.process_store(STORE)
    if (path, pattern) not in made:
        made[path, pattern] = Encoder(vocabulary(path), pattern)
    return made[path, pattern]


def decode(ids: bytes, tokens: list[bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encoded(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None, ids: bool = True) -> DataFrame:
    """``row`` (the kept columns), n_tokens, ids_sha256, decoded_sha256 and, on request, the ids.

    ``path`` names a rank file that every executor's Python environment holds.
    """
    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ids

    def make():
        known, own = vocabulary(path), encoder(path, pattern)

        def work(texts: list) -> list[pa.Array]:
            found = own.encode(texts)
            back = [hashlib.sha256(decode(x, known.tokens)).hexdigest() for x in found]
            arrays = [
                pa.array([len(x) // 4 for x in found], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in found], pa.string()),
                pa.array(back, pa.string()),
            ]
            return arrays + [pa.array(found, pa.binary())] * ids

        return work

    return W.per_text(W.with_text(docs, keep), make, fields, store=STORE)


def decoded(frame: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Adds ``text`` again from a column of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = vocabulary(path).tokens
        for batch in batches:
            texts = [None if x is None else decode(x, tokens).decode("utf-8") for x in batch.column(ids).to_pylist()]
            yield batch.append_column("text", pa.array(texts, pa.string()))

    schema = T.StructType([*frame.schema.fields, T.StructField("text", T.StringType())])
    return frame.mapInArrow(run, schema)
