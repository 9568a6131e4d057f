"""Words of whole texts, their 64-bit codes, and codes of word runs.

Texts are handled as UTF-8 bytes: ``bytes.lower`` and ``bytes.split`` know ASCII only, which is
exactly the case folding and the white space that the operators ask for.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Distinct words whose codes a task keeps; beyond it the store is emptied and filled again.
KEPT_WORDS = 1 << 18

#: Bytes of text that a task works on at once.
CHUNK_CHARS = 4 << 20

#: Bytes of an Arrow batch handed to a task's Python, unless the session names its own number.
BATCH_BYTES = 4 << 20
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_END = np.uint64(0x94D049BB133111EB)
_BYTE = 0x2545F4914F6CDD1D

#: Bytes whose words ``SpacedCodes`` finds at once, and the longest word whose code it sums up from its bytes.
SPAN_BYTES = 1 << 17
SUMMED_BYTES = 64

#: A-Z become a-z, ASCII letters, digits and everything beyond ASCII stay, the rest becomes space.
ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


class Codes(dict):
    """Word to code, each computed once."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KEPT_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class SpacedCodes:
    """Codes of the lower-cased words between ASCII white space, many texts at once.

    A word's code is the sum of its bytes' numbers, each times a power of an odd base for its place, mixed; the
    sums come from one running sum over the span, brought back to the word's start by the inverse power. Words
    of more than ``SUMMED_BYTES`` bytes are hashed one by one, as such sums are weak for very long ones.
    """

    def __init__(self) -> None:
        base = np.full(SPAN_BYTES, np.uint64(_BYTE))
        back = np.full(SPAN_BYTES, np.uint64(pow(_BYTE, -1, 1 << 64)))
        base[0] = back[0] = 1
        self.up, self.down = np.multiply.accumulate(base), np.multiply.accumulate(back)
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.number = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
        self.number[65:91] = self.number[97:123]
        self.number[self.space] = 0

    def of(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For consecutive texts (null: empty): the codes of all their words, and the words of each."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        if not len(texts):
            return
        _, ends, values = texts.buffers()
        ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + SPAN_BYTES, "right")) - 1)
            held = data[ends[start] : ends[stop]]
            if len(held) > SPAN_BYTES:
                codes = np.concatenate([*self._of_long(held)])
                yield codes, np.array([len(codes)])
            else:
                cuts = ends[start : stop + 1] - ends[start]
                codes, first = self._of_span(held, cuts[:-1])
                yield codes, np.diff(np.searchsorted(first, cuts))
            start = stop

    def _of_long(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """The same for one text, in pieces that end after white space."""
        start = 0
        while start < len(data):
            stop = min(start + SPAN_BYTES, len(data))
            spaces = np.flatnonzero(self.space[data[start:stop]])
            if not len(spaces):  # one word fills the span
                while stop < len(data) and not len(spaces):
                    spaces = stop + np.flatnonzero(self.space[data[stop : stop + SPAN_BYTES]])
                    stop = int(spaces[0]) if len(spaces) else min(stop + SPAN_BYTES, len(data))
                yield np.array([_hashed(data[start:stop])], np.uint64)
            else:
                stop = stop if stop == len(data) else start + int(spaces[-1]) + 1
                yield self._of_span(data[start:stop], np.zeros(1, np.int64))[0]
            start = stop

    def _of_span(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and places of the words; ``starts`` are the places where a text starts."""
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        word, starts = ~self.space[data], starts[starts < len(data)]
        opens, closes = word.copy(), word.copy()
        opens[1:] &= ~word[:-1]
        opens[starts] = word[starts]
        closes[:-1] &= ~word[1:]
        closes[starts[starts > 0] - 1] = word[starts[starts > 0] - 1]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.number[data] * self.up[: len(data)], out=sums[1:])
        codes = mix((sums[last + 1] - sums[first]) * self.down[first])
        for i in np.flatnonzero(last - first >= SUMMED_BYTES).tolist():
            codes[i] = _hashed(data[first[i] : last[i] + 1])
        return codes, first


def _hashed(word: np.ndarray) -> int:
    """The code of a word of more than ``SUMMED_BYTES`` bytes."""
    return xxhash.xxh3_64_intdigest(word.tobytes().lower())


def process_store(name: str) -> dict:
    """A dict that lives in the Python process until another operator asks for its own.

    Functions travel to the tasks by value, so globals of their modules begin anew with each task. A
    process serves many tasks; it holds the store of one operator at a time.
    """
    held = sys.modules.setdefault("_parchline_process", types.ModuleType("_parchline_process"))
    if getattr(held, "operator", None) != name:
        held.operator, held.store = name, {}
    return held.store


def spaced_words(text: str | None) -> list[bytes]:
    """Lower-cased words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words of ASCII letters and digits and of all characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(ALNUM).split() if text else []


def mix(codes: np.ndarray) -> np.ndarray:
    """Spread codes over all 64 bits."""
    codes = (codes ^ (codes >> np.uint64(30))) * _MIX
    codes = (codes ^ (codes >> np.uint64(27))) * _END
    return codes ^ (codes >> np.uint64(31))


def run_codes(codes: np.ndarray, length: int) -> np.ndarray:
    """The code of each run of so many consecutive words."""
    count = len(codes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = codes[:count].copy()
    for i in range(1, length):
        total *= _ODD
        total += codes[i : i + count]
    return mix(total + np.uint64(length))


def with_text(docs: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """The kept columns (all, if none are named) folded into ``row``, beside the whole text.

    Folded columns cannot clash with what an operator adds.
    """
    names = docs.columns if keep is None else keep
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("string").alias("text")
    )


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at BATCH_BYTES in this session.

    By Spark's default a batch has 10,000 rows, or 64 MB. A task holds several copies of one: vectors that double as
    they grow in the JVM, outside its heap, and what Python has read, in memory that it keeps for its next tasks.
    """
    if _BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))


def per_text(frame: DataFrame, make: Callable, fields: str, keep_text: bool = False, extra: Sequence[str] = (), store: str = "") -> DataFrame:
    """Add columns worked out from ``text`` alone, in Arrow batches and without a shuffle.

    ``make()`` runs once in each task and returns a function from a list of texts to one Arrow
    array per field; further lists come from the columns in ``extra``. ``store`` names the process store that
    ``make`` uses. Batches are cut at ``CHUNK_CHARS`` characters, so a task's memory follows the
    longest text and not the number of rows.
    """
    bound_batches(frame.sparkSession)
    kept = [f for f in frame.schema if keep_text or f.name != "text"]
    names = [f.name for f in kept]
    schema = T.StructType(kept + T.StructType.fromDDL(fields).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process_store(store)
        work = make()
        for batch in batches:
            texts = batch.column("text")
            for start, count in chunks(texts):
                part = batch.slice(start, count)
                given = [part.column(n).to_pylist() for n in ["text", *extra]]
                arrays = work(*given)
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + list(arrays), schema.names)

    return frame.mapInArrow(run, schema)


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Consecutive (start, count) of rows with at most CHUNK_CHARS bytes, or one longer row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and size + n > CHUNK_CHARS:
            yield start, i - start
            start, size = i, 0
        size += n
    if len(sizes) > start:
        yield start, len(sizes) - start
