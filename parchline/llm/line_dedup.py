"""Substring dedup by hashing lines, and the sentences within them.

Every text is cut into units that together are the whole text: a unit ends behind a line end, or
behind a sentence mark and the blanks that follow it. A unit's digest is over its normalised words (ASCII
lower case, single blanks). Every unit with a word has one, whatever its length or script; only units of
blanks (and, for a caller who asks, of fewer than ``min_words`` words) are never removed. Of equal units
anywhere in the corpus the earliest ranked stays, by document id and then position; the others go, and
the documents keep the original offsets of what went.

Repeats inside a document are settled in its own row, so a document sends each digest once. Count and
smallest id per digest are partial sums in the tasks before anything is shuffled. Only digests of more
than one document are joined back; a digest that holds a third of all units is split by the adaptive
skew join, as nothing above the join needs its rows together.

Offsets are code points, ends exclusive. Defined results: null texts stay null and empty ones empty; a text
whose units all go becomes empty; rows without an id rank behind all others and not among
themselves, so their units go only if a row with an id has them; rows that repeat an id are one
document in the ranking and never remove each other's units. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W

#: Words of a unit that can be removed: any.
MIN_WORDS = 1

_ENDS = re.compile(r"[.!?]+[ \t]+|\n")


def units(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the units of a text; together they are the text."""
    start = 0
    for m in _ENDS.finditer(text):
        yield start, m.end()
        start = m.end()
    if start < len(text):
        yield start, len(text)


def digest(unit: str, min_words: int) -> tuple[int, int] | None:
    """128 bits as two numbers; None if the unit has too few words to be removed."""
    words = unit.encode("utf-8", "surrogatepass").lower().split()
    if len(words) < max(min_words, 1):
        return None
    return struct.unpack("<qq", hashlib.blake2b(b" ".join(words), digest_size=16).digest())


def unit_digests(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id and the distinct digests (high, low) of each row's units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for start, count in W.chunks(batch.column("text")):
                out = []
                for doc, text in zip(ids[start : start + count], batch.column("text").slice(start, count).to_pylist()):
                    whole = text or ""
                    found = {digest(whole[a:b], min_words) for a, b in units(whole)}
                    out += [(doc, *x) for x in found if x is not None]
                columns = list(zip(*out)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "high", "low"])

    return _documents(docs).mapInArrow(run, "doc_id bigint, high bigint, low bigint")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, high, low, kept_in: each digest that goes from a document and the document that keeps it."""
    found = unit_digests(docs, min_words)
    first = found.groupBy("high", "low").agg(F.min("doc_id").alias("kept_in"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1 and kept_in is not null").drop("n")
    return found.join(first, ["high", "low"]).filter("doc_id is null or doc_id > kept_in")


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text without repeated units, n_removed, and removed: start and end in the original text
    and the document that keeps the unit."""
    gone = repeats(docs, min_words).groupBy(F.col("doc_id").alias("of"))
    gone = gone.agg(F.collect_list(F.struct("high", "low", "kept_in")).alias("gone"))
    texts = _documents(docs)
    joined = texts.join(gone, F.col("doc_id").eqNullSafe(F.col("of")), "left").select("doc_id", "text", "gone")
    fields = "remaining string, n_removed bigint, removed array<struct<start:bigint,end:bigint,kept_in:bigint>>"
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kept_in", pa.int64())]))

    def make():
        def work(texts: list, gone: list, ids: list) -> list[pa.Array]:
            out = [cut(t, {(x["high"], x["low"]): x["kept_in"] for x in g or ()}, i, min_words) for t, g, i in zip(texts, gone, ids)]
            kept, spans = [k for k, _ in out], [s for _, s in out]
            return [pa.array(kept, pa.string()), pa.array(map(len, spans), pa.int64()), pa.array(spans, span)]

        return work

    found = W.per_text(joined, make, fields, extra=["gone", "doc_id"])
    return found.select("doc_id", F.col("remaining").alias("text"), "n_removed", "removed")


def cut(text: str | None, gone: dict, doc, min_words: int) -> tuple[str | None, list[dict]]:
    """What stays of a text, and the spans that go: digests kept elsewhere and repeats within the text."""
    if not text:
        return text, []
    kept, spans, seen = [], [], set()
    for start, end in units(text):
        found = digest(text[start:end], min_words)
        if found is None or found not in seen and found not in gone:
            kept.append(text[start:end])
        else:
            spans.append({"start": start, "end": end, "kept_in": gone.get(found, doc)})
        seen.add(found)
    return "".join(kept), spans
