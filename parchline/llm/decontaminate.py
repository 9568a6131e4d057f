"""Benchmark decontamination by winnowing.

Training and test texts are turned into words; the codes of all k-word runs are computed, and of
each ``w`` consecutive runs the smallest code is kept (the last one among equals). Two texts that
share ``k + w - 1`` words share such a fingerprint, wherever the span lies, so joining the
fingerprints of both sides finds every shared span of that length; each hit is then extended word
by word to its full length, which also removes chance hits of fingerprints.

With windows of ``span`` words, ``k`` and ``w`` are chosen so that ``k + w - 1 = span``: no window is
missed. An item shorter than a window has no such guarantee and is looked up as a whole.

The test side is cut into blocks of at most ``block_words`` words (a longer item is a block of
its own), read partition by partition. A block's fingerprints are what is sent to the tasks, at
most about 60 bytes a word and so 60 MB with the default; the documents meet one block after the
other in a chain of maps without any shuffle. No size changes the result.

Defined results: a null or wordless text has no words and no hits; an item without words
never occurs, repeated items all count; a null item id is left out of the list of ids. Rows
with repeated or null ids are each answered by themselves. Other columns of both inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import words as W

FIELDS = "n_words_{0} bigint, spans_{0} array<struct<first:bigint,last:bigint>>, items_{0} array<string>"


@dataclass
class TestSide:
    """Fingerprints of a block of items, sorted, with the places they come from."""

    span: int
    k: int
    ids: list
    starts: np.ndarray  # item -> first of its words
    codes: np.ndarray  # words of all items, one after the other
    item: np.ndarray  # word -> item
    prints: np.ndarray  # sorted fingerprints
    places: np.ndarray  # fingerprint -> word position
    seen: np.ndarray  # bit table over the low bits of the fingerprints
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # length -> sorted codes and items


def winnowed(codes: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and codes of the fingerprints of one word sequence."""
    runs = W.run_codes(codes, k)
    count = len(runs) - w + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = runs[:count].copy(), np.arange(count)
    for i in range(1, w):
        later = runs[i : i + count]
        better = later <= best
        best = np.where(better, later, best)
        at = np.where(better, np.arange(i, i + count), at)
    keep = np.ones(count, bool)
    keep[1:] = at[1:] != at[:-1]
    return at[keep], best[keep]


def test_side(items: list[tuple], span: int, k: int) -> TestSide:
    known = W.Codes()
    ids, arrays, prints, places, short = [], [], [], [], {}
    offset = 0
    for item_id, text in items:
        codes = known.of(W.alnum_words(text))
        if not len(codes):
            continue
        at, found = winnowed(codes, k, span - k + 1)
        prints.append(found)
        places.append(at + offset)
        if len(codes) < span:
            short.setdefault(len(codes), []).append((int(W.run_codes(codes, len(codes))[0]), len(ids)))
        ids.append(item_id)
        arrays.append(codes)
        offset += len(codes)
    sizes = np.array([len(a) for a in arrays], np.int64)
    prints = np.concatenate([*prints, np.zeros(0, np.uint64)])
    places = np.concatenate([*places, np.zeros(0, np.int64)])
    order = np.argsort(prints, kind="stable")
    seen = np.zeros(1 << 20, bool)
    seen[prints & np.uint64((1 << 20) - 1)] = True
    looked = {}
    for length, pairs in short.items():
        pairs.sort()
        looked[length] = (np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.int64))
    return TestSide(
        span,
        k,
        ids,
        np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
        np.concatenate([*arrays, np.zeros(0, np.uint64)]),
        np.repeat(np.arange(len(sizes)), sizes),
        prints[order],
        places[order],
        seen,
        looked,
    )


def _matches(codes: np.ndarray, sorted_codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (position in codes, position in sorted_codes) with equal values."""
    low = np.searchsorted(sorted_codes, codes, "left")
    high = np.searchsorted(sorted_codes, codes, "right")
    counts = high - low
    left = np.repeat(np.arange(len(codes)), counts)
    right = np.repeat(low, counts) + np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts)
    return left, right


def hits(codes: np.ndarray, test: TestSide) -> tuple[list[tuple[int, int]], set[int]]:
    """Shared spans (first word, word after the last) of one document, and the items they are of."""
    spans, found = set(), set()
    at, prints = winnowed(codes, test.k, test.span - test.k + 1)
    likely = np.flatnonzero(test.seen[prints & np.uint64((1 << 20) - 1)]) if len(prints) else []
    if len(likely):
        left, right = _matches(prints[likely], test.prints)
        done: dict[int, int] = {}  # a diagonal -> the document word up to which it is extended
        for p, q in sorted(zip(at[likely][left].tolist(), test.places[right].tolist())):
            if done.get(q - p, -1) > p:
                continue
            item = test.item[q]
            back = min(p, q - test.starts[item])
            ahead = min(len(codes) - p, test.starts[item + 1] - q)
            same = codes[p - back : p][::-1] == test.codes[q - back : q][::-1]
            before = int(np.argmin(same)) if back and not same.all() else int(back)
            same = codes[p : p + ahead] == test.codes[q : q + ahead]
            after = int(np.argmin(same)) if not same.all() else int(ahead)
            done[q - p] = p + max(after, 1)
            if before + after >= test.span:
                spans.add((p - before, p + after))
                found.add(int(item))
    for length, (wanted, items) in test.short.items():
        left, right = _matches(W.run_codes(codes, length), wanted)
        for p, q in zip(left.tolist(), right.tolist()):
            spans.add((p, p + length))
            found.add(int(items[q]))
    return sorted(spans), found


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, read partition by partition."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        count = len(W.alnum_words(row["text"]))
        if block and size + count > block_words:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += count
    yield block


def shared_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = 10,
    k: int = 5,
    block_words: int = 1_000_000,
    keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (the kept columns), n_words, spans (in words) and items (ids found), row by row."""
    if not 1 <= k <= span:
        raise ValueError("k must be from 1 to span")
    context = docs.sparkSession.sparkContext
    frame = W.with_text(docs, keep)
    blocks = list(map(context.broadcast, (test_side(b, span, k) for b in item_blocks(benchmark, block_words))))
    for number, sent in enumerate(blocks):
        more = number + 1 < len(blocks)
        frame = W.per_text(frame, finder(sent), FIELDS.format(number), keep_text=more)
    if len(blocks) == 1:
        joined = {"spans": F.col("spans_0"), "items": F.col("items_0")}
    else:
        parts = range(len(blocks))
        joined = {
            "spans": F.concat(*[F.col(f"spans_{i}") for i in parts]),
            "items": F.array_sort(F.array_distinct(F.concat(*[F.col(f"items_{i}") for i in parts]))),
        }
    return frame.select("row", F.col("n_words_0").alias("n_words"), *[c.alias(n) for n, c in joined.items()])


def finder(sent):
    """Looks for a block of items in texts; made anew in each task."""

    def make():
        test, known = sent.value, W.Codes()

        def work(texts: list) -> list[pa.Array]:
            counts, spans, items = [], [], []
            for text in texts:
                codes = known.of(W.alnum_words(text))
                where, found = hits(codes, test)
                counts.append(len(codes))
                spans.append([{"first": a, "last": b} for a, b in where])
                items.append(sorted({str(test.ids[i]) for i in found if test.ids[i] is not None}))
            return [
                pa.array(counts, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                pa.array(items, pa.list_(pa.string())),
            ]

        return work

    return make


def _covered(spans):
    """Words inside at least one span: the spans are merged from left to right."""
    ordered = F.array_sort(spans)
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        ordered,
        state,
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["last"] - F.greatest(s["end"], x["first"]))).alias("n"),
            F.greatest(s["end"], x["last"]).alias("end"),
        ),
        lambda s: s["n"],
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    span: int = 10,
    k: int = 5,
    block_words: int = 1_000_000,
    keep: list[str] | None = None,
) -> DataFrame:
    """``row``, n_words, n_hit, n_items, items (ids sorted as strings), spans, contaminated."""
    return shared_spans(docs, benchmark, span, k, block_words, keep).select(
        "row",
        "n_words",
        _covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        "spans",
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents without any window of a test item, with their own columns."""
    return contamination(docs, benchmark, **settings).filter(~F.col("contaminated")).select("row.*")
