"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score(x) = sigmoid(b + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): the sum
of squares gives all pairwise interactions in time linear in the number of features.

Features of a text: its words (lower case, hashed to ``WORD_SLOTS`` slots, weighted by the square
root of their counts, each text scaled to length one), and structure and metadata slots that hold
each one of ten steps of a share or size (shares of upper-case, digit, symbol, repeated words and
lines, equal neighbours among both, line length, length in characters as stored with the row or counted). Language, source, ids
and labels are never features.

The model is fitted on at most ``MAX_SAMPLE`` labelled rows, chosen by a hash of the row's id, over all
slots of each; everything else covers every row and whole texts. The driver holds the sampled rows packed
and opens one step's rows at a time.
Fitting is deterministic: the sample is ordered, and the start values come from a fixed seed.

Defined results: null and empty texts have only structure slots and get a score like any other;
labels other than 0 and 1, and rows whose id is null, are not learned from; without any labelled
row all scores are 0.5. Repeated labels of one id all count. Rows are scored one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from . import words as W

WORD_SLOTS = 1 << 15
STATS = 11
STEPS = 10
SLOTS = WORD_SLOTS + STATS * STEPS
FACTORS = 8
#: Rows that the model is fitted on, at most. A row has at most WORD_SLOTS word slots, packed in at most six bytes each.
MAX_SAMPLE = 8000

_SYMBOL = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'\"-:;()")


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        """Probability of label 1 for one row."""
        v = self.factors[slots] * values[:, None]
        pairs = 0.5 * float(np.sum(v.sum(0) ** 2) - np.sum(v * v))
        raw = self.bias + float(self.linear[slots] @ values) + pairs
        return float(1.0 / (1.0 + np.exp(-np.clip(raw, -40, 40))))


class Slots(dict):
    """Word to slot."""

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = xxhash.xxh3_64_intdigest(word) % WORD_SLOTS
        return slot


def _step(share: float) -> int:
    return int(min(max(share, 0.0), 0.999999) * STEPS)


def structure(text: str, words: list[bytes], n_chars: int | None) -> list[int]:
    """One slot number per statistic."""
    data = text.encode("utf-8", "surrogatepass")
    size, count = max(len(data), 1), max(len(words), 1)
    lines = text.split("\n")
    upper = size - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = size - len(data.translate(None, b"0123456789"))
    symbols = size - len(data.translate(None, _SYMBOL))
    stops = size - len(data.translate(None, b".,"))
    again = sum(map(eq, words, words[1:]))
    runs = sum(map(eq, lines, lines[1:]))
    # Shares of short texts are drawn towards zero.
    steps = [
        _step(upper / (size + 40) * 2),
        _step(digits / (size + 40) * 5),
        _step(symbols / (size + 40) * 5),
        _step(stops / (count + 10)),
        _step((count - len(set(words))) / (count + 10)),
        _step((len(lines) - len(set(lines))) / (len(lines) + 2)),
        _step(np.log2(1 + size / len(lines)) / 16),
        _step(size / (count + 2) / 20),
        _step(np.log2(1 + max(len(text) if n_chars is None else n_chars, 0)) / 24),
        _step(again / (count + 5) * 2),
        _step(runs / (len(lines) + 2) * 2),
    ]
    return [WORD_SLOTS + i * STEPS + s for i, s in enumerate(steps)]


def counted(text: str | None, n_chars: int | None, known: Slots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots in ascending order, their counts, and structure slots of one row."""
    text = text or ""
    if len(known) > W.KEPT_WORDS:
        known.clear()
    words = W.spaced_words(text)
    slots, counts = np.unique(np.fromiter(map(known.__getitem__, words), np.int64, len(words)), return_counts=True)
    return slots, counts, np.array(structure(text, words, n_chars), np.int64)


def weighted(slots: np.ndarray, counts: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All slots of one row and their values."""
    values = np.sqrt(counts)
    values = values / max(float(np.sqrt(values @ values)), 1e-12)
    return np.concatenate([slots, stats]), np.concatenate([values, np.full(len(stats), 1 / np.sqrt(len(stats)))])


def features(text: str | None, n_chars: int | None, known: Slots) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of one row."""
    return weighted(*counted(text, n_chars, known))


def packed(slots: np.ndarray, counts: np.ndarray, stats: np.ndarray) -> bytes:
    """One row: structure slots, steps between word slots, and counts, each byte place by itself."""
    steps = np.diff(slots, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T
    places = counts.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(stats.astype("<u2").tobytes() + steps.tobytes() + places.tobytes(), 1)


def opened(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``packed`` was given."""
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    stats, raw = raw[: 2 * STATS].view("<u2").astype(np.int64), raw[2 * STATS :]
    size = len(raw) // 6
    steps = np.ascontiguousarray(raw[: 2 * size].reshape(2, size).T).view("<u2").reshape(-1)
    counts = np.ascontiguousarray(raw[2 * size :].reshape(4, size).T).view("<u4").reshape(-1)
    return np.cumsum(steps, dtype=np.int64), counts.astype(np.int64), stats


def fit(rows: list[tuple[bytes, int]], passes: int = 8, rate: float = 0.1, batch: int = 32) -> Machine:
    """Adaptive gradient steps on the logistic loss over packed rows and their labels; the rarer class weighs more, by the root of its share."""
    dice = np.random.default_rng(7)
    machine = Machine(0.0, np.zeros(SLOTS), dice.normal(0, 0.05, (SLOTS, FACTORS)))
    positive = sum(y for _, y in rows)
    if not rows:
        machine.factors[:] = 0
        return machine
    shares = {1: positive / len(rows), 0: 1 - positive / len(rows)}
    weight = {y: (2 * max(share, 1e-3)) ** -0.5 for y, share in shares.items()}
    seen_bias, seen_linear, seen_factors = 1.0, np.ones(SLOTS), np.ones((SLOTS, FACTORS))
    for _ in range(passes):
        order = dice.permutation(len(rows))
        for start in range(0, len(order), batch):
            chosen = [(*weighted(*opened(rows[i][0])), rows[i][1]) for i in order[start : start + batch]]
            sizes = [len(s) for s, _, _ in chosen]
            slots = np.concatenate([s for s, _, _ in chosen])
            values = np.concatenate([v for _, v, _ in chosen])[:, None]
            ends = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            part = machine.factors[slots] * values
            sums = np.add.reduceat(part, ends)
            raw = machine.bias + np.add.reduceat(machine.linear[slots] * values[:, 0], ends)
            raw = raw + 0.5 * (np.sum(sums**2, 1) - np.add.reduceat(np.sum(part * part, 1), ends))
            wanted = np.array([y for *_, y in chosen])
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - wanted) * np.array([weight[y] for y in wanted])
            each = np.repeat(error, sizes)[:, None]
            step = each * values * (np.repeat(sums, sizes, 0) - part)
            used, where = np.unique(slots, return_inverse=True)
            by_slot = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[by_slot], np.arange(len(used)))
            g_linear = np.add.reduceat((each * values)[by_slot, 0], cuts) / batch
            g_factors = np.add.reduceat(step[by_slot], cuts) / batch + 1e-4 * machine.factors[used]
            g_bias = float(error.mean())
            seen_bias += g_bias**2 * batch
            seen_linear[used] += g_linear**2 * batch
            seen_factors[used] += g_factors**2 * batch
            machine.bias -= rate * g_bias / seen_bias**0.5
            machine.linear[used] -= rate * 5 * g_linear / np.sqrt(seen_linear[used])
            machine.factors[used] -= rate * g_factors / np.sqrt(seen_factors[used])
    return machine


def _with_chars(docs: DataFrame, keep: list[str] | None) -> DataFrame:
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    names = docs.columns if keep is None else keep
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text").cast("string").alias("text"), n_chars.alias("size")
    )


def held_out(doc_id="doc_id"):
    """Rows that are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> Machine:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    known = (
        labels.filter("doc_id is not null and quality in (0, 1)")
        .filter(~held_out())
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(max_sample)
    )
    # At most max_sample rows of two numbers: a bound by parameter, whatever the tables hold.
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text"), n_chars.alias("size")).join(F.broadcast(known), "doc_id")

    def make():
        slots_of = Slots()

        def work(texts: list, sizes: list) -> list[pa.Array]:
            return [pa.array([packed(*counted(t, n, slots_of)) for t, n in zip(texts, sizes)], pa.binary())]

        return work

    rows = W.per_text(sample, make, "features binary", extra=["size"]).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], r["features"]))
    return fit([(bytes(r["features"]), r["quality"]) for r in rows])


def scored(docs: DataFrame, machine: Machine, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and score, from 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # 2.4 MB, whatever the tables hold

    def make():
        model, slots_of = sent.value, Slots()

        def work(texts: list, sizes: list) -> list[pa.Array]:
            return [pa.array([model.score(*features(t, n, slots_of)) for t, n in zip(texts, sizes)], pa.float64())]

        return work

    return W.per_text(_with_chars(docs, keep), make, "score double", extra=["size"]).drop("size")


def kept_by_quality(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that score at least so much, with their own columns."""
    return scored(docs, train(docs, labels)).filter(F.col("score") >= least).select("row.*")
