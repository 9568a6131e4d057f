"""Document fingerprints by locally consistent parsing, for texts and for edited copies of them.

A text is a sequence of code points, each named by a 64-bit mix of its value. A level is turned into the
next one in three steps:

1. runs of one name become one name (of the name and the run's length), so neighbours differ;
2. deterministic coin tossing: a name's label is 2 k + (its bit k), k the lowest bit where it differs from
   its left neighbour; four rounds take 64-bit names to labels below 6, neighbours still different;
3. a phrase starts at every local maximum of the labels (and at the first name); a phrase, two to about a
   dozen names long, is named by a mix of its names and their places.

A phrase boundary depends only on the six names around it, so equal substrings are parsed alike inside,
wherever they stand: they share their interior phrase names at every level. Levels go on until one name is
left. The fingerprint is a bottom-``SKETCH`` sketch: the smallest distinct names of all levels above the code
points (and the last name), as 16 hex digits each, ascending and comma-joined. Likeness of two fingerprints
is the share, among the ``SKETCH`` smallest names of their union, of names in both.

The edited text of a row keeps its first n - floor(n / 3) code points and puts in their place the first
floor(n / 3) (or all) code points of the next row, rows ordered by descending doc_id; the last row's next
is the first. Rows are dealt by range of that order and sorted within each task, so a task finds the next
row of all its rows but the last one in itself; the last row of each task (one per task) meets the first
row of the following task in a table of two rows per task.

Defined results: a null text is empty; an empty text has fingerprint '' and its likeness to an empty one is
1, to any other 0. Ties in doc_id (a null id comes last) are ordered by a 64-bit hash of the text and then
the text; repeated rows are answered each (the next of one copy is the other). A table of one row is its
own next. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Names a fingerprint keeps: the smallest of all phrase names.
SKETCH = 64

#: Characters of text fingerprinted at once.
SLICE_CHARS = 1 << 18

#: Coin-tossing rounds: 64-bit names, then labels below 128, 14, 8 and 6.
ROUNDS = 4

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)
_RUN, _PLACE, _SIZE = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x2545F4914F6CDD1D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        z = x + _A
        z ^= z >> np.uint64(30)
        z *= _B
        z ^= z >> np.uint64(27)
        z *= _C
        z ^= z >> np.uint64(31)
        return z


def _lowest_bit(d: np.ndarray) -> np.ndarray:
    """Index of the lowest set bit of each (non-zero) value."""
    return np.bitwise_count((d & (~d + np.uint64(1))) - np.uint64(1)).astype(np.uint64)


def _coin(names: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Labels of names (below 128 for 64 bits), each against its left neighbour, which differs."""
    differs = names ^ left
    lowest = differs & (~differs + np.uint64(1))
    found = np.bitwise_count(lowest - np.uint64(1)) << 1
    found |= (names & lowest) != 0
    return found


#: Labels of labels below 128, by label and left neighbour (equal ones never meet).
_LABELS = _coin(np.arange(128, dtype=np.uint64)[:, None], np.arange(128, dtype=np.uint64)).ravel()

#: Names of a text that are looked at for its sketch first: about so many times ``SKETCH`` of the smallest.
LOOKED_AT = 2.5


def labels(names: np.ndarray) -> np.ndarray:
    lab = names
    for _ in range(ROUNDS):
        left = np.concatenate((~lab[:1], lab[:-1]))
        k = _lowest_bit(lab ^ left)
        lab = np.uint64(2) * k + ((lab >> k) & np.uint64(1))
    return lab.astype(np.int64)


def phrase_names(text: str) -> tuple[list[np.ndarray], int | None]:
    """Names of all levels above the code points, and the last name (None for an empty text)."""
    if not text:
        return [], None
    seq = mix(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64))
    found = []
    while True:
        starts = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1])))
        sizes = np.diff(np.append(starts, len(seq))).astype(np.uint64)
        seq = seq[starts]
        runs = sizes > 1
        if runs.any():
            seq = np.where(runs, mix(seq ^ mix(sizes * _RUN)), seq)
            found.append(seq[runs])
        if len(seq) == 1:
            return found, int(seq[0])
        lab = labels(seq)
        left = np.concatenate(([-1], lab[:-1]))
        right = np.concatenate((lab[1:], [-1]))
        first = (lab > left) & (lab > right)
        first[0] = True
        heads = np.flatnonzero(first)
        block = np.cumsum(first) - 1
        place = (np.arange(len(seq)) - heads[block]).astype(np.uint64)
        summed = np.add.reduceat(mix(seq ^ mix(place * _PLACE)), heads)
        size = np.diff(np.append(heads, len(seq))).astype(np.uint64)
        seq = mix(summed ^ (size * _SIZE))
        found.append(seq)


def _sketch_text(names: np.ndarray) -> str:
    return names.astype(">u8").tobytes().hex(",", 8)


def _runs(seq: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Starts of the runs of equal values within texts, which of them are longer than one, and these lengths."""
    opens = np.empty(len(seq), bool)
    np.not_equal(seq[1:], seq[:-1], out=opens[1:])
    opens[bounds[:-1]] = True
    if opens.all():
        return None
    starts = np.flatnonzero(opens)
    sizes = np.diff(np.append(starts, len(seq)))
    long = np.flatnonzero(sizes > 1)
    return starts, long, sizes[long].astype(np.uint64)


def _phrases(seq: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Heads and sizes of the phrases of names, and each name's place in its phrase."""
    first, last = bounds[:-1], bounds[1:] - 1
    lab = np.empty(len(seq), np.uint8)
    lab[1:] = _coin(seq[1:], seq[:-1])
    # A text's first name is tossed against its complement: its label is its lowest bit, in all rounds.
    lab[first] = tossed = (seq[first] & np.uint64(1)).astype(np.uint8)
    for _ in range(ROUNDS - 1):
        pairs = lab.astype(np.intp)
        pairs[1:] <<= 7
        pairs[1:] |= lab[:-1]
        lab = _LABELS[pairs]
        lab[first] = tossed
    head = np.empty(len(lab), bool)
    head[1:] = lab[1:] > lab[:-1]
    rises = head[last]  # a text's last name has nothing to its right
    head[:-1] &= lab[:-1] > lab[1:]
    head[last], head[first] = rises, True
    heads = np.flatnonzero(head)
    sizes = np.diff(np.append(heads, len(lab)))
    return heads, sizes, np.arange(len(lab)) - np.repeat(heads, sizes)


class _Level:
    """Names of one level of many texts in one array; ``docs`` are the texts, ``bounds`` where each starts (and the end)."""

    def __init__(self, seq: np.ndarray, docs: np.ndarray, bounds: np.ndarray):
        self.seq, self.docs, self.bounds = seq, docs, bounds

    def of(self, where: np.ndarray) -> np.ndarray:
        """The texts of some places."""
        return self.docs[np.searchsorted(self.bounds, where, "right") - 1]

    def without(self, lone: np.ndarray, at: np.ndarray) -> None:
        """Leave out texts of one name each, which stand at these places."""
        kept = np.flatnonzero(~lone)
        lengths = np.diff(self.bounds)[kept]
        self.docs, self.bounds = self.docs[kept], np.append(0, np.cumsum(lengths))
        self.seq = np.delete(self.seq, at)


def _levels(codes: np.ndarray, docs: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(texts, names) of all levels: runs' names, phrases' names and last names, as in ``phrase_names``."""
    level = _Level(mix(codes.astype(np.uint64)), docs, bounds)
    while len(level.seq):
        if found := _runs(level.seq, level.bounds):
            starts, long, sizes = found
            level.seq, level.bounds = level.seq[starts], np.searchsorted(starts, level.bounds)
            level.seq[long] = mix(level.seq[long] ^ mix(sizes * _RUN))
            yield level.of(long), level.seq[long]
        lone = np.diff(level.bounds) == 1
        if lone.any():  # a text with one name left is done; that name is its last
            at = level.bounds[:-1][lone]
            yield level.docs[lone], level.seq[at]
            level.without(lone, at)
            if not len(level.seq):
                return
        heads, sizes, places = _phrases(level.seq, level.bounds)
        placed = mix(np.arange(sizes.max(), dtype=np.uint64) * _PLACE)
        summed = np.add.reduceat(mix(level.seq ^ placed[places]), heads)
        level.seq, level.bounds = mix(summed ^ (sizes.astype(np.uint64) * _SIZE)), np.searchsorted(heads, level.bounds)
        yield np.repeat(level.docs, np.diff(level.bounds)), level.seq


def _smallest(docs: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``SKETCH`` smallest distinct names of each text, ascending by text and name."""
    order = np.lexsort((names, docs))
    docs, names = docs[order], names[order]
    fresh = np.concatenate(([True], (docs[1:] != docs[:-1]) | (names[1:] != names[:-1])))
    docs, names = docs[fresh], names[fresh]
    begin = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
    rank = np.arange(len(docs)) - np.repeat(begin, np.diff(np.append(begin, len(docs))))
    return docs[rank < SKETCH], names[rank < SKETCH]


def fingerprints_of(texts: list[str | None]) -> list[str]:
    """``fingerprint`` of many texts at once: all texts' names of one level are one array.

    Each text is parsed exactly as alone: runs, coin-tossing neighbours and phrase boundaries stop at
    the edges of texts, and a text leaves when one name is left. Equal to ``fingerprint`` text by text.
    Names are spread evenly, so only those below a bound are sorted; a text with too few distinct names
    there has all of its names sorted.
    """
    plain = [t or "" for t in texts]
    out = [""] * len(plain)
    lengths = np.array([len(t) for t in plain], dtype=np.int64)
    some = np.flatnonzero(lengths)
    if not len(some):
        return out
    codes = np.frombuffer("".join(plain).encode("utf-32-le"), dtype=np.uint32)
    parts = list(_levels(codes, some, np.append(0, np.cumsum(lengths[some]))))
    docs, names = (np.concatenate(p) for p in zip(*parts))
    counts = np.bincount(docs, minlength=len(plain))
    bound = np.full(len(plain), np.iinfo(np.uint64).max)
    many = counts > LOOKED_AT * SKETCH
    bound[many] = (LOOKED_AT * SKETCH / counts[many] * 2.0**64).astype(np.uint64)
    low = np.flatnonzero(names <= bound[docs])
    found = [_smallest(docs[low], names[low])] if len(low) else []
    short = many.copy()
    if found:
        short &= np.bincount(found[0][0], minlength=len(plain)) < SKETCH
    if short.any():
        again = np.flatnonzero(short[docs])
        found.append(_smallest(docs[again], names[again]))
    for docs, names in found:
        bounds = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
        for lo, hi in zip(bounds.tolist(), np.append(bounds[1:], len(docs)).tolist()):
            out[int(docs[lo])] = _sketch_text(names[lo:hi])
    return out


def fingerprint(text: str | None) -> str:
    found, last = phrase_names(text or "")
    if last is None:
        return ""
    names = np.unique(np.concatenate([*found, np.array([last], dtype=np.uint64)]))[:SKETCH]
    return _sketch_text(names)


def likeness(a: str | None, b: str | None) -> float:
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    x, y = set(a.split(",")), set(b.split(","))
    both = x & y
    if not both:
        return 0.0
    union = sorted(x | y)[:SKETCH]
    return len(both.intersection(union)) / len(union)


def edited(text: str, following: str) -> str:
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, _tie long, _last boolean"
)
EDGES = "_side int, doc_id long, _tie long, text string, fp string"
ACROSS = RESULT.replace(", _last boolean", "")


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _prints(texts: list[str]) -> list[str]:
    """Fingerprints of texts, ``SLICE_CHARS`` characters at a time (a longer text alone)."""
    out, first, size = [], 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE_CHARS or i == len(texts) - 1:
            out += fingerprints_of(texts[first : i + 1])
            first, size = i + 1, 0
    return out


def _answers(rows: list[tuple], following: list[str], next_prints: list[str]) -> list[dict]:
    """rows: (doc_id, tie, text, fingerprint); each with the text and fingerprint of its next row."""
    changed = [edited(r[2], f) for r, f in zip(rows, following)]
    changed_prints = _prints(changed)
    return [
        {
            "doc_id": r[0],
            "n_chars": len(r[2]),
            "edited_sha256": hashlib.sha256(c.encode("utf-8")).hexdigest(),
            "fingerprint": r[3],
            "edited_fingerprint": cp,
            "near_edited": likeness(r[3], cp),
            "near_next": likeness(r[3], np_),
            "_tie": r[1],
        }
        for r, c, cp, np_ in zip(rows, changed, changed_prints, next_prints)
    ]


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task in order: all but the last are answered; the last is marked for the edge table."""
    schema, held = _schema(RESULT), []
    for batch in batches:
        ids, ties, texts = (batch.column(c).to_pylist() for c in ("doc_id", "_tie", "text"))
        texts = [t or "" for t in texts]
        rows = held + list(zip(ids, ties, texts, _prints(texts)))
        done, held = rows[:-1], rows[-1:]
        if done:
            answered = _answers(done, [r[2] for r in rows[1:]], [r[3] for r in rows[1:]])
            yield pa.RecordBatch.from_pylist([a | {"_last": False} for a in answered], schema)
    if held:
        (doc_id, tie, text, own), = held
        last = {"doc_id": doc_id, "n_chars": len(text), "fingerprint": own, "_tie": tie, "_last": True}
        yield pa.RecordBatch.from_pylist([last], schema)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first (side 0) and last (side 1) row of a task, with texts; the first with its fingerprint."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            rows = batch.select(["doc_id", "_tie", "text"])
            first = first or rows.slice(0, 1).to_pylist()[0]
            last = rows.slice(batch.num_rows - 1, 1).to_pylist()[0]
    if first is None:
        return
    out = [first | {"_side": 0, "fp": fingerprint(first["text"])}, last | {"_side": 1, "fp": None}]
    yield pa.RecordBatch.from_pylist(out, _schema(EDGES))


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _schema(ACROSS)
    for batch in batches:
        ids, ties, texts, following, next_prints = (
            batch.column(c).to_pylist() for c in ("doc_id", "_tie", "text", "next_text", "next_fp")
        )
        texts = [t or "" for t in texts]
        rows = list(zip(ids, ties, texts, _prints(texts)))
        if rows:
            yield pa.RecordBatch.from_pylist(_answers(rows, [f or "" for f in following], next_prints), schema)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row."""
    spark = docs.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("_tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("_tie"), F.col("text")]
    # Ranges are cut on (doc_id, tie) only, so the sample sent to the driver holds no texts; rows equal in
    # both stay in one task, where the text orders them.
    dealt = rows.repartitionByRange(width, *order[:2]).sortWithinPartitions(*order)
    inside = dealt.mapInArrow(_within, RESULT)
    # Edges: two rows per task; the next of a task's last row is the first row of the task after it.
    edges = dealt.mapInArrow(_edges, EDGES)
    ordered = Window.orderBy(F.col("doc_id").desc_nulls_last(), "_tie", "text", "_side")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    linked = edges.select(
        "*",
        F.lead("text").over(ordered).alias("_nt"),
        F.lead("fp").over(ordered).alias("_nf"),
        F.first("text").over(everything).alias("_ft"),
        F.first("fp").over(everything).alias("_ff"),
    ).filter(F.col("_side") == 1)
    lasts = linked.select(
        "doc_id", "_tie", "text", F.coalesce("_nt", "_ft").alias("next_text"), F.coalesce("_nf", "_ff").alias("next_fp")
    )
    across = lasts.mapInArrow(_across, ACROSS)
    done = inside.filter(~F.col("_last")).drop("_last")
    return done.unionByName(across).drop("_tie")
