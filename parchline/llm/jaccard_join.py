"""N-gram Jaccard join by set-relation skipping, and the groups it links.

A document's set is that of its distinct runs of ``SIZE`` words (its whole word sequence if it has fewer).
Sets x and y link when 100 |x and y| >= 80 |x or y|. Runs are compared by 64-bit codes.

1. Runs are counted over all documents in a table of ``1 << BUCKET_BITS`` hashed counters, which gives every code
   a class; sets are ordered by class and code, rare ones first. Any such order is exact, a good one makes
   the lists short. The classes are what is sent to the tasks, one byte per counter.
2. Equal sets are put together by digest; only the smallest id of each goes on.
3. Linked sets share a code among the first |x| - ceil(0.8 |x|) + 1 of each. These make up the index lists. A
   list is ordered by set size and then position and is passed block by block (a block is the
   entries of one size): blocks whose sizes cannot link are skipped, and within a block everything
   behind the last position from which enough codes can still follow. Entries without a possible partner leave
   the index; each of the others names one possible partner, picked by hash.
4. Every set has a parity bitmap of two to four bits per code. Two bitmaps differ in at most as many bits as the sets
   do in codes, so bitmaps rule out most pairs before any set is read.
5. Each set is compared with at most two of the partners named for it: a number of pairs linear in the sets. The
   links found give first groups; this is done ``TURNS`` times more for partners in other groups. So a group of
   thousands of similar sets never becomes all pairs of its members.
6. Lists are passed for all pairs between different groups. A set takes its answers from
   its closest compared set, its leader: with |leader and q| computed once, |x and q| lies between bounds that
   |x and leader| gives; only pairs that the bounds leave open are compared themselves.
7. Groups joined by all links are the result.

No step drops an entry or stops at a count. Class and position need every set once, in its own task; lists are
streamed in order, so a task holds one list at a time.

Defined results: documents without words have empty sets, link with nothing and are their own
component; a null id has a null component and takes no part; rows that repeat an id are one document in the links
and each is answered. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from ..sources.tables import stored
from . import words as W
from .components import components

SIZE = 5
#: Counters of the frequency table are two to this power; the table of classes takes a byte for each.
BUCKET_BITS = 22
_SLICES = 64
_CLASSES = 255
#: Bits of the filter that keeps unwanted texts from being shuffled: 8 MB, whatever the tables hold.
FILTER_BITS = 1 << 26
#: So many ids are sent to the tasks themselves; of more, the filter is.
FEW_IDS = 1 << 17
#: How often sets are compared with partners in other groups before all remaining pairs are.
TURNS = 2
#: Partners in other groups that an entry names in each turn.
PICKS = 4
#: Lists of up to so many entries are worked on many at once; all their pairs are no more than PICKS for each entry.
SHORT = 2 * PICKS + 1


def shingles(words: np.ndarray, size: int = SIZE) -> np.ndarray:
    """Sorted distinct codes of a document's set."""
    if not len(words):
        return words
    return distinct(W.run_codes(words, min(size, len(words))))


def distinct(codes: np.ndarray) -> np.ndarray:
    """Sorted distinct codes."""
    codes = np.sort(codes)
    return codes[np.append(True, codes[1:] != codes[:-1])] if len(codes) else codes


def shingle_sets(texts: pa.Array, known: W.SpacedCodes, size: int = SIZE) -> Iterator[np.ndarray]:
    """The set of each text, in order; words and runs of many texts are coded at once."""
    for words, counts in known.of(texts):
        runs, start = W.run_codes(words, size), 0
        for n in counts.tolist():
            yield distinct(runs[start : start + n - size + 1]) if n >= size else shingles(words[start : start + n], size)
            start += n


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """Fewest shared codes of a set of n with any set it links with: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def needed(a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray | int:
    """Fewest shared codes of linked sets of a and b: ceil(0.8 / 1.8 (a + b))."""
    return (4 * (a + b) + 8) // 9


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def surveyed(docs: DataFrame, size: int = SIZE, bits: int = BUCKET_BITS) -> DataFrame:
    """One pass: a row per document (doc_id, n, digest), and rows (slice, counts) of each task's counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = W.SpacedCodes(), np.zeros(1 << bits, np.uint32)
        shift, one = np.uint64(64 - bits), np.uint32(1)
        for batch in batches:
            sizes, digests = [], []
            for codes in shingle_sets(batch.column("text"), known, size):
                np.add.at(counts, (codes >> shift).astype(np.int64), one)
                sizes.append(len(codes))
                digests.append(xxhash.xxh3_128_digest(codes.tobytes()))
            none = pa.nulls(len(sizes))
            yield _survey(batch.column("doc_id"), sizes, digests, none.cast(pa.int64()), none.cast(pa.binary()))
        parts = [_squeezed(x) for x in np.split(counts, _SLICES)]
        none = pa.nulls(_SLICES)
        yield _survey(none.cast(pa.int64()), [None] * _SLICES, [None] * _SLICES, range(_SLICES), parts)

    return _documents(docs).mapInArrow(run, "doc_id bigint, n bigint, digest binary, slice bigint, counts binary")


def _survey(ids, sizes, digests, slices, counts) -> pa.RecordBatch:
    given = [(ids, pa.int64()), (sizes, pa.int64()), (digests, pa.binary()), (slices, pa.int64()), (counts, pa.binary())]
    columns = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in given]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "slice", "counts"])


def _squeezed(counts: np.ndarray) -> bytes:
    """Width of a number in one byte, then the numbers in as few bytes each as the largest needs."""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max(initial=0)) < 1 << (8 * w - 1) or w == 8)
    return bytes([width]) + zstandard.compress(counts.astype(f"<u{width}").tobytes(), 1)


def _opened(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data[1:]), f"<u{data[0]}").astype(np.uint64)


def classes(survey: DataFrame) -> np.ndarray:
    """The class of each counter, from 0 for counts that are usual up to 255.

    Counters are added up slice by slice, first in each task that reads them, then in one group for each slice; the
    driver receives ``1 << BUCKET_BITS`` counters, a number that does not depend on the tables.
    """

    def add_read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            for number, part in zip(batch.column("slice").to_pylist(), batch.column("counts")):
                part = _opened(part.as_py())
                total[number] = total[number] + part if number in total else part
        yield pa.RecordBatch.from_arrays(
            [pa.array([*total], pa.int64()), pa.array([_squeezed(x) for x in total.values()], pa.binary())], ["slice", "counts"]
        )

    def add(table: pa.Table) -> pa.Table:
        total = sum(_opened(part.as_py()) for part in table.column("counts"))
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([_squeezed(total)], pa.binary())})

    kind = "slice bigint, counts binary"
    rows = survey.filter("slice is not null").select("slice", "counts")
    rows = rows.mapInArrow(add_read, kind)
    parts = {r["slice"]: r["counts"] for r in rows.groupBy("slice").applyInArrow(add, kind).collect()}
    if not parts:
        return np.zeros(1 << BUCKET_BITS, np.uint8)
    counts = np.concatenate([_opened(parts[i]) for i in range(_SLICES)]).astype(np.float64)
    mean = counts.mean()
    usual = mean + 4 * np.sqrt(mean) + 1
    steps = np.ceil(8 * np.log2(np.maximum(counts, 1) / usual))
    return np.clip(steps, 0, _CLASSES).astype(np.uint8)


def ordered(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Codes by class, then by value; ``codes`` are sorted."""
    bits = len(table).bit_length() - 1
    return codes[np.argsort(table[(codes >> np.uint64(64 - bits)).astype(np.int64)], kind="stable")]


def prefixes(docs: DataFrame, table, size: int = SIZE) -> DataFrame:
    """doc_id, n, digest, the first codes and the parity bitmap of each set that is not empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, own = W.SpacedCodes(), table.value
        for batch in batches:
            out = ([], [], [], [], [])
            for doc, codes in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), known, size)):
                if doc is None or not len(codes):
                    continue
                first = ordered(codes, own)[: len(codes) - least_overlap(len(codes)) + 1]
                digest = xxhash.xxh3_128_digest(codes.tobytes())
                for column, value in zip(out, (doc, len(codes), digest, first.tobytes(), bitmap(codes))):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            names = ["doc_id", "n", "digest", "prefix", "bitmap"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)

    return _documents(docs).mapInArrow(run, "doc_id bigint, n bigint, digest binary, prefix binary, bitmap binary")


def bitmap(codes: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of codes ends in i; two to four bits per code, a power of two."""
    bits = max(64, 1 << (2 * len(codes) - 1).bit_length())
    odd = np.bincount((codes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def fewest_differing(x: bytes, y: bytes) -> int:
    """A lower bound of the codes in which two sets differ. The longer bitmap is folded to the shorter one's size."""
    a, b = (x, y) if len(x) <= len(y) else (y, x)
    first, second, size = int.from_bytes(a, "little"), int.from_bytes(b, "little"), len(b)
    while size > len(a):
        size //= 2
        second = (second >> (8 * size)) ^ (second & ((1 << (8 * size)) - 1))
    return (first ^ second).bit_count()


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per code of a prefix."""
    for batch in batches:
        rows = zip(batch.column("id").to_pylist(), batch.column("n").to_pylist(), batch.column("prefix"))
        held, size = [], 0
        for doc, n, prefix in rows:
            codes = np.frombuffer(prefix.as_py(), np.int64)
            held.append((doc, n, codes))
            size += len(codes)
            if size > 1 << 18:
                yield _flat(held)
                held, size = [], 0
        if held:
            yield _flat(held)


def _flat(held: list) -> pa.RecordBatch:
    sizes = [len(c) for *_, c in held]
    columns = [
        np.concatenate([c for *_, c in held]),
        np.repeat(np.array([n for _, n, _ in held], np.int32), sizes),
        np.concatenate([np.arange(s, dtype=np.int32) for s in sizes]),
        np.repeat(np.array([d for d, *_ in held], np.int64), sizes),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["code", "n", "pos", "id"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list]]:
    """Index lists with at least two entries; rows come ordered by code.

    Lists of up to SHORT entries, by far the most, come many of one length at once: (True, columns of the first
    entries, of the second ones and so on). Others come one by one: (False, columns).
    """
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        code = columns[0]
        if not len(code):
            continue
        cuts = np.flatnonzero(code[1:] != code[:-1]) + 1
        starts = np.concatenate([[0], cuts])
        ends = np.concatenate([cuts, [len(code)]])
        sizes = ends[:-1] - starts[:-1]
        for length in range(2, SHORT + 1):
            if len(at := starts[:-1][sizes == length]):
                yield True, [[c[at + i] for c in columns] for i in range(length)]
        for a, b in zip(starts[:-1][sizes > SHORT].tolist(), ends[:-1][sizes > SHORT].tolist()):
            yield False, [c[a:b] for c in columns]
        held = [c[starts[-1] :].copy() for c in columns]
    if held is not None and len(held[0]) > SHORT:
        yield False, held
    elif held is not None and len(held[0]) > 1:
        yield True, [[c[i : i + 1] for c in held] for i in range(len(held[0]))]


def _two_may_link(n_a: np.ndarray, pos_a: np.ndarray, n_b: np.ndarray, pos_b: np.ndarray) -> np.ndarray:
    """``block_pairs`` for two entries, the smaller set first, of many lists."""
    shared = needed(n_a.astype(np.int64), n_b.astype(np.int64))
    return (4 * n_b.astype(np.int64) <= 5 * n_a) & (n_a - pos_a >= shared) & (n_b - pos_b >= shared)


def _short_pairs(entries: list, groups: bool) -> Iterator[tuple[int, int, np.ndarray]]:
    """Of many lists of one length: two places, and the lists whose entries there may link (and differ in group)."""
    for j in range(1, len(entries)):
        for i in range(j):
            (_, n_a, pos_a, _, *group_a), (_, n_b, pos_b, _, *group_b) = entries[i], entries[j]
            fits = _two_may_link(n_a, pos_a, n_b, pos_b)
            kept = np.flatnonzero(fits & (group_a[0] != group_b[0]) if groups else fits)
            if len(kept):
                yield i, j, kept


def _short_partners(entries: list) -> Iterator[tuple[np.ndarray, ...]]:
    """``_picked`` for many lists of one length: code, n, pos, id and partner of entries with a possible partner."""
    code = entries[0][0]
    partner = [np.full(len(code), -1, np.int64) for _ in entries]
    for number, (i, j, kept) in enumerate(_short_pairs(entries, groups=False)):
        swap = (code[kept] >> (number % 24)) & 1 == 1
        for here, there in ((i, j), (j, i)):
            chosen = kept[(partner[here][kept] < 0) | swap]
            partner[here][chosen] = there
    ids = np.stack([e[3] for e in entries])
    for (code, n, pos, own), place in zip(entries, partner):
        kept = np.flatnonzero(place >= 0)
        if len(kept):
            yield code[kept], n[kept], pos[kept], own[kept], ids[place[kept], kept]


def block_pairs(n: np.ndarray, pos: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Of a list ordered by n and pos: (start, end, start, end) of entries of two blocks that may link.

    The code of the list is taken as the first that both sets share, so at most the codes from it on are
    shared: n - pos of each.
    """
    cuts = np.flatnonzero(n[1:] != n[:-1]) + 1
    starts = np.concatenate([[0], cuts]).tolist()
    ends = [*starts[1:], len(n)]
    sizes = n[starts].tolist()
    for i, a in enumerate(sizes):
        for j in range(i, len(sizes)):
            b = sizes[j]
            if 4 * b > 5 * a:
                break
            shared = needed(a, b)
            end_a = starts[i] + int(np.searchsorted(pos[starts[i] : ends[i]], a - shared, "right"))
            end_b = starts[j] + int(np.searchsorted(pos[starts[j] : ends[j]], b - shared, "right"))
            if end_a > starts[i] and end_b > starts[j] and (i != j or end_a - starts[i] > 1):
                yield starts[i], end_a, starts[j], end_b


def _picked(code: int, n: np.ndarray, pos: np.ndarray, group: np.ndarray | None = None, turn: int = 0) -> np.ndarray:
    """For each entry of a list the place of one possible partner (in another group), or -1.

    The code and the turn decide where in a block an entry looks.
    """
    partner = np.full(len(n), -1, np.int64)
    step = (code ^ (turn * 0x9E3779B9)) & 0x7FFFFFFF
    for number, (a, a_end, b, b_end) in enumerate(block_pairs(n, pos)):
        for start, end, other, other_end in [(a, a_end, b, b_end)] + [(b, b_end, a, a_end)] * (a != b):
            here, width = np.arange(start, end), other_end - other
            for shift in range(1 if group is None else 3):
                # Within one block a shift from 1 to width - 1 never leads back to the entry itself.
                move = 1 + (step + 7 * shift) % max(width - 1, 1) if a == b else (step + here * 5 + 7 * shift) % width
                there = other + (here - other + move) % width
                fits = there != here if group is None else group[there] != group[here]
                fits &= (partner[here] < 0) | ((step >> (number % 24)) & 1 == 1) & (shift == 0)
                partner[here[fits]] = there[fits]
    return partner


def _with_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries that have a possible partner, each with one of them."""
    names = ["code", "n", "pos", "id", "partner"]
    out, size = [], 0
    for short, columns in _lists(batches):
        if short:
            found = list(_short_partners(columns))
        else:
            code, n, pos, ids = columns
            partner = _picked(int(code[0]), n, pos)
            kept = np.flatnonzero(partner >= 0)
            found = [(code[kept], n[kept], pos[kept], ids[kept], ids[partner[kept]])] * bool(len(kept))
        out += found
        size += sum(len(f[0]) for f in found)
        if size > 100_000:
            yield _named(out, names)
            out, size = [], 0
    if out:
        yield _named(out, names)


def partners_between(turn: int):
    """(id, partner) of entries with a possible partner in another group.

    The first turn names all such pairs of the short lists; further turns leave these lists out, as they could only
    name pairs that were compared then.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for short, columns in _lists(batches):
            if short:
                pairs = _short_pairs(columns, groups=True) if turn == 1 else ()
                found = [(columns[i][3][kept], columns[j][3][kept]) for i, j, kept in pairs]
            else:
                code, n, pos, ids, groups = columns
                if (groups == groups[0]).all():
                    continue
                partner = np.concatenate([_picked(int(code[0]), n, pos, groups, PICKS * turn + i) for i in range(PICKS)])
                kept = np.flatnonzero(partner >= 0)
                found = [(ids[kept % len(ids)], ids[partner[kept]])] * bool(len(kept))
            out += found
            size += sum(len(a) for a, _ in found)
            if size > 100_000:
                yield _named(out, ["id", "partner"])
                out, size = [], 0
        if out:
            yield _named(out, ["id", "partner"])

    return run


def _named(out: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names)


def _between_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Possible pairs of entries from different groups, a smaller than b."""
    out, size = [], 0
    for short, columns in _lists(batches):
        if short:
            found = [(columns[i][3][kept], columns[j][3][kept]) for i, j, kept in _short_pairs(columns, groups=True)]
        else:
            _, n, pos, ids, groups = columns
            found = [] if (groups == groups[0]).all() else _pairs_between(n, pos, ids, groups)
        for left, right in found:
            out.append((np.minimum(left, right), np.maximum(left, right)))
            size += len(left)
            if size > 100_000:
                yield _named(out, ["a", "b"])
                out, size = [], 0
    if out:
        yield _named(out, ["a", "b"])


def _pairs_between(n, pos, ids, groups) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for a, a_end, b, b_end in block_pairs(n, pos):
        for i in range(a, a_end):
            low = max(b, i + 1)
            others = low + np.flatnonzero(groups[low:b_end] != groups[i])
            if len(others):
                yield np.full(len(others), ids[i]), ids[others]


def id_filter(ids: DataFrame) -> np.ndarray:
    """A table of FILTER_BITS bits in which the slot of every id is set."""
    part = 1 << 15
    slots = ids.select(F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).alias("slot"))
    parts = slots.groupBy((F.col("slot") / part).cast("int").alias("part")).agg(F.collect_set((F.col("slot") % part).cast("int")).alias("bits"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for bits in batch.column("bits"):
                table = np.zeros(part, np.uint8)
                table[bits.values.to_numpy()] = 1
                packed.append(np.packbits(table).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(packed, pa.binary())], ["part", "packed"])

    whole = np.zeros(FILTER_BITS // 8, np.uint8)
    # One job: read partition by partition, each would be a job of its own. The parts are as large as the table, whatever the ids.
    for row in parts.mapInArrow(pack, "part int, packed binary").collect():
        whole[row["part"] * part // 8 : (row["part"] + 1) * part // 8] = np.frombuffer(row["packed"], np.uint8)
    return whole


def fetched(docs: DataFrame, ids: DataFrame, size: int = SIZE, few: int = FEW_IDS) -> DataFrame:
    """id and the whole set (as bytes) of the documents named.

    Few ids choose the texts in the tasks that read them, and nothing is shuffled. Of many ids, a filter of fixed size
    keeps most other sets out of the shuffle; the join decides. Filter and sets are worked out in one pass: with one
    before the join and one behind it, a task could hold two Python processes.
    """
    named = _documents(docs).filter("doc_id is not null").withColumnRenamed("doc_id", "id")
    kind = "id bigint, codes binary"

    def sets_of(batch: pa.RecordBatch, known: W.SpacedCodes) -> pa.RecordBatch:
        sets = [codes.tobytes() for codes in shingle_sets(batch.column("text"), known, size)]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = W.SpacedCodes()
        for batch in batches:
            yield sets_of(batch, known)

    if ids.count() <= few:
        return named.join(F.broadcast(ids), "id", "left_semi").mapInArrow(run, kind)
    sent = docs.sparkSession.sparkContext.broadcast(id_filter(ids))

    def run_likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = W.SpacedCodes()
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            likely = sent.value[slot >> 3] >> (7 - (slot & 7)) & 1
            yield sets_of(batch.filter(pa.array(likely.astype(bool))), known)

    named = named.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)))
    return named.mapInArrow(run_likely, kind).join(ids, "id", "left_semi")


class Sets:
    """Whole sets that have been read so far; further ones are read when pairs need them."""

    def __init__(self, docs: DataFrame, size: int):
        self.docs, self.size, self.table = docs, size, None

    def holding(self, pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        if self.table is not None:
            ids = ids.join(self.table.select("id"), "id", "left_anti")
        ids = stored(ids, "ids")
        if self.table is None or not ids.isEmpty():
            more = stored(fetched(self.docs, ids, self.size), "sets")
            self.table = more if self.table is None else self.table.union(more)
        return self.table


def possible(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs that their sizes and bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("bitmap_a").to_pylist(), batch.column("bitmap_b").to_pylist(), batch.column("n").to_pylist())
            kept = [9 * fewest_differing(x, y) <= n for x, y, n in rows]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    a = marks.select(F.col("id").alias("a"), F.col("bitmap").alias("bitmap_a"), F.col("n").alias("n_a"))
    b = marks.select(F.col("id").alias("b"), F.col("bitmap").alias("bitmap_b"), F.col("n").alias("n_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "bitmap_a", "bitmap_b", (F.col("n_a") + F.col("n_b")).alias("n"))
    return both.mapInArrow(run, "a bigint, b bigint")


def at_most_two_each(named: DataFrame, marks: DataFrame) -> DataFrame:
    """Of the (id, partner) pairs that may link, two for each id, picked by hash."""
    pairs = named.select(F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b")).filter("a <> b").distinct()
    left = possible(pairs, marks)
    ways = [F.struct(F.col(x).alias("id"), F.col(y).alias("partner")) for x, y in ("ab", "ba")]
    both = left.select(F.inline(F.array(*ways)))
    order = F.xxhash64("id", "partner")
    picked = both.groupBy("id").agg(F.min_by("partner", order).alias("x"), F.max_by("partner", order).alias("y"))
    chosen = picked.select("id", F.explode(F.array("x", "y")).alias("partner"))
    return chosen.select(F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b")).distinct()


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, n_a, n_b and shared (exact) for each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y in zip(batch.column("codes_a"), batch.column("codes_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                found.append((len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))))
            columns = list(zip(*found)) or [()] * 3
            arrays = [batch.column("a"), batch.column("b"), *(pa.array(c, pa.int64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "n_a", "n_b", "shared"])

    a = sets.select(F.col("id").alias("a"), F.col("codes").alias("codes_a"))
    b = sets.select(F.col("id").alias("b"), F.col("codes").alias("codes_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "codes_a", "codes_b")
    return both.mapInArrow(run, "a bigint, b bigint, n_a bigint, n_b bigint, shared bigint")


def linked():
    return F.expr("180 * shared >= 80 * (n_a + n_b)")


def grouped_lists(index: DataFrame, groups: DataFrame) -> DataFrame:
    """The index with the group of each entry, dealt out and ordered by list."""
    grouped = index.join(groups, "id", "left").select("code", "n", "pos", "id", F.coalesce("component", "id").alias("group"))
    return grouped.repartition("code").sortWithinPartitions("code", "n", "pos", "id")


def links_between_groups(index: DataFrame, groups: DataFrame, led: DataFrame, marks: DataFrame, sets: Sets) -> DataFrame:
    """Links (a, b) of sets in different groups, answers taken from leaders where these decide."""
    pairs = grouped_lists(index, groups).mapInArrow(_between_groups, "a bigint, b bigint").distinct()
    pairs = stored(possible(pairs, marks), "pairs")
    both = led.union(led.select("b", "a", "n_b", "n_a", "shared"))
    # The leader closest to each set, and what they share; a set without one leads itself.
    best = both.filter(linked()).groupBy(F.col("a").alias("id")).agg(
        F.max(F.struct("shared", F.col("b").alias("leader"), F.col("n_a").alias("n"), F.col("n_b").alias("leader_n"))).alias("x")
    )
    best = best.select("id", "x.*")
    a = best.select(F.col("id").alias("a"), F.col("leader").alias("lead_a"), (F.col("n") - F.col("shared")).alias("more_a"), (F.col("leader_n") - F.col("shared")).alias("less_a"))
    b = best.select(F.col("id").alias("b"), F.col("leader").alias("lead_b"), (F.col("n") - F.col("shared")).alias("more_b"), (F.col("leader_n") - F.col("shared")).alias("less_b"))
    zero = F.lit(0).cast("long")
    placed = pairs.join(a, "a", "left").join(b, "b", "left").select(
        "a",
        "b",
        F.coalesce("lead_a", "a").alias("lead_a"),
        F.coalesce("lead_b", "b").alias("lead_b"),
        (F.coalesce("more_a", zero) + F.coalesce("more_b", zero)).alias("more"),
        (F.coalesce("less_a", zero) + F.coalesce("less_b", zero)).alias("less"),
    )
    placed = stored(placed, "placed")
    leaders = placed.select(F.least("lead_a", "lead_b").alias("a"), F.greatest("lead_a", "lead_b").alias("b")).distinct()
    answers = overlaps(leaders, sets.holding(leaders)).select(F.col("a").alias("first"), F.col("b").alias("second"), F.col("shared").alias("known"))
    n_a, n_b = marks.select(F.col("id").alias("a"), F.col("n").alias("n_a")), marks.select(F.col("id").alias("b"), F.col("n").alias("n_b"))
    bounded = (
        placed.withColumn("first", F.least("lead_a", "lead_b"))
        .withColumn("second", F.greatest("lead_a", "lead_b"))
        .join(answers, ["first", "second"])
        .join(n_a, "a")
        .join(n_b, "b")
    )
    sure = F.expr("180 * (known - less) >= 80 * (n_a + n_b)")
    open_to = F.expr("180 * (known + more) >= 80 * (n_a + n_b)")
    bounded = stored(bounded.select("a", "b", sure.alias("sure"), open_to.alias("possible")), "bounded")
    open_pairs = bounded.filter("possible and not sure").select("a", "b")
    compared = overlaps(open_pairs, sets.holding(open_pairs)).filter(linked())
    return bounded.filter("sure").select("a", "b").union(compared.select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    W.bound_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    survey = stored(surveyed(docs, size), "survey")
    table = context.broadcast(classes(survey))
    sets = prefixes(docs, table, size).groupBy("digest").agg(
        F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("n", "prefix", "bitmap")]
    )
    distinct = stored(sets.select("id", "n", "prefix", "bitmap"), "distinct")
    marks = distinct.select("id", "n", "bitmap")
    entries = distinct.select("id", "n", "prefix").mapInArrow(_entries, "code bigint, n int, pos int, id bigint")
    lists = entries.repartition("code").sortWithinPartitions("code", "n", "pos", "id")
    index = stored(lists.mapInArrow(_with_partners, "code bigint, n int, pos int, id bigint, partner bigint"), "index")
    wanted = Sets(docs, size)
    pairs = stored(at_most_two_each(index.select("id", "partner"), marks), "pairs")
    led = stored(overlaps(pairs, wanted.holding(pairs)), "led")
    groups = stored(components(led.filter(linked()).select("a", "b")), "groups")
    for turn in range(1, TURNS + 1):
        named = grouped_lists(index, groups).mapInArrow(partners_between(turn), "id bigint, partner bigint")
        named = named.select(F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b")).distinct()
        pairs = stored(possible(named, marks), "pairs")
        more = stored(overlaps(pairs, wanted.holding(pairs)), "led")
        led, groups = led.union(more), stored(components_of(groups, more.filter(linked()).select("a", "b")), "groups")
    further = components_of(groups, links_between_groups(index, groups, led, marks, wanted))
    rows = survey.filter("slice is null").select("doc_id", "n", "digest")
    smallest = rows.filter("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("id"))
    of_digest = smallest.join(further, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    answered = rows.join(of_digest, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return answered.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))


def components_of(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups after further links between their members."""
    a = groups.select(F.col("id").alias("a"), F.col("component").alias("group_a"))
    b = groups.select(F.col("id").alias("b"), F.col("component").alias("group_b"))
    between = links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("group_a", "a").alias("a"), F.coalesce("group_b", "b").alias("b")
    )
    joined = components(between.distinct())
    # Ids that no first group holds come in through the later links alone.
    later = joined.select(F.col("id").alias("component"), F.col("component").alias("last"))
    moved = groups.join(later, "component", "left").select("id", F.coalesce("last", "component").alias("component"))
    alone = joined.join(groups.select("id"), "id", "left_anti").select("id", "component")
    return moved.union(alone)


def one_of_each(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The documents with the smallest id of each group, with their own columns."""
    kept = near_duplicates(docs, size).filter("doc_id is null or doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["doc_id"]), "left_semi")
