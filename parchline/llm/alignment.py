"""Alignment of two tokenizations of the same texts by galloping intersection of token end offsets.

Tokenizer A encodes a space and the text with a byte-level BPE vocabulary (ids of the ``tokenizers`` file,
computed from the same vocabulary's rank file), B encodes the text with a sentencepiece model (which puts the space in front itself); neither adds special tokens, and their
strings inside a text are plain text. A token's bytes: A's vocabulary entry mapped back through the
byte-level alphabet; B's piece in UTF-8 with U+2581 as a space and ``<0xHH>`` as the byte HH.

Per text, the end offsets of A's and of B's tokens are two ascending lists. The shorter one drives: it is
taken in blocks of ``BLOCK`` ends, and for each block an exponential search from the last match into the
longer list bounds the range in which a binary search finds every end of the block. The common ends
(their indices in both lists) cut both token sequences into groups: the rank differences between
consecutive common ends are the sizes of a group on either side. A link is an A and a B token that end
at the same byte; every common end is one link.

Corpus-wide, each (A id, B id) pair counts the links that hold it; a pair is best when its count is the
highest among the pairs of its B id (ties all best). Per document: n_a, n_b, n_groups, n_links, n_best
(links whose pair is best), count_sum (the counts of its links, summed), and groups_sha256 of
``a1,a2|b1;a3|b2,b3``.

Defined results: a text that is null or empty, or whose joined A or B bytes are not exactly the space and
the text, has no tokens: all counts 0 and groups_sha256 ''. Rows are answered one by one (repeated rows
and ids too, a null id included); a repeated row adds its links to the corpus counts again. Other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.tables import stored

#: Ends of the shorter list that one exponential search covers.
BLOCK = 512

#: Characters of text that are tokenized at once; a tokenizer's results for them are held together.
SLICE_CHARS = 1 << 18

#: B ids are below 2 ** B_BITS; a link's pair is A id << B_BITS | B id.
B_BITS = 20

RESULT = (
    "_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<long>"
)


def byte_alphabet() -> dict[str, int]:
    """The byte-level BPE alphabet: printable Latin-1 bytes stand for themselves, the others for 256 + n."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    extra = iter(range(256, 512))
    return {chr(b if b in kept else next(extra)): b for b in range(256)}


def _flat(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    starts = np.zeros(len(pieces), dtype=np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    return lengths, starts, np.frombuffer(b"".join(pieces), dtype=np.uint8)


@lru_cache(maxsize=4)
def tokenizers_of(a_ranks: str, b_file: str):
    """Both tokenizers, their token byte tables and decimal tables, once per Python process.

    A is encoded by tiktoken with the rank file of the byte-level vocabulary (rank = id), its pattern and no
    special tokens: the ids of the ``tokenizers`` file of that vocabulary with its special token's string
    as plain text, at several times the speed (the tests compare both on whole tables).
    """
    import sentencepiece
    import tiktoken
    import public_tokenizers

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, open(a_ranks, "rb"))}
    a = tiktoken.Encoding(f"ranks-{a_ranks}", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    a_pieces = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        a_pieces[i] = token
    b = sentencepiece.SentencePieceProcessor(model_file=b_file)
    b_pieces = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        b_pieces.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    if len(b_pieces) >= 1 << B_BITS:
        raise ValueError("B's vocabulary does not fit the pair code")
    a_digits = _flat([str(i).encode() for i in range(len(a_pieces))])
    b_digits = _flat([str(i).encode() for i in range(len(b_pieces))])
    return a, b, _flat(a_pieces), _flat(b_pieces), a_digits, b_digits


def _joined(ids: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    """End offsets of the tokens and their bytes joined, gathered without a loop over tokens."""
    lengths, starts, flat = table
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    if len(ids) == 0:
        return ends, np.zeros(0, dtype=np.uint8)
    shift = np.repeat(starts[ids] - (ends - sizes), sizes)
    return ends, flat[np.arange(ends[-1], dtype=np.int64) + shift]


def common_ends(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (in x, in y) of the values both ascending lists hold, by galloping from the shorter one."""
    if len(x) > len(y):
        iy, ix = common_ends(y, x)
        return ix, iy
    found_x, found_y, pos, n = [], [], 0, len(y)
    for first in range(0, len(x), BLOCK):
        block = x[first : first + BLOCK]
        last, step = block[-1], 1
        # Exponential search: double the step until the longer list reaches the block's last end.
        while pos + step < n and y[pos + step] < last:
            step *= 2
        end = min(pos + step + 1, n)
        at = pos + np.searchsorted(y[pos:end], block)
        hit = at < n
        hit[hit] = y[at[hit]] == block[hit]
        found_x.append(first + np.flatnonzero(hit))
        found_y.append(at[hit])
        pos = min(int(at[-1]), n - 1) if len(at) else pos
    if not found_x:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_x).astype(np.int64), np.concatenate(found_y).astype(np.int64)


def groups_text(a_ids: np.ndarray, b_ids: np.ndarray, ia: np.ndarray, ib: np.ndarray, a_digits, b_digits) -> bytes:
    """``a1,a2|b1;a3|b2,b3``: each group's A ids, then its B ids, built from tables of decimal digits."""
    na, nb = len(a_ids), len(b_ids)
    ga = np.searchsorted(ia, np.arange(na))
    gb = np.searchsorted(ib, np.arange(nb))
    at_a = np.arange(na) + np.concatenate(([0], ib[:-1] + 1))[ga]
    at_b = np.arange(nb) + (ia + 1)[gb]
    # The ids in written order, each with its digits' table and the sign that follows it.
    order_len = np.empty(na + nb, dtype=np.int64)
    order_start = np.empty(na + nb, dtype=np.int64)
    from_b = np.zeros(na + nb, dtype=bool)
    signs = np.empty(na + nb, dtype=np.uint8)
    order_len[at_a], order_start[at_a] = a_digits[0][a_ids], a_digits[1][a_ids]
    order_len[at_b], order_start[at_b] = b_digits[0][b_ids], b_digits[1][b_ids]
    from_b[at_b] = True
    signs[at_a] = np.where(np.arange(na) == ia[ga], ord("|"), ord(","))
    signs[at_b] = np.where(np.arange(nb) == ib[gb], ord(";"), ord(","))
    widths = order_len + 1
    ends = np.cumsum(widths)
    out = np.empty(ends[-1], dtype=np.uint8)
    out[ends - 1] = signs
    digit_at = np.repeat(ends - widths, order_len) + (np.arange(order_len.sum()) - np.repeat(np.cumsum(order_len) - order_len, order_len))
    source = np.repeat(order_start, order_len) + (np.arange(order_len.sum()) - np.repeat(np.cumsum(order_len) - order_len, order_len))
    in_b = np.repeat(from_b, order_len)
    out[digit_at[~in_b]] = a_digits[2][source[~in_b]]
    out[digit_at[in_b]] = b_digits[2][source[in_b]]
    return out[:-1].tobytes()


def align_one(text: str | None, a_ids: list[int], b_ids: list[int], a_table, b_table, a_digits, b_digits) -> tuple:
    """(n_a, n_b, n_groups, n_links, groups_sha256, pair codes, their counts) of one text."""
    empty = (0, 0, 0, 0, "", [], [])
    if not text:
        return empty
    target = np.frombuffer((" " + text).encode("utf-8"), dtype=np.uint8)
    a = np.asarray(a_ids, dtype=np.int64)
    b = np.asarray(b_ids, dtype=np.int64)
    ends_a, bytes_a = _joined(a, a_table)
    ends_b, bytes_b = _joined(b, b_table)
    if not (np.array_equal(bytes_a, target) and np.array_equal(bytes_b, target)):
        return empty
    ia, ib = common_ends(ends_a, ends_b)
    written = groups_text(a, b, ia, ib, a_digits, b_digits)
    codes, times = np.unique((a[ia] << B_BITS) | b[ib], return_counts=True)
    return (len(a), len(b), len(ia), len(ia), hashlib.sha256(written).hexdigest(), codes.tolist(), times.tolist())


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``SLICE_CHARS`` characters (a longer text alone): a tokenizer holds one run."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE_CHARS:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _aligner(a_ranks: str, b_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, a_table, b_table, a_digits, b_digits = tokenizers_of(a_ranks, b_file)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = []
            for first, last in _slices(texts):
                plain = [t or "" for t in texts[first:last]]
                a_ids = [a.encode_ordinary(" " + t) for t in plain]
                b_ids = b.encode(plain, num_threads=1)
                rows += [
                    align_one(t, x, y, a_table, b_table, a_digits, b_digits) for t, x, y in zip(texts[first:last], a_ids, b_ids)
                ]
                del a_ids, b_ids
            columns = list(zip(*rows)) if rows else [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, TYPES)]],
                schema=SCHEMA,
            )

    return run


TYPES = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
SCHEMA = pa.schema(
    [("_row", pa.int64()), ("doc_id", pa.int64())]
    + list(zip(["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"], TYPES))
)


def aligned(docs: DataFrame, a_ranks: str, b_file: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per documents row.

    Texts are tokenized where they are read; what is shuffled is one row per distinct link pair and
    document, summed map-side into the corpus counts, and joined back by pair (AQE splits hot pairs).
    """
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long"), F.col("text"))
    per_doc = stored(rows.mapInArrow(_aligner(a_ranks, b_file), RESULT), "alignment")
    links = per_doc.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "_row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")
    )
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)))
    best = counts.withColumn("best", F.col("count") == F.max("count").over(of_b))
    scored = links.join(best, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    found = per_doc.join(scored, "_row", "left")
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups_sha256",
    )
