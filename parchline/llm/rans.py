"""Token ids in binary files: static range asymmetric numeral coding.

One table of frequencies, counted over all tokens and scaled to ``1 << SCALE``, is shared by all
blocks. A block holds whole documents, about ``BLOCK_TOKENS`` ids of them, and can be decoded alone:
its ids are dealt in turn to ``lanes`` coders whose states advance together in one vector
operation and whose output words share one stream. Every ``CHECK_STEPS`` steps a checkpoint keeps the
states and the place in the stream, so parts of a block can be decoded at once or alone; every
part and every block carries a CRC-32, and a block names its table by checksum.

Block layout, little-endian::

    magic "PLR1", version, lanes (16 bits), checksum of the table (32 bits), ids (64), documents (64),
    checkpoints (32), words (32)
    per document: id (64, signed), number of its ids (64)
    per checkpoint: first id (64), first word (64), CRC-32 of its ids (64), a state per lane (64)
    words (32 each); CRC-32 of all before (32)

States lie in [2**31, 2**63) and give off words of 32 bits. Encoding runs backwards, so that
decoding runs forwards.

Files: a table of blocks written by Spark into a folder that all executors share, ranges of
document ids in ascending order over the files; the written files are what is read back. Document ids
must be unique and not null for a defined order; rows with a null id come first, equal ids are
ordered by their ids' bytes. An empty table gives no blocks. Null and empty texts are documents that hold
just the end id. Ids are those of the library with the file as it is: names of added tokens in a text
become those tokens.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from ..session import fresh_dir
from . import words as W

SCALE = 20
LOW = np.uint64(1 << 31)
LANES = 2048
BLOCK_TOKENS = 1 << 19
CHECK_STEPS = 128
MAGIC = b"PLR1"
STORE = "rans"
_HEAD = "<4sHHIqqII"

#: Distinct words whose ids a task keeps, and the longest word kept.
KEPT_WORDS = 1 << 20
KEPT_LENGTH = 64


class DamagedBlock(ValueError):
    """A block whose checksum, table or layout is not what it says."""


@dataclass
class Table:
    """Scaled frequencies of all ids and the sums before them."""

    freq: np.ndarray
    low: np.ndarray
    crc: int

    @staticmethod
    def of(counts: dict[int, int]) -> Table:
        size = max(counts, default=0) + 1
        raw = np.zeros(size, np.int64)
        for symbol, count in counts.items():
            raw[symbol] = count
        whole = 1 << SCALE
        used = raw > 0
        if used.sum() > whole:
            raise ValueError("more ids than the scale has room for")
        freq = np.where(used, np.maximum(1, (raw.astype(object) * whole // max(int(raw.sum()), 1)).astype(np.int64)), 0)
        excess = int(freq.sum()) - whole if used.any() else 0
        # Rounding leaves a few places over or short: the most frequent ids give or take them.
        for symbol in np.argsort(-freq, kind="stable"):
            if not excess:
                break
            change = -excess if excess < 0 else -min(excess, int(freq[symbol]) - 1)
            freq[symbol] += change
            excess += change
        low = np.concatenate([[0], np.cumsum(freq)[:-1]])
        return Table(freq.astype(np.uint64), low.astype(np.uint64), zlib.crc32(freq.astype("<u4").tobytes()))

    def symbols(self) -> np.ndarray:
        """The id of each of the ``1 << SCALE`` places."""
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


def encode_block(docs: list[tuple[int, np.ndarray]], table: Table, lanes: int = LANES, check_steps: int = CHECK_STEPS) -> bytes:
    """One block from (document id, ids) pairs."""
    ids = np.concatenate([*(x for _, x in docs), np.zeros(0, np.uint32)]).astype(np.int64)
    count = len(ids)
    lanes = max(1, min(lanes, count // 64))
    freq, low = table.freq, table.low
    state = np.full(lanes, LOW, np.uint64)
    chunks: list[np.ndarray] = []
    written = 0
    marks: list[tuple[int, int, int, np.ndarray]] = []
    steps = -(-count // lanes)
    shift = np.uint64(63 - SCALE)
    for step in range(steps - 1, -1, -1):
        part = ids[step * lanes : (step + 1) * lanes]
        f, c = freq[part], low[part]
        x = state[: len(part)]
        full = x >= (f << shift)
        if full.any():
            out = x[full]
            chunks.append(out.astype("<u4"))
            written += len(out)
            x[full] = out >> np.uint64(32)
        whole = x // f
        state[: len(part)] = (whole << np.uint64(SCALE)) + (x - whole * f) + c
        if step % check_steps == 0:
            first = step * lanes
            crc = zlib.crc32(ids[first : first + check_steps * lanes].astype("<u4").tobytes())
            marks.append((first, written, crc, state.copy()))
    words = np.concatenate([*chunks[::-1], np.zeros(0, "<u4")])
    out = [
        struct.pack(_HEAD, MAGIC, 1, lanes, table.crc, count, len(docs), len(marks), len(words)),
        np.array([(d, len(x)) for d, x in docs], "<i8").tobytes(),
    ]
    for first, written_then, crc, states in marks[::-1]:
        out += [struct.pack("<qqq", first, len(words) - written_then, crc), states.astype("<u8").tobytes()]
    out.append(words.tobytes())
    body = b"".join(out)
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A block opened for decoding, whole or by checkpoints."""

    def __init__(self, data: bytes, table: Table, symbols: np.ndarray | None = None):
        if len(data) < struct.calcsize(_HEAD) + 4 or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise DamagedBlock("the block's checksum does not fit")
        magic, version, lanes, crc, count, n_docs, n_marks, n_words = struct.unpack_from(_HEAD, data)
        if magic != MAGIC or version != 1:
            raise DamagedBlock("not a block of this format")
        if crc != table.crc:
            raise DamagedBlock("the block was written with another table")
        self.table, self.lanes, self.count = table, lanes, count
        self.symbols = table.symbols() if symbols is None else symbols
        at = struct.calcsize(_HEAD)
        self.docs = np.frombuffer(data, "<i8", 2 * n_docs, at).reshape(-1, 2)
        at += 16 * n_docs
        self.marks = []
        for _ in range(n_marks):
            self.marks.append((*struct.unpack_from("<qqq", data, at), np.frombuffer(data, "<u8", lanes, at + 24)))
            at += 24 + 8 * lanes
        self.words = np.frombuffer(data, "<u4", n_words, at)

    def part(self, number: int) -> np.ndarray:
        """Ids from one checkpoint up to the next."""
        first, at, crc, states = self.marks[number]
        end = self.marks[number + 1][0] if number + 1 < len(self.marks) else self.count
        freq, low, symbols = self.table.freq, self.table.low, self.symbols
        state = states.astype(np.uint64)
        mask = np.uint64((1 << SCALE) - 1)
        out = np.empty(end - first, np.uint32)
        for begin in range(0, end - first, self.lanes):
            x = state[: min(self.lanes, end - first - begin)]
            place = x & mask
            found = symbols[place.astype(np.int64)]
            out[begin : begin + len(x)] = found
            x = freq[found] * (x >> np.uint64(SCALE)) + place - low[found]
            empty = np.flatnonzero(x < LOW)
            if len(empty):
                x[empty] = (x[empty] << np.uint64(32)) | self.words[at : at + len(empty)]
                at += len(empty)
            state[: len(x)] = x
        if zlib.crc32(out.astype("<u4").tobytes()) != crc:
            raise DamagedBlock(f"the checksum of part {number} does not fit")
        return out

    def ids(self) -> np.ndarray:
        return np.concatenate([*(self.part(i) for i in range(len(self.marks))), np.zeros(0, np.uint32)])

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        ids, at = self.ids(), 0
        for doc, size in self.docs.tolist():
            yield doc, ids[at : at + size]
            at += size


# --- tokens


#: Words that the pre-tokenizer cuts at each change between letters, digits and signs, and nothing else changes:
#: lower-case Latin letters, digits, signs but the apostrophe.
_SIMPLE = re.compile(r"[a-z0-9\xdf-\xf6\xf8-\xff!-&(-/:-@\[-`{-~]+").fullmatch
_PIECES = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+").findall


class _Words(dict):
    """Ids of the words between blanks and line ends, which the tokenizer drops and never crosses.

    ``pieces`` is the file's model behind a plain split at blanks, for pieces that the other steps leave alone.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # No piece is asked for twice, so the model's own cache would only take time.
        options = {k: model[k] for k in _OPTIONS if model.get(k) is not None}
        self.pieces = Tokenizer(models.BPE(model["vocab"], merges, cache_capacity=0, **options))
        self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        named = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {c: named(chr(c))[0][0] for c in range(0xC0, 0x100)}
        suffix = model.get("end_of_word_suffix")
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for t, i in model["vocab"].items() if suffix and t.endswith(suffix)]] = True

    def crossed(self, text: str, lower: str) -> bool:
        """Whether the text, or what its words are cut from, holds the name of an added token.

        The library looks for these before all else, so neither the text nor its words can be taken apart.
        """
        return any(a in text or a in lower for a in self.added)

    def of(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words; new ones are learnt."""
        found = list(map(self.get, words))
        missing = [w for w, x in zip(words, found) if x is None]
        if not missing:
            return found
        if len(self) + len(missing) > KEPT_WORDS:
            self.clear()
            missing, found = words, [None] * len(words)
        fresh = self.learn(missing)
        return [fresh[w] if x is None else x for w, x in zip(words, found)]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words by the library: of simple ones piece by piece, of the others as they are.

        All but long ones are kept.
        """
        parts = {w: _PIECES(w) for w in words if _SIMPLE(w)}
        fresh = self._joined(list(set().union(*parts.values()).difference(self)))
        fresh |= self._alone([w for w in words if w not in parts])
        for word, cut in parts.items():
            if word not in fresh:
                fresh[word] = b"".join([fresh[p] if p in fresh else self[p] for p in cut])
        self.update(fresh if max(map(len, fresh)) <= KEPT_LENGTH else {w: x for w, x in fresh.items() if len(w) <= KEPT_LENGTH})
        return fresh

    def _alone(self, words: list[str]) -> dict[str, bytes]:
        found = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return {w: np.array(f.ids, IDS).tobytes() for w, f in zip(words, found)}

    def _joined(self, pieces: list[str]) -> dict[str, bytes]:
        """Many pieces encoded as one text; a piece's last id names the end of a word."""
        pieces.sort(key=str.isascii)  # only the texts of the others are renamed
        groups = [pieces[i : i + 512] for i in range(0, len(pieces), 512)]
        texts = [" ".join(g) for g in groups]
        texts = [t if t.isascii() else t.translate(self.letters) for t in texts]
        fresh: dict[str, bytes] = {}
        for group, found in zip(groups, self.pieces.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, IDS)
            cuts = [0, *(2 * np.flatnonzero(self.ends[ids]) + 2).tolist()]
            if len(cuts) != len(group) + 1:  # a vocabulary that does not mark all ends
                fresh |= self._alone(group)
                continue
            data = ids.tobytes()
            fresh.update(zip(group, [data[a:b] for a, b in zip(cuts, cuts[1:])]))
        return fresh


#: What a model says beside its vocabulary and merges.
_OPTIONS = ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")

#: Ids are held in 16 bits while they are sorted; the tokenizer has fewer than 65,536.
IDS = "<u2"

def tokenize(texts: list, path: str, end_id: int) -> list[bytes]:
    """Ids of each text with the end id, as little-endian unsigned 16-bit integers."""
    loaded = W.process_store(STORE)
    if path not in loaded:
        loaded[path] = _Words(path)
        if loaded[path].tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("a vocabulary of at most 65,536 ids is needed")
    known, end = loaded[path], struct.pack("<H", end_id)
    lower, whole = [], {}
    for i, text in enumerate(texts):
        lower.append(_lower(text or ""))
        if known.crossed(text or "", lower[i]):
            whole[i] = np.array(known.tokenizer.encode(text, add_special_tokens=False).ids, IDS).tobytes()
            lower[i] = ""
    return [whole.get(i, ids) + end for i, ids in enumerate(_by_words(lower, known))]


def _by_words(texts: list[str], known: _Words) -> list[bytes]:
    """Ids of lower-cased texts: each distinct word is looked up once, its ids are put wherever it stands."""
    words, bounds = _cut(pa.array(texts, pa.large_string()))
    coded = words.dictionary_encode()
    data = known.of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
    pool = np.frombuffer(b"".join(data), IDS)
    sizes = np.fromiter(map(len, data), np.int64, len(data)) // 2
    code = coded.indices.to_numpy()
    counts = sizes[code]
    after = np.concatenate(([0], np.cumsum(counts)))
    places = np.repeat((np.cumsum(sizes) - sizes)[code] - after[:-1], counts)
    places += np.arange(len(places))
    ids, ends = pool[places], after[bounds].tolist()
    return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:])]


#: By byte: blanks and line ends; full stops and commas; ASCII letters and digits; second bytes of Latin letters after 0xC3.
_BLANK, _STOP, _LETTER, _SECOND = (
    np.isin(np.arange(256), list(some)) for some in (b" \n", b".,", b"0123456789abcdefghijklmnopqrstuvwxyz", {*range(0x9F, 0xC0)} - {0xB7})
)


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, and the number of the first word of each text (and of all words).

    Words are cut at blanks and line ends, and before a full stop or comma that follows a letter or digit and
    is followed by white space or nothing: it is a piece of its own there, so that most words are met without it.
    """
    _, ends, values = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8)[: ends[-1]] if values is not None else np.zeros(0, np.uint8)
    inside = ~_BLANK[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    stops = np.flatnonzero(_STOP[data])
    stops = stops[(stops > 0) & ~np.append(inside, False)[stops + 1]]
    before = data[stops - 1]
    opens[stops[_LETTER[before] | (_SECOND[before] & (data[np.maximum(stops, 2) - 2] == 0xC3))]] = True
    opens[ends[ends < len(data)]] = True
    opens &= inside
    starts = np.append(np.flatnonzero(opens[inside]), np.count_nonzero(inside))
    words = pa.Array.from_buffers(pa.large_string(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data[inside])])
    return words, np.searchsorted(np.flatnonzero(opens), ends)


def _lower(text: str) -> str:
    """The tokenizer lowers letter by letter; Python's result differs only where a capital sigma stands."""
    return text if "\u03a3" in text else text.lower()


def tokens(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """doc_id and ids of each document, the end id included, compressed (``unpacked`` opens them)."""

    def make():
        squeeze = zstandard.ZstdCompressor(level=1).compress
        return lambda texts: [pa.array(map(squeeze, tokenize(texts, path, end_id)), pa.binary())]

    frame = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return W.per_text(frame, make, "ids binary", store=STORE)


def unpacked(ids: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(ids.as_py()), IDS)


# --- files


def shared_table(tokens_table: DataFrame) -> Table:
    """Frequencies over all tokens; the driver gets one row per id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        held: list[np.ndarray] = []
        for batch in batches:
            for ids in batch.column("ids"):
                held.append(unpacked(ids))
                if len(held) >= 512:
                    total += np.bincount(np.concatenate(held), minlength=1 << 16)
                    held = []
        total += np.bincount(np.concatenate([*held, np.zeros(0, IDS)]), minlength=1 << 16)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["symbol", "n"])

    counts = tokens_table.select("ids").mapInArrow(count, "symbol bigint, n bigint").groupBy("symbol").agg(F.sum("n").alias("n"))
    return Table.of({r["symbol"]: r["n"] for r in counts.collect()})


def write_files(tokens_table: DataFrame, table: Table, folder: str) -> None:
    """Blocks in ascending order of document ids, written as files of ``folder``."""
    sent = tokens_table.sparkSession.sparkContext.broadcast(table)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        size = number = 0
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                held.append((NULL_ID if doc is None else doc, unpacked(ids)))
                size += len(held[-1][1])
                if size >= BLOCK_TOKENS:
                    yield _block(number, size, encode_block(held, sent.value))
                    held, size, number = [], 0, number + 1
        if held:
            yield _block(number, size, encode_block(held, sent.value))

    blocks = (
        tokens_table.repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "ids")
        .mapInArrow(encode, "block bigint, n_tokens bigint, data binary")
        .withColumn("file", F.spark_partition_id())
    )
    blocks.write.parquet(folder)


#: Stands for a null document id inside a block.
NULL_ID = -(1 << 63)


def _block(number: int, size: int, data: bytes) -> pa.RecordBatch:
    columns = [pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([data], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["block", "n_tokens", "data"])


def read_files(blocks: DataFrame, table: Table) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, decoded from the files block by block.

    Where a block starts follows from the sizes of the files and of the blocks before it in its
    file: a row per file is ordered in one task, the blocks of each file in theirs.
    """
    sent = blocks.sparkSession.sparkContext.broadcast(table)
    files = blocks.groupBy("file").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("file_start"))
    inside = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("file", "block", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("start"))
    starts = starts.join(offsets, "file").select("file", "block", (F.col("start") + F.col("file_start")).alias("first"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        symbols = own.symbols()
        for batch in batches:
            for file, block, data in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("data")):
                at, rows = 0, []
                for doc, ids in Block(data.as_py(), own, symbols).documents():
                    rows.append((file, block, None if doc == NULL_ID else doc, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["file", "block", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = blocks.select(F.col("file").cast("long").alias("file"), "block", "data").mapInArrow(
        decode, "file bigint, block bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return found.join(starts, ["file", "block"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def written(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Encode all documents, write the files into the shared folder, read them back."""
    spark = docs.sparkSession
    stage, folder = fresh_dir(spark, "tokens"), fresh_dir(spark, "blocks")
    tokens(docs, path, end_id).write.parquet(stage)
    tokens_table = spark.read.parquet(stage)
    table = shared_table(tokens_table)
    write_files(tokens_table, table, folder)
    return read_files(spark.read.parquet(folder), table)
