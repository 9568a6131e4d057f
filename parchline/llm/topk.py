"""Exact top-k inner products by an impact-ordered index, score at a time.

Vectors are whole numbers. An index shard holds posting segments: the rows whose component has a certain
sign and quantised impact (the magnitude in steps of ``STEP``), and that component of each. A block
of queries goes through the segments in descending order of impact and adds what each contributes to the
scores of the segment's rows, for all queries of the block at once.

After the segments of an impact two bounds hold for each row and query. What is left of a score is the product of
the query with the part of the row not yet added, and by the Cauchy-Schwarz inequality no larger than the
product of their lengths; the squared length of that part is kept up to date per row in whole
numbers. A block stops only when for each query the rows whose upper bound reaches the k-th best
lower bound are few enough to rescore (all other rows are proved to be out), or when the segments are used up. Those
possible members are then rescored exactly and ordered by score, ties by smaller id.

Shards hold at most about ``SHARD_ROWS`` rows and query blocks ``BLOCK_QUERIES`` queries. Each block
meets each shard once, by a key for each pair of them, in a task that holds one of both; k rows per
query go on from there and are ranked in two levels, first within groups of shards.

Defined results: vectors that are null, empty or hold null, infinite or undefined components take no part,
nor do rows without an id; shorter vectors count as filled up with zeros; components beyond 2**20 in
magnitude after scaling are refused, so that scores fit in 64 bits. A query's own row is every
row with its id. Fully equal rows count once; different vectors under one id are separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.tables import stored

STEP = 16
#: A block stops when at most so many rows per query are left to rescore.
FEW = 64
SHARD_ROWS = 16_384
BLOCK_QUERIES = 128
#: Largest magnitude of a component.
LARGEST = 1 << 20
_MERGED_SHARDS = 256


@dataclass
class Shard:
    """Rows of one shard, ordered by id, and their segments by descending impact."""

    ids: np.ndarray
    vectors: np.ndarray  # rows x components
    rows: np.ndarray  # row numbers, segment after segment
    values: np.ndarray  # the component of each of these rows
    starts: np.ndarray  # segment -> first place in rows
    component: np.ndarray  # segment -> component
    impact: np.ndarray  # segment -> quantised impact


def build(ids: np.ndarray, vectors: np.ndarray) -> Shard:
    """Index the rows; components of zero have no postings."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    component, row = np.nonzero(vectors.T)
    value = vectors[row, component]
    impact = np.abs(value) // STEP
    order = np.lexsort((row, value < 0, component, -impact))
    row, value, component, impact = row[order], value[order], component[order], impact[order]
    new = np.ones(len(row), bool)
    new[1:] = (impact[1:] != impact[:-1]) | (component[1:] != component[:-1]) | ((value[1:] < 0) != (value[:-1] < 0))
    first = np.flatnonzero(new)
    return Shard(ids, vectors, row, value, np.append(first, len(row)), component[first], impact[first])


def search(shard: Shard, query_ids: np.ndarray, queries: np.ndarray, k: int, few: int = FEW) -> list[list[tuple[int, int]]]:
    """For each query the k best (score, id) of the shard's rows with another id, exact."""
    count = len(shard.ids)
    score = np.zeros((count, len(queries)), np.int64)
    rest = np.sum(shard.vectors * shard.vectors, 1)  # squared length of what is not yet added
    length = np.sqrt(np.sum(queries * queries, 1).astype(np.float64)) * (1 + 1e-9)
    own = list(zip(np.searchsorted(shard.ids, query_ids, "left").tolist(), np.searchsorted(shard.ids, query_ids, "right").tolist()))
    members = np.ones(score.shape, bool)
    for a, b in impacts(shard.impact):
        for segment in range(a, b):
            where = slice(shard.starts[segment], shard.starts[segment + 1])
            rows, values = shard.rows[where], shard.values[where]
            score[rows] += values[:, None] * queries[:, shard.component[segment]]
            rest[rows] -= values * values
        if 2 * shard.starts[b] < len(shard.rows) or b == len(shard.impact):
            continue  # too early for a proof, or nothing left to save
        slack = np.sqrt(rest.astype(np.float64))[:, None] * length + 1
        lower = score - slack
        for i, (left, right) in enumerate(own):
            lower[left:right, i] = -np.inf
        least = np.partition(lower, -min(k, count), axis=0)[-min(k, count)]
        members = score + slack >= least
        if members.sum(0).max(initial=0) <= max(few, k):
            break
    else:
        # All is added, so scores are exact: who reaches the k-th best, own rows aside, is a member.
        exact = score.astype(np.float64)
        for i, (left, right) in enumerate(own):
            exact[left:right, i] = -np.inf
        members = exact >= np.partition(exact, -min(k, count), axis=0)[-min(k, count)]
    out = []
    for i, (left, right) in enumerate(own):
        members[left:right, i] = False
        found = np.flatnonzero(members[:, i])
        exact = shard.vectors[found] @ queries[i]
        best = np.lexsort((shard.ids[found], -exact))[:k]
        out.append(list(zip(exact[best].tolist(), shard.ids[found][best].tolist())))
    return out


def impacts(impact: np.ndarray) -> list[tuple[int, int]]:
    """First and last segment (exclusive) of each impact."""
    cuts = np.flatnonzero(impact[1:] != impact[:-1]) + 1
    edges = [0, *cuts.tolist(), len(impact)]
    return list(zip(edges, edges[1:])) if len(impact) else []


def whole_numbers(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double; null if the vector takes no part."""
    large = float(LARGEST)

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    doubles = F.transform(embedding, lambda x: x.cast("double"))
    numbers = F.transform(doubles, lambda x: F.floor(x * scale).cast("long"))
    checked = F.when(
        F.exists(doubles, lambda x: F.abs(x * scale) > large), F.raise_error(F.lit("a component is too large"))
    ).otherwise(numbers)
    return F.when(embedding.isNotNull() & (F.size(embedding) > 0) & F.forall(doubles, usable), checked)


def _packed(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: its ids and vectors as bytes."""

    def pack(table: pa.Table) -> pa.Table:
        vectors = table.column("vector").to_pylist()
        width = max(map(len, vectors))
        grid = np.zeros((len(vectors), width), "<i4")
        for i, v in enumerate(vectors):
            grid[i, : len(v)] = v
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        data = {
            key: pa.array([table.column(key)[0].as_py()], pa.int64()),
            "width": pa.array([width], pa.int64()),
            "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([grid[order].tobytes()], pa.binary()),
        }
        return pa.table(data)

    return rows.groupBy(key).applyInArrow(pack, f"{key} bigint, width bigint, ids binary, vectors binary")


def _opened(ids: bytes, vectors: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(vectors, "<i4").reshape(-1, width).astype(np.int64)


def _cells(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if held != row["shard"]:
                    ids, vectors = _opened(row["ids"], row["vectors"], row["width"])
                    held, shard = row["shard"], build(ids, vectors)
                queries, wanted = _opened(row["query_ids"], row["query_vectors"], row["query_width"])
                width = shard.vectors.shape[1]
                fitted = np.zeros((len(queries), width), np.int64)
                fitted[:, : min(width, wanted.shape[1])] = wanted[:, :width]
                out = []
                for number, (query, found) in enumerate(zip(queries.tolist(), search(shard, queries, fitted, k))):
                    out += [(row["block"], number, query, row["shard"], i, s) for s, i in found]
                columns = list(zip(*out)) or [()] * 6
                names = ["block", "number", "query_id", "shard", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def nearest(embeddings: DataFrame, queries: DataFrame, k: int, scale: int = 256, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of ``embeddings`` for each of ``queries``.

    Both have vec_id and embedding.
    """

    def rows(table: DataFrame) -> DataFrame:
        vectors = table.select(F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(F.col("embedding"), scale).alias("vector"))
        return vectors.filter("vec_id is not null and vector is not null").distinct()

    corpus, wanted = stored(rows(embeddings), "vectors"), stored(rows(queries), "queries")
    n_shards = max(1, -(-corpus.count() // shard_rows))
    n_blocks = max(1, -(-wanted.count() // BLOCK_QUERIES))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts))

    shards = _packed(corpus.withColumn("shard", dealt(n_shards)), "shard")
    blocks = _packed(wanted.withColumn("block", dealt(n_blocks)), "block").select(
        "block",
        F.col("width").alias("query_width"),
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("query_vectors"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))).alias("shard"),
    )
    cells = shards.join(blocks, "shard")
    found = cells.mapInArrow(_cells(k), "block bigint, number bigint, query_id bigint, shard bigint, vec_id bigint, score bigint")
    order = [F.desc("score"), F.asc("vec_id")]
    near = Window.partitionBy("block", "number", F.pmod("shard", F.lit(_MERGED_SHARDS))).orderBy(*order)
    last = Window.partitionBy("block", "number").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
