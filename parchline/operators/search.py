"""Batch retrieval: dense, keyword and hybrid top-k, rerank, citations.

A batch of queries against a large corpus has corpus x queries scores. They are never rows: each
task scores its corpus batches with one matrix product and keeps only the k best per query, so a
task hands on k rows per query and the final ranking sees tasks x k rows.

The query side travels with the task. Its size is checked before; a larger batch is split into
blocks of queries that are joined to shards of the corpus by key and scored group by group with
the same kernel.
"""

from __future__ import annotations

from typing import Any, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.binding import with_single
from ..functions.text import tokens
from ..functions.vector import cosine
from .rules import resolve_retrieval

# Queries shipped with every task: at most this many, and this many bytes of vectors or weights.
MAX_SHIPPED_QUERIES = 4096
MAX_SHIPPED_BYTES = 64 * 1024 * 1024
SHARD_ROWS = 20_000
BLOCK_QUERIES = 256
SLICE_CELLS = 4_000_000
# Shares in which a query's hits from all tasks are ranked before the last ranking.
RANK_DEALS = 64
DIGITS = 6

# BM25 saturation and length weight, and the rank constant of reciprocal rank fusion.
BM25_K1 = 1.2
BM25_B = 0.75
RRF_CONSTANT = 60

HITS = "query_id bigint, item_id string, score double"


def rank_hits(scores: DataFrame, k: int, group: str = "query_id") -> DataFrame:
    """The k best per query, ties to the smaller item id."""
    order = Window.partitionBy(group).orderBy(F.desc("score"), "item_id")
    return scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_task_hits(scores: DataFrame, k: int, deals: int = RANK_DEALS) -> DataFrame:
    """``rank_hits`` for hits that every task hands on, k per query and task.

    Their number per query grows with the corpus. They are dealt out by item and ranked in each deal
    first, so the last ranking sees at most ``deals * k`` rows per query.
    """
    order = Window.partitionBy("query_id", "_deal").orderBy(F.desc("score"), "item_id")
    dealt = scores.withColumn("_deal", F.pmod(F.xxhash64("item_id"), F.lit(deals)))
    kept = dealt.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= k)
    return rank_hits(kept.drop("_deal", "_place"), k)


class _Best:
    """The k best items per query seen so far in one task."""

    def __init__(self, query_ids: np.ndarray, k: int):
        self.query_ids, self.k = query_ids, k
        self.kept: list[list[tuple[float, str]]] = [[] for _ in query_ids]

    def add(self, items: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` is queries x items; ``-inf`` marks items a query may not see."""
        for row, value in enumerate(np.round(scores, DIGITS)):
            kept = self.kept[row]
            # Nothing below the current k-th score can enter; equal scores are decided by id.
            floor = -kept[-1][0] if len(kept) == self.k else -np.inf
            place = np.flatnonzero((value >= floor) & np.isfinite(value))
            if len(place) > self.k:
                least = np.partition(value[place], len(place) - self.k)[len(place) - self.k]
                place = place[value[place] >= least]
            merged = kept + [(-value[i], items[i]) for i in place]
            merged.sort()
            self.kept[row] = merged[: self.k]

    def frame(self) -> pd.DataFrame:
        rows = [(int(q), item, -s) for q, kept in zip(self.query_ids, self.kept) for s, item in kept]
        return pd.DataFrame(rows, columns=["query_id", "item_id", "score"]).astype({"query_id": "int64", "score": "float64"})


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _unit(matrix: np.ndarray) -> np.ndarray:
    norm = np.sqrt((matrix**2).sum(axis=1, keepdims=True))
    return np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)


def shipped(df: DataFrame, limit: int = MAX_SHIPPED_QUERIES) -> list | None:
    """The rows, if there are at most ``limit``; otherwise None, and nothing is lost by asking."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def _allowed(groups: np.ndarray, query_groups: list[set | None]) -> np.ndarray:
    """queries x items: may the query see an item of this group? NULL group: nobody."""
    names, code = np.unique(np.array(["" if g is None else g for g in groups], dtype=object).astype(str), return_inverse=True)
    table = np.array([[q is None or (n != "" and n in q) for n in names] for q in query_groups], dtype=bool)
    return table[:, code] if len(names) else np.zeros((len(query_groups), 0), dtype=bool)


def dense_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    max_shipped: int = MAX_SHIPPED_QUERIES,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Exact cosine top-k: ``query_id, item_id, score, rank``.

    ``corpus`` has ``item_id string, vector array`` and optionally ``acl_group``; ``queries`` has
    ``query_id bigint, vector array`` and, with ``acl_group``, the ``groups array<string>`` the
    asking principal belongs to. Rows a principal may not see are masked before ranking.
    """
    filtered = "acl_group" in corpus.columns and "groups" in queries.columns
    wanted = ["item_id", "vector"] + (["acl_group"] if filtered else [])
    asked = ["query_id", "vector"] + (["groups"] if filtered else [])
    # A row without a vector is nobody's hit, and a query without one has no hits.
    corpus = corpus.select(*wanted).filter("vector is not null")
    queries = queries.select(*asked).filter("vector is not null")
    rows = shipped(queries, max_shipped)
    if rows is None or sum(len(r["vector"]) for r in rows) * 8 > MAX_SHIPPED_BYTES:
        return rank_task_hits(_dense_by_blocks(corpus, queries, k, filtered, max_shipped, shard_rows), k)

    ids = np.array([r["query_id"] for r in rows], dtype=np.int64)
    matrix = _unit(np.array([r["vector"] for r in rows], dtype=np.float64)) if rows else np.zeros((0, 1))
    groups = [set(r["groups"] or ()) for r in rows] if filtered else None
    # Rows scored at once, so that the queries x rows scores stay within a fixed size.
    step = max(1, SLICE_CELLS // max(1, len(ids)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(ids, k)
        for whole in batches if len(ids) else ():
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                value = matrix @ _unit(_matrix(batch.column("vector"))).T
                if groups is not None:
                    names = np.array(batch.column("acl_group").to_pylist(), dtype=object)
                    value = np.where(_allowed(names, groups), value, -np.inf)
                best.add(np.array(batch.column("item_id").to_pylist(), dtype=object), value)
        yield pa.RecordBatch.from_pandas(best.frame(), schema=_HITS_ARROW, preserve_index=False)

    return rank_task_hits(corpus.mapInArrow(score, HITS), k)


_HITS_ARROW = pa.schema([("query_id", pa.int64()), ("item_id", pa.string()), ("score", pa.float64())])


def _cells(rows: int, per_cell: int) -> int:
    return max(1, -(-rows // per_cell))


def _in_cells(items: DataFrame, asked: DataFrame, n_shards: int, n_blocks: int) -> tuple[DataFrame, DataFrame]:
    """Both sides hashed into cells; every shard of items meets every block of queries once."""
    shard = F.pmod(F.xxhash64("item_id"), F.lit(n_shards)).cast("int")
    block = F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("int")
    left = items.select("*", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    right = asked.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"))
    return left, right


def _dense_by_blocks(
    corpus: DataFrame, queries: DataFrame, k: int, filtered: bool, block: int, shard_rows: int
) -> DataFrame:
    """Top-k per corpus shard for query batches too large to ship.

    Both sides are hashed into bounded cells, and each pair of a corpus shard and a query block is
    one group. That repeats the corpus once per query block, as any exact comparison of two large
    sides must, but no group exceeds one shard and one block.
    """
    left, right = _in_cells(corpus, queries, _cells(corpus.count(), shard_rows), _cells(queries.count(), block))

    def score(items: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        best = _Best(asked["query_id"].to_numpy(dtype=np.int64), k)
        if len(items) and len(asked):
            value = _unit(np.stack(asked["vector"].to_numpy()).astype(np.float64)) @ _unit(
                np.stack(items["vector"].to_numpy()).astype(np.float64)
            ).T
            if filtered:
                groups = [set(() if g is None else g) for g in asked["groups"]]
                value = np.where(_allowed(items["acl_group"].to_numpy(), groups), value, -np.inf)
            best.add(items["item_id"].to_numpy(dtype=object), value)
        return best.frame()

    grouped = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
    return grouped.applyInPandas(score, HITS)


# --- keyword search -----------------------------------------------------------------------------


def bm25_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    max_shipped: int = MAX_SHIPPED_QUERIES,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """BM25 top-k over ``item_id, text`` for queries ``query_id, text``.

    Two passes over the corpus. The first gives its size, mean length and the document frequency
    of the query terms; the second scores whole batches against a terms x queries weight matrix.
    Queries beyond ``max_shipped`` (or the size of that matrix) are scored in blocks.
    """
    filtered = "acl_group" in corpus.columns and "groups" in queries.columns
    words = corpus.select("item_id", tokens(F.col("text")).alias("words"), *(["acl_group"] if filtered else []))
    asked = queries.select(
        "query_id", F.array_distinct(tokens(F.col("text"))).alias("terms"), *(["groups"] if filtered else [])
    )
    rows = shipped(asked, max_shipped)
    vocabulary = sorted({t for r in rows for t in r["terms"]}) if rows is not None else []
    if rows is None or len(vocabulary) * len(rows) * 8 > MAX_SHIPPED_BYTES:
        return rank_task_hits(_bm25_by_blocks(words, asked, k, filtered, min(max_shipped, BLOCK_QUERIES), shard_rows), k)
    if not vocabulary:
        return rank_hits(words.sparkSession.createDataFrame([], HITS), k)

    place = {term: i for i, term in enumerate(vocabulary)}
    # At most one row per query term, and one with the corpus totals.
    counts = {r["code"]: (r["documents"], r["words"]) for r in _corpus_statistics(words, vocabulary).collect()}
    size, total = counts.get(-1, (0, 0))
    mean_length = total / size if size else 1.0
    frequency = np.array([counts.get(i, (0, 0))[0] for i in range(len(vocabulary))], dtype=np.float64)
    idf = np.log(1 + (size - frequency + 0.5) / (frequency + 0.5))
    ids = np.array([r["query_id"] for r in rows], dtype=np.int64)
    weight = np.zeros((len(vocabulary), len(rows)))
    for column, row in enumerate(rows):
        for term in row["terms"]:
            weight[place[term], column] = idf[place[term]]
    groups = [set(r["groups"] or ()) for r in rows] if filtered else None
    known = pa.array(vocabulary, type=pa.string())

    step = _slice_rows(len(vocabulary))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(ids, k)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                value = _bm25_scores(batch.column("words"), known, weight, mean_length)
                if groups is not None:
                    names = np.array(batch.column("acl_group").to_pylist(), dtype=object)
                    value = np.where(_allowed(names, groups), value, -np.inf)
                best.add(np.array(batch.column("item_id").to_pylist(), dtype=object), value)
        yield pa.RecordBatch.from_pandas(best.frame(), schema=_HITS_ARROW, preserve_index=False)

    return rank_task_hits(words.mapInArrow(score, HITS), k)


def _term_cells(lists: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``row * len(known) + term`` for every known token, and the token count of every row."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    code = pc.index_in(lists.flatten(), value_set=known)
    owner = np.repeat(np.arange(len(lists)), lengths)
    hit = pc.is_valid(code).to_numpy(zero_copy_only=False)
    return owner[hit] * len(known) + pc.drop_null(code).to_numpy(zero_copy_only=False), lengths


def _slice_rows(n_terms: int) -> int:
    """Rows scored at once, so that the rows x terms counts stay within a fixed size."""
    return max(1, min(512, SLICE_CELLS // n_terms))


def _bm25_scores(lists: pa.Array, known: pa.Array, weight: np.ndarray, mean_length: float) -> np.ndarray:
    """queries x rows; rows without any query term are ``-inf``."""
    cell, lengths = _term_cells(lists, known)
    tf = np.bincount(cell, minlength=len(lists) * len(known)).reshape(len(lists), len(known))
    norm = BM25_K1 * (1 - BM25_B + BM25_B * lengths / mean_length)
    value = ((tf * (BM25_K1 + 1) / (tf + norm[:, None] + (tf == 0))) @ weight).T
    return np.where(value > 0, value, -np.inf)


def _corpus_statistics(words: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Document frequency per query term (``code``), and documents and words in all (code -1).

    Each task counts its own batches and hands on one row per term.
    """
    known = pa.array(vocabulary, type=pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, total, held = 0, 0, np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            cell, lengths = _term_cells(batch.column("words"), known)
            documents, total = documents + batch.num_rows, total + int(lengths.sum())
            held += np.bincount(np.unique(cell) % len(known), minlength=len(known))
        code = np.append(np.flatnonzero(held), -1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(code, pa.int64()),
                pa.array(np.append(held[held > 0], documents), pa.int64()),
                pa.array(np.append(np.zeros(len(code) - 1, np.int64), total), pa.int64()),
            ],
            names=["code", "documents", "words"],
        )

    counted = words.select("words").mapInArrow(count, "code bigint, documents bigint, words bigint")
    return counted.groupBy("code").agg(F.sum("documents").alias("documents"), F.sum("words").alias("words"))


def _bm25_by_blocks(words: DataFrame, asked: DataFrame, k: int, filtered: bool, block: int, shard_rows: int) -> DataFrame:
    """Top-k per corpus shard and query block, for query sets too large to ship.

    As in the dense form: the cells are bounded on both sides and no scored pair leaves its task.
    """
    size, mean_length = words.agg(F.count("*"), F.avg(F.size("words"))).first()
    terms = asked.select("query_id", F.explode("terms").alias("term"), *(["groups"] if filtered else []))
    # Counted before the join, so a word every document has is one row per task, not per document.
    frequency = words.select(F.explode(F.array_distinct("words")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(size) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = terms.join(frequency, "term").withColumn("idf", idf).drop("df")
    n_blocks, n_shards = _cells(asked.count(), block), _cells(size, shard_rows)
    left, right = _in_cells(words, weighted, n_shards, n_blocks)

    def score(items: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        ids, column = np.unique(wanted["query_id"].to_numpy(dtype=np.int64), return_inverse=True)
        vocabulary, row = np.unique(wanted["term"].to_numpy(dtype=str), return_inverse=True)
        best = _Best(ids, k)
        if len(items) and len(ids):
            weight = np.zeros((len(vocabulary), len(ids)))
            weight[row, column] = wanted["idf"].to_numpy()
            known = pa.array(vocabulary.tolist(), type=pa.string())
            firsts = wanted.drop_duplicates("query_id").set_index("query_id")
            groups = [set(() if (g := firsts.at[q, "groups"]) is None else g) for q in ids] if filtered else None
            step = _slice_rows(len(vocabulary))
            for at in range(0, len(items), step):
                part = items.iloc[at : at + step]
                lists = pa.array([list(w) for w in part["words"]], type=pa.list_(pa.string()))
                value = _bm25_scores(lists, known, weight, mean_length)
                if groups is not None:
                    value = np.where(_allowed(part["acl_group"].to_numpy(), groups), value, -np.inf)
                best.add(part["item_id"].to_numpy(dtype=object), value)
        return best.frame()

    grouped = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
    return grouped.applyInPandas(score, HITS)


# --- fusion, rerank, citations ------------------------------------------------------------------


def fuse(dense: DataFrame, sparse: DataFrame, k: int, constant: int = RRF_CONSTANT) -> DataFrame:
    """Reciprocal rank fusion of two ranked hit lists (queries x k rows each)."""
    share = F.lit(1.0) / (F.lit(constant) + F.col("rank"))
    both = dense.select("query_id", "item_id", share.alias("s")).unionByName(
        sparse.select("query_id", "item_id", share.alias("s"))
    )
    fused = both.groupBy("query_id", "item_id").agg(F.round(F.sum("s"), 9).alias("score"))
    return rank_hits(fused, k)


def two_stage(hits: DataFrame, wide: int, narrow: int, rescored: Column) -> DataFrame:
    """Keep ``wide`` by the first score, then ``narrow`` of those by another one."""
    kept = hits.filter(F.col("rank") <= wide).withColumnRenamed("rank", "first_rank")
    return rank_hits(kept.withColumn("score", rescored), narrow)


def rerank(candidates: DataFrame, corpus: DataFrame, queries: DataFrame, k: int | Column) -> DataFrame:
    """Re-score the candidates exactly and keep the best ``k``.

    Score: the share of query terms found in the text plus the cosine of the vectors. Only
    candidate rows are fetched from the corpus; the candidates are the small side of that join.
    """
    wanted = candidates.select("query_id", "item_id", F.col("rank").alias("first_rank"))
    asked = queries.select(
        "query_id",
        F.array_distinct(tokens(F.col("text"))).alias("terms"),
        F.col("vector").alias("query_vector"),
        *[c for c in ("final_top_k",) if c in queries.columns],
    )
    rows = corpus.select("item_id", "text", "vector").join(wanted, "item_id").join(asked, "query_id")
    overlap = F.size(F.array_intersect("terms", tokens(F.col("text")))) / F.greatest(F.size("terms"), F.lit(1))
    near = F.coalesce(cosine(F.col("vector"), F.col("query_vector")), F.lit(0.0))
    scored = rows.withColumn("score", F.round(overlap + near, DIGITS))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "item_id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "item_id", "first_rank", "score", "rank")
    )


def guard_model(gold: DataFrame, asked: DataFrame) -> DataFrame:
    """Per ``query_model``: may it search this table? Never if the table holds another or mixed models."""
    held = gold.agg(F.min("embedding_model").alias("index_model"), F.max("embedding_model").alias("_high"))
    only = (F.col("index_model") == F.col("_high")) & (F.col("index_model") == F.col("query_model"))
    return with_single(asked.select("query_model"), held).select("query_model", "index_model", only.alias("allowed"))


def require_model(gold: DataFrame, query_model: str) -> None:
    """Stop before searching when the table holds vectors of another model."""
    asked = gold.sparkSession.createDataFrame([(query_model,)], "query_model string")
    row = guard_model(gold, asked).first()
    if not row["allowed"]:
        raise ValueError(f"index holds vectors of {row['index_model']!r}, query uses {query_model!r}")


def visible_rows(gold: DataFrame, memberships: DataFrame, principal: str) -> DataFrame:
    """Rows whose group is one of the principal's; a row without a group is nobody's."""
    mine = memberships.filter(F.col("principal") == principal).select(F.col("acl_group").alias("resolved_acl_group"))
    return gold.join(mine.distinct(), "resolved_acl_group", "left_semi")


def with_citations(hits: DataFrame, gold: DataFrame, cited: DataFrame) -> DataFrame:
    """Hits with text, heading and one row per source; hits are the small side throughout."""
    rows = gold.select(
        F.col("chunk_id").alias("item_id"), "content_hash", "chunk_text", "section_heading"
    ).join(hits, "item_id")
    return cited.join(rows, "content_hash")


def coverage_gap(old: DataFrame, new: DataFrame) -> DataFrame:
    """Chunks the new index lacks; a cut-over must wait until there is none."""
    return old.select("chunk_id").join(new.select("chunk_id"), "chunk_id", "left_anti")


def topk_overlap(old_hits: DataFrame, new_hits: DataFrame, k: int) -> DataFrame:
    """Per query: how many of the old top-k the new index returns too."""
    old = old_hits.select("query_id", "item_id")
    new = new_hits.select("query_id", "item_id").withColumn("_new", F.lit(1))
    return old.join(new, ["query_id", "item_id"], "left").groupBy("query_id").agg(
        F.count("_new").alias("shared"), F.round(F.count("_new") / F.lit(k), DIGITS).alias("overlap")
    )


def retrieve(gold: DataFrame, requests: DataFrame, config: dict[str, Any], query_model: str) -> DataFrame:
    """Settings, model guard, access filter, wide search, rerank: ``query_id, item_id, score, rank``.

    ``gold`` is the gold table, ``requests`` has ``query_id, text, vector, endpoint_name, groups``.
    Access groups are applied inside both searches, before anything is ranked.
    """
    require_model(gold, query_model)
    corpus = gold.select(
        F.col("chunk_id").alias("item_id"),
        F.col("chunk_text").alias("text"),
        F.col("embedding_vector").alias("vector"),
        F.col("resolved_acl_group").alias("acl_group"),
    )
    settings = resolve_retrieval(requests, config)
    body = config["retrieval"]
    widest = max(r.get("retrieval_top_k", 0) for r in [body["defaults"], *body.get("overrides", [])])
    wanted = settings.select("query_id", "query_type", "retrieval_top_k", "final_top_k", "rerank")

    def within(hits: DataFrame) -> DataFrame:
        return hits.join(wanted.select("query_id", "query_type", "retrieval_top_k"), "query_id").filter(
            F.col("rank") <= F.col("retrieval_top_k")
        )

    dense = within(dense_topk(corpus, settings, widest))
    sparse = within(bm25_topk(corpus, settings.filter("query_type = 'hybrid'"), widest))
    candidates = within(fuse(dense, sparse, widest)).drop("query_type", "retrieval_top_k")
    plain = candidates.join(wanted.filter(~F.col("rerank")), "query_id").filter(F.col("rank") <= F.col("final_top_k"))
    better = rerank(
        candidates.join(wanted.filter("rerank").select("query_id"), "query_id", "left_semi"), corpus, settings, F.col("final_top_k")
    )
    columns = ["query_id", "item_id", "score", "rank"]
    return plain.select(*columns).unionByName(better.select(*columns))
