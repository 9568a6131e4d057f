"""Batch retrieval over given vectors and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.vector import hash_embedding
from ..operators import search
from ..operators.rules import RETRIEVAL_RULES
from ..sources.tables import stored, table
from .gold import CONTENT_ACL, MODEL, VECTORS, gold_view
from .registry import query
from .silver import REQUESTS, requests_view
from .views import ACL_MAP, FIXED_CHUNKS, INSTANCES, sql_tokens, with_ctes

K = 20

# --- dense over the embeddings table --------------------------------------------------------------


def probes_view(spark: SparkSession, folder: str) -> DataFrame:
    """One query vector per label: the mean of its vectors."""
    from ..operators.evaluate import mean_vectors

    means = mean_vectors(table(spark, folder, "embeddings"), ["label"], "embedding")
    return means.select(F.col("label").cast("bigint").alias("query_id"), F.col("mean").alias("vector"))


def vectors_view(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.lpad(F.col("vec_id").cast("string"), 12, "0").alias("item_id"), F.col("embedding").alias("vector"), "label"
    )


PROBES = """
items AS (SELECT lpad(CAST(vec_id AS VARCHAR), 12, '0') AS item_id, CAST(embedding AS DOUBLE[]) AS vector, label FROM embeddings),
probes AS (
  SELECT query_id, list(m ORDER BY d) AS vector FROM (
    SELECT CAST(label AS BIGINT) AS query_id, d, avg(v) AS m FROM (
      SELECT label, generate_subscripts(vector, 1) AS d, unnest(vector) AS v FROM items) GROUP BY label, d)
  GROUP BY query_id)
"""


def sql_dense(name: str, items: str, queries: str, k: int, where: str = "true") -> str:
    return f"""
    {name} AS (
      SELECT * FROM (
        SELECT query_id, item_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
        FROM (SELECT q.query_id, i.item_id,
                     round(coalesce(list_dot_product(q.vector, i.vector)
                           / nullif(sqrt(list_dot_product(q.vector, q.vector)) * sqrt(list_dot_product(i.vector, i.vector)), 0), 0), 6) AS score
              FROM {queries} q, {items} i WHERE {where}))
      WHERE rank <= {k})"""


@query(
    "dense_topk",
    with_ctes(PROBES, sql_dense("dense", "items", "probes", K), select="SELECT query_id, item_id, score, rank FROM dense"),
)
def dense_topk(spark: SparkSession, folder: str) -> DataFrame:
    return search.dense_topk(vectors_view(spark, folder), probes_view(spark, folder), K)


# --- text search over chunks ----------------------------------------------------------------------


def corpus_view(spark: SparkSession, folder: str) -> DataFrame:
    from .views import chunks_view

    return chunks_view(spark, folder).select(F.col("chunk_id").alias("item_id"), F.col("chunk_text").alias("text"))


def embedded_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk table with vectors, stored: every search below reads it more than once."""
    return stored(corpus_view(spark, folder).withColumn("vector", hash_embedding(F.col("text"))), "corpus")


def embedded_requests(spark: SparkSession, folder: str) -> DataFrame:
    return requests_view(spark, folder).withColumn("vector", hash_embedding(F.col("text")))


TEXTS = """
texts AS (
  SELECT 'c' || chunk_id AS id, chunk_text AS text FROM chunks
  UNION ALL SELECT 'q' || query_id, text FROM requests)
"""
EMBEDDED = """
items AS (SELECT substr(id, 2) AS item_id, CAST(vector AS DOUBLE[]) AS vector FROM vectors WHERE id LIKE 'c%'),
asked AS (SELECT CAST(substr(id, 2) AS BIGINT) AS query_id, CAST(vector AS DOUBLE[]) AS vector FROM vectors WHERE id LIKE 'q%')
"""


def sql_bm25(name: str, k: int, where: str = "true") -> str:
    return f"""
    words AS (SELECT chunk_id AS item_id, unnest({sql_tokens("chunk_text")}) AS term FROM chunks),
    lens AS (SELECT chunk_id AS item_id, len({sql_tokens("chunk_text")}) AS len FROM chunks),
    stats AS (SELECT count(*) AS n, avg(len) AS mean FROM lens),
    tfs AS (SELECT item_id, term, count(*) AS tf FROM words GROUP BY item_id, term),
    dfs AS (SELECT term, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tfs, stats GROUP BY term, n),
    qterms AS (SELECT DISTINCT query_id, unnest({sql_tokens("text")}) AS term FROM requests),
    {name}_scores AS (
      SELECT query_id, item_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len / mean))), 6) AS score
      FROM qterms JOIN tfs USING (term) JOIN dfs USING (term) JOIN lens USING (item_id), stats WHERE {where} GROUP BY query_id, item_id),
    {name} AS (
      SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
                     FROM {name}_scores) WHERE rank <= {k})"""


@query(
    "bm25_topk",
    with_ctes(FIXED_CHUNKS, REQUESTS, sql_bm25("sparse", K), select="SELECT query_id, item_id, score, rank FROM sparse"),
)
def bm25_topk(spark: SparkSession, folder: str) -> DataFrame:
    return search.bm25_topk(stored(corpus_view(spark, folder), "corpus"), requests_view(spark, folder), K)


def sql_fuse(name: str, dense: str, sparse: str, k: int) -> str:
    return f"""
    {name} AS (
      SELECT * FROM (
        SELECT query_id, item_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
        FROM (SELECT query_id, item_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score
              FROM (SELECT query_id, item_id, rank FROM {dense} UNION ALL SELECT query_id, item_id, rank FROM {sparse})
              GROUP BY query_id, item_id))
      WHERE rank <= {k})"""


HYBRID = [
    FIXED_CHUNKS,
    REQUESTS,
    TEXTS,
    VECTORS,
    EMBEDDED,
    sql_dense("dense", "items", "asked", K),
    sql_bm25("sparse", K),
    sql_fuse("fused", "dense", "sparse", K),
]


def hybrid_hits(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    corpus, requests = embedded_corpus(spark, folder), embedded_requests(spark, folder)
    dense = search.dense_topk(corpus, requests, K)
    sparse = search.bm25_topk(corpus.select("item_id", "text"), requests, K)
    return search.fuse(dense, sparse, K), corpus, requests


@query("hybrid_topk", with_ctes(*HYBRID, select="SELECT query_id, item_id, score, rank FROM fused"))
def hybrid_topk(spark: SparkSession, folder: str) -> DataFrame:
    return hybrid_hits(spark, folder)[0]


def sql_rerank(name: str, candidates: str, k: str) -> str:
    return f"""
    {name} AS (
      SELECT * FROM (
        SELECT query_id, item_id, first_rank, score,
               CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
        FROM (SELECT f.query_id, f.item_id, f.rank AS first_rank, round(
                CAST(len(list_intersect(list_distinct({sql_tokens("r.text")}), list_distinct({sql_tokens("c.chunk_text")}))) AS DOUBLE)
                / greatest(len(list_distinct({sql_tokens("r.text")})), 1)
                + coalesce(list_dot_product(a.vector, i.vector)
                  / nullif(sqrt(list_dot_product(a.vector, a.vector) * list_dot_product(i.vector, i.vector)), 0), 0), 6) AS score
              FROM {candidates} f JOIN requests r USING (query_id) JOIN chunks c ON c.chunk_id = f.item_id
              JOIN items i ON i.item_id = f.item_id JOIN asked a ON a.query_id = f.query_id))
      WHERE rank <= {k})"""


@query(
    "rerank",
    with_ctes(*HYBRID, sql_rerank("better", "fused", "5"), select="SELECT query_id, item_id, first_rank, score, rank FROM better"),
)
def rerank(spark: SparkSession, folder: str) -> DataFrame:
    fused, corpus, requests = hybrid_hits(spark, folder)
    return search.rerank(fused, corpus, requests, 5)


@query(
    "two_stage_topk",
    with_ctes(
        PROBES,
        sql_dense("dense", "items", "probes", K),
        select="""
        SELECT * FROM (
          SELECT query_id, item_id, first_rank, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank
          FROM (SELECT query_id, item_id, rank AS first_rank, CASE WHEN label = query_id THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS score
                FROM dense JOIN items USING (item_id))) WHERE rank <= 5""",
    ),
)
def two_stage_topk(spark: SparkSession, folder: str) -> DataFrame:
    """Wide by cosine, then narrow by whether the item carries the query's label."""
    items = vectors_view(spark, folder)
    hits = search.dense_topk(items, probes_view(spark, folder), K).join(items.select("item_id", "label"), "item_id")
    same = (F.col("label").cast("bigint") == F.col("query_id")).cast("double")
    return search.two_stage(hits, K, 5, same).select("query_id", "item_id", "first_rank", "score", "rank")


# --- access, model guard, whole flow ----------------------------------------------------------------


def memberships_view(spark: SparkSession, folder: str) -> DataFrame:
    """Reader n belongs to the first n + 1 regions' groups."""
    region = table(spark, folder, "region")
    reach = region.select(
        F.concat(F.lit("reader-"), "r_regionkey").alias("principal"),
        F.explode(F.sequence(F.lit(0), F.col("r_regionkey"))).alias("r_regionkey"),
    )
    return reach.join(region, "r_regionkey").select("principal", F.col("r_name").alias("acl_group"))


MEMBERSHIPS = """
memberships AS (
  SELECT 'reader-' || a.r_regionkey AS principal, b.r_name AS acl_group FROM region a JOIN region b ON b.r_regionkey <= a.r_regionkey)
"""


@query(
    "acl_prefilter",
    with_ctes(
        FIXED_CHUNKS,
        ACL_MAP,
        INSTANCES,
        CONTENT_ACL,
        MEMBERSHIPS,
        select="""
        SELECT chunk_id, resolved_acl_group FROM chunks JOIN content_acl USING (content_hash)
        WHERE resolved_acl_group IN (SELECT acl_group FROM memberships WHERE principal = 'reader-1')""",
    ),
)
def acl_prefilter(spark: SparkSession, folder: str) -> DataFrame:
    gold = gold_view(spark, folder).select("chunk_id", "resolved_acl_group")
    return search.visible_rows(gold, memberships_view(spark, folder), "reader-1")


@query(
    "model_guard",
    """
    SELECT lang AS query_model, 'fr' AS index_model, lang = 'fr' AS allowed FROM documents GROUP BY lang
    """,
)
def model_guard(spark: SparkSession, folder: str) -> DataFrame:
    """An index over the French documents, asked by a model per language."""
    documents = table(spark, folder, "documents")
    index = documents.filter("lang = 'fr'").select(F.col("lang").alias("embedding_model"))
    return search.guard_model(index, documents.select(F.col("lang").alias("query_model")).distinct())


@query(
    "model_guard_mixed",
    """
    SELECT lang AS query_model, low AS index_model, low = high AND lang = low AS allowed
    FROM (SELECT DISTINCT lang FROM documents), (SELECT min(lang) AS low, max(lang) AS high FROM documents)
    """,
)
def model_guard_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """An index over all documents, whose vectors come from several models: nobody may search it."""
    documents = table(spark, folder, "documents")
    index = documents.select(F.col("lang").alias("embedding_model"))
    return search.guard_model(index, documents.select(F.col("lang").alias("query_model")).distinct())


def asking_view(spark: SparkSession, folder: str) -> DataFrame:
    """Requests with vectors and the groups of their reader (by request number)."""
    groups = memberships_view(spark, folder).groupBy("principal").agg(F.collect_set("acl_group").alias("groups"))
    reader = F.concat(F.lit("reader-"), (F.col("query_id") % 5).cast("string")).alias("principal")
    return embedded_requests(spark, folder).select("*", reader).join(groups, "principal").drop("principal")


RETRIEVED = [
    FIXED_CHUNKS,
    ACL_MAP,
    INSTANCES,
    CONTENT_ACL,
    MEMBERSHIPS,
    REQUESTS,
    TEXTS,
    VECTORS,
    """
    items AS (SELECT substr(id, 2) AS item_id, CAST(vector AS DOUBLE[]) AS vector FROM vectors WHERE id LIKE 'c%'),
    asked AS (SELECT CAST(substr(id, 2) AS BIGINT) AS query_id, CAST(vector AS DOUBLE[]) AS vector FROM vectors WHERE id LIKE 'q%'),
    limits AS (SELECT query_id, CASE endpoint_name WHEN 'deep-research-tool' THEN 50 ELSE 20 END AS wide,
                      CASE endpoint_name WHEN 'deep-research-tool' THEN 10 WHEN 'quick-lookup-bot' THEN 3 ELSE 5 END AS narrow
               FROM requests),
    visible AS (
      SELECT query_id, chunk_id AS item_id FROM requests r JOIN memberships m ON m.principal = 'reader-' || (query_id % 5)
      JOIN content_acl ON resolved_acl_group = acl_group JOIN chunks USING (content_hash))""",
    sql_dense("dense", "items", "asked", 50, "(q.query_id, i.item_id) IN (SELECT query_id, item_id FROM visible)"),
    sql_bm25("sparse", 50, "(query_id, item_id) IN (SELECT query_id, item_id FROM visible)"),
    """
    dense_wide AS (SELECT d.* FROM dense d JOIN limits USING (query_id) WHERE rank <= wide),
    sparse_wide AS (SELECT s.* FROM sparse s JOIN limits USING (query_id) WHERE rank <= wide)""",
    sql_fuse("fused", "dense_wide", "sparse_wide", 50),
    "candidates AS (SELECT f.* FROM fused f JOIN limits USING (query_id) WHERE rank <= wide)",
    sql_rerank("better", "candidates", "50"),
]


def retrieved(spark: SparkSession, folder: str, **defaults) -> tuple[DataFrame, DataFrame]:
    """Gold and its hits, under the retrieval rules with some defaults changed."""
    body = RETRIEVAL_RULES["retrieval"]
    config = {"retrieval": {**body, "defaults": {**body["defaults"], **defaults}}}
    # Gold is a table: both searches, the rerank and the citation join read it, none recomputes it.
    gold = stored(gold_view(spark, folder), "gold")
    return gold, search.retrieve(gold, asking_view(spark, folder), config, MODEL)


@query(
    "retrieve_dense_only",
    with_ctes(
        *RETRIEVED[:-3],
        "candidates AS (SELECT * FROM dense_wide)",
        sql_rerank("better", "candidates", "50"),
        select="SELECT query_id, item_id, rank, score FROM better JOIN limits USING (query_id) WHERE rank <= narrow",
    ),
)
def retrieve_dense_only(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors alone find the candidates; they are reranked as usual."""
    return retrieved(spark, folder, query_type="dense")[1].select("query_id", "item_id", "rank", "score")


@query(
    "retrieve_no_rerank",
    with_ctes(
        *RETRIEVED[:-1],
        select="SELECT query_id, item_id, rank, score FROM candidates JOIN limits USING (query_id) WHERE rank <= narrow",
    ),
)
def retrieve_no_rerank(spark: SparkSession, folder: str) -> DataFrame:
    """Hybrid search whose fused order is final."""
    return retrieved(spark, folder, rerank=False)[1].select("query_id", "item_id", "rank", "score")


@query(
    "retrieve_batch",
    with_ctes(
        *RETRIEVED,
        select="""
        SELECT b.query_id, b.item_id, b.rank, b.score, source_path, file_name
        FROM better b JOIN limits USING (query_id) JOIN chunks ON chunk_id = item_id JOIN instances USING (content_hash)
        WHERE b.rank <= narrow""",
    ),
)
def retrieve_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Settings, guard, access, hybrid search, rerank and one row per hit and citation."""
    from ..operators.gold import citations
    from .views import instances_view

    gold, hits = retrieved(spark, folder)
    cited = search.with_citations(hits, gold, citations(instances_view(spark, folder)))
    return cited.select("query_id", "item_id", "rank", "score", "source_path", "file_name")


@query(
    "bluegreen_compare",
    with_ctes(
        PROBES,
        """
        halves AS (SELECT item_id, vector[1:32] AS vector FROM items),
        half_probes AS (SELECT query_id, vector[1:32] AS vector FROM probes)""",
        sql_dense("blue", "items", "probes", K),
        sql_dense("green", "halves", "half_probes", K),
        select=f"""
        SELECT query_id, count(g.item_id) AS shared, round(count(g.item_id) / {float(K)}, 6) AS overlap
        FROM blue b LEFT JOIN green g USING (query_id, item_id) GROUP BY query_id""",
    ),
)
def bluegreen_compare(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors against a second model that keeps half of their dimensions."""
    items, probes = vectors_view(spark, folder), probes_view(spark, folder)
    half = F.slice("vector", 1, 32)
    blue = search.dense_topk(items, probes, K)
    green = search.dense_topk(items.withColumn("vector", half), probes.withColumn("vector", half), K)
    return search.topk_overlap(blue, green, K)


@query(
    "migration_coverage",
    with_ctes(
        FIXED_CHUNKS,
        select="SELECT chunk_id FROM chunks WHERE content_hash NOT IN (SELECT content_hash FROM typed JOIN labels USING (doc_id))",
    ),
)
def migration_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks a half-finished re-embedding (labelled content only) still lacks."""
    from .lifecycle import labelled
    from .views import chunks_view, typed_view

    chunks = chunks_view(spark, folder).select("chunk_id", "content_hash")
    done = labelled(spark, folder, typed_view(spark, folder), True).select("content_hash").distinct()
    return search.coverage_gap(chunks, chunks.join(done, "content_hash", "left_semi"))
