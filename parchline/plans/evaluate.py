"""Golden set, gate, sampling, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.binding import explode_rows
from ..functions.text import sentences
from ..operators import evaluate, search
from ..sources.tables import stored, table
from .registry import query
from .silver import REQUESTS
from .views import FIXED_CHUNKS, sql_hash_number, sql_strip, sql_time, time_text, typed_view, with_ctes
from .search import requests_view, sql_bm25


def judged_view(spark: SparkSession, folder: str) -> DataFrame:
    """Labels as judged traces of their documents: one row per trace and scorer."""
    traces = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    scores = F.array(
        F.struct(F.lit("correctness").alias("scorer"), F.col("quality").cast("double").alias("score")),
        F.struct(F.lit("safety").alias("scorer"), (1.0 - F.col("toxic")).alias("score")),
    )
    rows = traces.select("doc_id", "lang", "source", F.explode(scores).alias("s"))
    return rows.select("doc_id", F.col("lang").alias("category"), F.col("source").alias("endpoint_name"), "s.scorer", "s.score")


JUDGED = """
judged AS (
  SELECT doc_id, lang AS category, source AS endpoint_name, 'correctness' AS scorer, CAST(quality AS DOUBLE) AS score
  FROM labels JOIN documents USING (doc_id)
  UNION ALL SELECT doc_id, lang, source, 'safety', 1.0::DOUBLE - toxic FROM labels JOIN documents USING (doc_id))
"""


@query(
    "eval_gate",
    with_ctes(
        JUDGED,
        """
        checked AS (
          SELECT t.scorer, t.threshold, round(avg(j.score), 6) AS mean_score, count(j.score) AS scored,
                 coalesce(avg(j.score) >= t.threshold, false) AS passed
          FROM (VALUES ('correctness', 0.85::DOUBLE), ('groundedness', 0.9::DOUBLE), ('safety', 1.0::DOUBLE)) t(scorer, threshold)
          LEFT JOIN judged j USING (scorer) GROUP BY t.scorer, t.threshold)""",
        select="SELECT *, bool_and(passed) OVER () AS gate_open FROM checked",
    ),
)
def eval_gate(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.gate(judged_view(spark, folder))


# A document answers an item if it holds all of the item's sentences: an equi join on sentences.
PLANTED = f"""
item_sentences AS (
  SELECT DISTINCT item_id, t FROM (SELECT item_id, {sql_strip("unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)))")} AS t
                                   FROM benchmark) WHERE t <> ''),
doc_sentences AS (
  SELECT DISTINCT content_hash, t FROM (SELECT content_hash, {sql_strip("unnest(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)))")} AS t
                                        FROM uniq) WHERE t <> ''),
planted AS (
  SELECT item_id AS query_id, content_hash FROM item_sentences JOIN doc_sentences USING (t)
  JOIN (SELECT item_id, count(*) AS n FROM item_sentences GROUP BY item_id) USING (item_id)
  GROUP BY item_id, content_hash, n HAVING count(*) = n)
"""


def planted_view(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items and the contents that hold every sentence of them."""
    items = table(spark, folder, "benchmark").select("item_id", F.array_distinct(sentences(F.col("text"))).alias("s"))
    asked = explode_rows(items.withColumn("n", F.size("s")), "s", "item_id", "n", value="sentence")
    from ..operators.lifecycle import one_per_content

    contents = one_per_content(typed_view(spark, folder)).select(
        "content_hash", F.array_distinct(sentences(F.col("content").cast("string"))).alias("s")
    )
    # The asked sentences are few; boilerplate shared by many documents drops out in the join.
    held = explode_rows(contents, "s", "content_hash", value="sentence").join(asked, "sentence")
    hits = held.groupBy("item_id", "n", "content_hash").agg(F.count("*").alias("found")).filter("found = n")
    return hits.select(F.col("item_id").alias("query_id"), "content_hash")


@query(
    "scorer_plan",
    with_ctes(
        "typed AS (SELECT text, sha256(text) AS content_hash FROM documents), uniq AS (SELECT DISTINCT content_hash, text FROM typed)",
        PLANTED,
        select="""
        SELECT item_id AS query_id, unnest(['chunk_relevance', 'groundedness', 'relevance_to_query', 'safety', 'guideline_adherence']) AS scorer
        FROM benchmark
        UNION ALL
        SELECT query_id, unnest(['context_sufficiency', 'correctness']) FROM (SELECT DISTINCT query_id FROM planted)""",
    ),
)
def scorer_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Items found in some document have an expected answer, the others have none."""
    answers = planted_view(spark, folder).groupBy("query_id").agg(F.min("content_hash").alias("expected_answer"))
    golden = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id")).join(answers, "query_id", "left")
    return evaluate.scorer_plan(golden).select("query_id", "scorer")


@query(
    "retrieval_grade",
    with_ctes(
        FIXED_CHUNKS,
        REQUESTS,
        PLANTED,
        sql_bm25("sparse", 50),
        """
        documents_found AS (
          SELECT query_id, content_hash, CAST(row_number() OVER (PARTITION BY query_id ORDER BY first) AS INTEGER) AS rank FROM (
            SELECT query_id, content_hash, min(rank) AS first FROM sparse JOIN chunks ON chunk_id = item_id GROUP BY query_id, content_hash))""",
        select="""
        SELECT p.query_id, count(*) AS expected, count(d.rank) AS found, round(count(d.rank) / count(*), 6) AS recall_at_k,
               round(count(d.rank) / 10.0, 6) AS precision_at_k, round(coalesce(1.0::DOUBLE / min(d.rank), 0), 6) AS reciprocal_rank
        FROM planted p LEFT JOIN (SELECT * FROM documents_found WHERE rank <= 10) d USING (query_id, content_hash) GROUP BY p.query_id""",
    ),
)
def retrieval_grade(spark: SparkSession, folder: str) -> DataFrame:
    """Keyword search graded on documents: a document ranks where its best chunk does."""
    from .views import chunks_view

    corpus = chunks_view(spark, folder).select(F.col("chunk_id").alias("item_id"), "content_hash", F.col("chunk_text").alias("text"))
    corpus = stored(corpus, "corpus")
    hits = search.bm25_topk(corpus.select("item_id", "text"), requests_view(spark, folder), 50)
    owner = corpus.select("item_id", "content_hash")
    best = hits.join(owner, "item_id").groupBy("query_id", "content_hash").agg(F.min("rank").alias("first"))
    ranked = search.rank_hits(best.select("query_id", F.col("content_hash").alias("item_id"), (-F.col("first")).alias("score")), 10)
    expected = planted_view(spark, folder).select("query_id", F.col("content_hash").alias("item_id"))
    return evaluate.retrieval_grade(ranked, expected, 10)


@query(
    "score_trend",
    with_ctes(
        """
        scored AS (
          SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS category, 'endpoint_' || (user_id % 3) AS endpoint_name, value AS score FROM events)""",
        select="""
        SELECT day, category, endpoint_name, count(*) AS judged, round(CAST(sum(CAST(score AS DECIMAL(28,9))) AS DOUBLE) / count(score), 6) AS mean_score
        FROM scored GROUP BY ROLLUP (day, category, endpoint_name)""",
    ),
)
def score_trend(spark: SparkSession, folder: str) -> DataFrame:
    scored = table(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("endpoint_"), F.col("user_id") % 3).alias("endpoint_name"),
        F.col("value").alias("score"),
    )
    return evaluate.score_trend(scored, "day", ["category", "endpoint_name"])


@query(
    "judge_trend",
    with_ctes(
        JUDGED,
        select="""
        SELECT scorer, category, endpoint_name, count(*) AS judged, round(CAST(sum(CAST(score AS DECIMAL(28,9))) AS DOUBLE) / count(score), 6) AS mean_score
        FROM judged GROUP BY ROLLUP (scorer, category, endpoint_name)""",
    ),
)
def judge_trend(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.score_trend(judged_view(spark, folder), "scorer", ["category", "endpoint_name"])


@query(
    "embedding_drift",
    """
    WITH cells AS (
      SELECT strftime(ts, '%Y-%m-%d') AS day, generate_subscripts(embedding, 1) AS d, unnest(CAST(embedding AS DOUBLE[])) AS v
      FROM embeddings JOIN events ON event_id = vec_id),
    means AS (SELECT day, d, avg(v) AS m FROM cells GROUP BY day, d),
    base AS (SELECT d, m AS b FROM means WHERE day = (SELECT min(day) FROM means)),
    sims AS (SELECT day, round(sum(m * b) / sqrt(sum(m * m) * sum(b * b)), 6) AS similarity FROM means JOIN base USING (d) GROUP BY day)
    SELECT day, similarity, round(1 - similarity, 6) AS drift FROM sims
    """,
)
def embedding_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors dated by the event of the same number."""
    dated = table(spark, folder, "events").select(F.col("event_id").alias("vec_id"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return evaluate.embedding_drift(table(spark, folder, "embeddings").join(dated, "vec_id"), "day", "embedding")


_DAILY = "SELECT event_type AS category, strftime(ts, '%Y-%m-%d') AS day, round(CAST(sum(CAST(value AS DECIMAL(28,9))) AS DOUBLE) / count(value), 6) AS score FROM events GROUP BY 1, 2"


@query(
    "drift_signal",
    f"""
    WITH rolling AS (
      SELECT *, round(avg(score) OVER (PARTITION BY category ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_mean
      FROM ({_DAILY})),
    islands AS (
      SELECT *, sum(CASE WHEN rolling_mean < 10.0 THEN 0 ELSE 1 END) OVER (PARTITION BY category ORDER BY day ROWS UNBOUNDED PRECEDING) AS island
      FROM rolling),
    runs AS (
      SELECT *, CAST(sum(CASE WHEN rolling_mean < 10.0 THEN 1 ELSE 0 END)
                     OVER (PARTITION BY category, island ORDER BY day ROWS UNBOUNDED PRECEDING) AS INTEGER) AS low_run FROM islands)
    SELECT category, day, score, rolling_mean, low_run, low_run >= 3 AS drifting FROM runs
    """,
)
def drift_signal(spark: SparkSession, folder: str) -> DataFrame:
    daily = table(spark, folder, "events").groupBy(
        F.col("event_type").alias("category"), F.date_format("ts", "yyyy-MM-dd").alias("day")
    ).agg(evaluate.exact_mean("value").alias("score"))
    return evaluate.sustained_drift(daily, ["category"], "day", threshold=10.0)


SAMPLED = f"""
drawn AS (SELECT *, {sql_hash_number("CAST(event_id AS VARCHAR)")} AS h FROM events),
sampled AS (
  SELECT event_id FROM drawn WHERE h % 100 < 5
  UNION SELECT arg_min(event_id, h) FROM drawn GROUP BY event_type, user_id)
"""


def sample_view(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.stratified_sample(table(spark, folder, "events"), ["event_type", "user_id"], "event_id", 5)


@query("stratified_sample", with_ctes(SAMPLED, select="SELECT event_id, event_type, user_id FROM events JOIN sampled USING (event_id)"))
def stratified_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sample_view(spark, folder).select("event_id", "event_type", "user_id")


def odd_view(spark: SparkSession, folder: str) -> DataFrame:
    """Errors, and events whose value (in cents) is unusually low or high."""
    events = table(spark, folder, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    return evaluate.always_evaluate(events, "cents", F.col("event_type") == "error").drop("cents")


@query(
    "always_evaluate",
    with_ctes(
        SAMPLED,
        """
        cents AS (SELECT event_id, event_type, CAST(round(value * 100) AS BIGINT) AS c FROM events),
        fence AS (SELECT quantile_cont(c, 0.25) AS q1, quantile_cont(c, 0.75) AS q3 FROM cents),
        odd AS (SELECT event_id FROM cents, fence WHERE event_type = 'error' OR c < q1 - 1.5 * (q3 - q1) OR c > q3 + 1.5 * (q3 - q1))""",
        select="SELECT event_id FROM sampled UNION SELECT event_id FROM odd",
    ),
)
def always_evaluate(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.evaluation_set(sample_view(spark, folder), odd_view(spark, folder), "event_id").select("event_id")


@query(
    "safety_breach",
    f"""
    SELECT {sql_time("date_trunc('hour', ts)")} AS window_start, count(*) AS breaches FROM events
    WHERE event_type = 'error' AND value > 20 GROUP BY 1
    """,
)
def safety_breach(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    breaches = evaluate.breach_windows(events, "ts", (F.col("event_type") == "error") & (F.col("value") > 20))
    return breaches.withColumn("window_start", time_text("window_start"))


_APPROVALS = """
versions AS (
  SELECT source, doc_id, lang, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS INTEGER) AS version,
         doc_id AS valid_from, lead(doc_id) OVER (PARTITION BY lang, source ORDER BY doc_id) AS valid_to
  FROM labels JOIN documents USING (doc_id) WHERE quality = 1)
"""


def versions_view(spark: SparkSession, folder: str) -> DataFrame:
    """Labels as reviews of a question per language and source; quality 1 is an approval."""
    reviews = table(spark, folder, "labels").join(table(spark, folder, "documents").select("doc_id", "lang", "source"), "doc_id")
    keyed = reviews.withColumn("question", F.concat_ws("/", "lang", "source"))
    return evaluate.golden_versions(keyed, "question", F.col("quality") == 1, "doc_id")


@query(
    "golden_versions",
    with_ctes(
        _APPROVALS,
        select="SELECT lang || '/' || source AS question, doc_id, version, valid_from, coalesce(valid_to, -1) AS valid_to FROM versions",
    ),
)
def golden_versions(spark: SparkSession, folder: str) -> DataFrame:
    return versions_view(spark, folder).select(
        "question", "doc_id", "version", "valid_from", F.coalesce("valid_to", F.lit(-1)).alias("valid_to")
    )


@query(
    "golden_as_of",
    with_ctes(
        _APPROVALS,
        select="""
        SELECT lang || '/' || source AS question, doc_id, version FROM versions
        WHERE valid_from <= 100 AND (valid_to IS NULL OR valid_to > 100)""",
    ),
)
def golden_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.golden_as_of(versions_view(spark, folder), F.lit(100)).select("question", "doc_id", "version")
