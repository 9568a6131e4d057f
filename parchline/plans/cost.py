"""Chargeback and cost."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import cost
from ..operators.lifecycle import active_chunks
from ..operators.rules import resolve_retrieval
from ..sources.tables import table
from .lifecycle import reconciled
from .registry import query
from .silver import DISPATCHED, REQUESTS, requests_view
from .views import FIXED_CHUNKS, LIVE, chunks_view, dispatched_view, sql_approx_tokens, typed_view, with_ctes


@query(
    "chargeback",
    """
    SELECT n_name AS usage_policy_id, l_returnflag AS resource, strftime(l_shipdate, '%Y-%m') AS period, count(*) AS records,
           round(sum(l_extendedprice), 2) AS total_cost
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    GROUP BY ROLLUP (usage_policy_id, resource, period)
    """,
)
def chargeback(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
    owner = supplier.join(table(spark, folder, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    usage = table(spark, folder, "lineitem").join(owner, "l_suppkey").select(
        F.col("n_name").alias("usage_policy_id"),
        F.col("l_returnflag").alias("resource"),
        F.date_format("l_shipdate", "yyyy-MM").alias("period"),
        F.col("l_extendedprice").alias("cost"),
    )
    return cost.chargeback(usage, ["usage_policy_id", "resource", "period"])


@query(
    "storage_by_team",
    "SELECT source AS team, count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS stored_bytes FROM documents GROUP BY source",
)
def storage_by_team(spark: SparkSession, folder: str) -> DataFrame:
    return cost.storage_by_team(typed_view(spark, folder)).withColumnRenamed("source_classification_tag", "team")


RATES = {"search": 0.002, "rerank": 0.001, "query_rewrite": 0.003}


@query(
    "cost_by_endpoint",
    with_ctes(
        REQUESTS,
        """
        costs AS (SELECT endpoint_name, count(*) AS requests,
                         round(sum(0.002::DOUBLE + 0.001::DOUBLE + CASE WHEN endpoint_name = 'quick-lookup-bot' THEN 0.0::DOUBLE ELSE 0.003::DOUBLE END), 6) AS request_cost
                  FROM requests GROUP BY endpoint_name)""",
        select="SELECT *, round(requests / sum(requests) OVER () * 12.0, 6) AS serving_cost FROM costs",
    ),
)
def cost_by_endpoint(spark: SparkSession, folder: str) -> DataFrame:
    settings = resolve_retrieval(requests_view(spark, folder))
    return cost.shared_serving_cost(cost.cost_by_endpoint(settings, RATES), hours=24, hourly_rate=0.5)


@query(
    "migration_cost",
    with_ctes(
        FIXED_CHUNKS,
        LIVE,
        select="""
        SELECT count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS tokens, round(sum(token_count) * 0.13::DOUBLE / 1000, 6) AS estimated_cost
        FROM chunks WHERE content_hash IN (SELECT content_hash FROM typed JOIN live ON path = source_path)""",
    ),
)
def migration_cost(spark: SparkSession, folder: str) -> DataFrame:
    return cost.migration_cost(active_chunks(chunks_view(spark, folder), reconciled(spark, folder)), 0.13)


@query(
    "method_cost_mix",
    with_ctes(
        DISPATCHED,
        f"""
        priced AS (
          SELECT extraction_method_used, method, {sql_approx_tokens("piece")} AS n,
                 CASE extraction_method_used WHEN 'azure_document_intelligence_ocr' THEN 1.5::DOUBLE ELSE 0.0::DOUBLE END
                 + CASE method WHEN 'semantic_split' THEN 0.25::DOUBLE ELSE 0.0::DOUBLE END AS rate
          FROM dispatched JOIN extracted USING (content_hash))""",
        select="""
        SELECT extraction_method_used, method AS chunking_method_used, CAST(sum(n) AS BIGINT) AS tokens, round(sum(n * rate) / 1000, 6) AS cost
        FROM priced GROUP BY ALL""",
    ),
)
def method_cost_mix(spark: SparkSession, folder: str) -> DataFrame:
    rates = {"azure_document_intelligence_ocr": 1.5, "semantic_split": 0.25}
    return cost.method_cost_mix(dispatched_view(spark, folder), rates)
