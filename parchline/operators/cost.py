"""Chargeback and cost reports."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import with_single


def chargeback(usage: DataFrame, dims: list[str]) -> DataFrame:
    """Cost by the dimensions and all their prefixes (a roll-up)."""
    return usage.rollup(*dims).agg(
        F.count("*").alias("records"), F.round(F.sum("cost"), 2).alias("total_cost")
    )


def storage_by_team(bronze: DataFrame, team: str = "source_classification_tag") -> DataFrame:
    return bronze.groupBy(team).agg(
        F.count("*").alias("files"), F.sum("file_size").cast("bigint").alias("stored_bytes")
    )


def cost_by_endpoint(requests: DataFrame, rates: dict[str, float]) -> DataFrame:
    """Request cost per endpoint: each optional step adds its rate where the endpoint uses it.

    Serving hours are paid per index, not per endpoint, so endpoints of one index share them.
    """
    step = F.lit(float(rates["search"]))
    for setting in ("rerank", "query_rewrite"):
        step = step + F.when(F.col(setting), F.lit(float(rates[setting]))).otherwise(0.0)
    return requests.groupBy("endpoint_name").agg(
        F.count("*").alias("requests"), F.round(F.sum(step), 6).alias("request_cost")
    )


def shared_serving_cost(by_endpoint: DataFrame, hours: float, hourly_rate: float) -> DataFrame:
    """Split an index's serving hours over its endpoints by their share of requests."""
    joined = with_single(by_endpoint, by_endpoint.agg(F.sum("requests").alias("_total")))
    return joined.select(
        "endpoint_name",
        "requests",
        "request_cost",
        F.round(F.col("requests") / F.col("_total") * F.lit(hours * hourly_rate), 6).alias("serving_cost"),
    )


def migration_cost(chunks: DataFrame, rate_per_1000: float, dims: tuple[str, ...] = ()) -> DataFrame:
    """What re-embedding the active chunks would cost, before doing it."""
    tokens = F.sum("token_count").cast("bigint")
    return chunks.groupBy(*dims).agg(
        F.count("*").alias("chunks"),
        tokens.alias("tokens"),
        F.round(tokens * F.lit(rate_per_1000) / 1000, 6).alias("estimated_cost"),
    )


def method_cost_mix(chunks: DataFrame, rates: dict[str, float]) -> DataFrame:
    """Token cost by extraction and chunking method; unlisted methods cost nothing extra."""
    rate: Any = F.lit(0.0)
    for method, value in rates.items():
        named = (F.col("extraction_method_used") == method) | (F.col("chunking_method_used") == method)
        rate = rate + F.when(named, F.lit(float(value))).otherwise(0.0)
    cost: Column = F.sum(F.col("token_count") * rate) / 1000
    return chunks.groupBy("extraction_method_used", "chunking_method_used").agg(
        F.sum("token_count").cast("bigint").alias("tokens"), F.round(cost, 6).alias("cost")
    )
