"""Monitoring reports and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def table_metrics(bronze: DataFrame) -> DataFrame:
    status = F.col("processing_status")
    return bronze.agg(
        F.count("*").alias("total_files"),
        F.count_distinct("file_type").alias("unique_file_types"),
        F.sum("file_size").alias("total_size_bytes"),
        F.max("ingestion_timestamp").alias("latest_ingestion"),
        F.min("ingestion_timestamp").alias("first_ingestion"),
        F.count_if(status == "valid").alias("valid_files"),
        F.count_if(status != "valid").alias("invalid_files"),
    )


def file_type_distribution(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("file_type", "processing_status")
        .agg(
            F.count("*").alias("file_count"),
            F.sum("file_size").alias("total_size_bytes"),
            F.avg("file_size").alias("avg_size_bytes"),
        )
        .orderBy(F.desc("file_count"))
    )


def ingestion_timeline(bronze: DataFrame, now: Column | None = None, days: int = 7) -> DataFrame:
    """Hourly capture counts over the last days before ``now`` (a literal, so the scan can prune)."""
    until = F.current_timestamp() if now is None else now
    status = F.col("processing_status")
    return (
        bronze.filter(F.col("ingestion_timestamp") >= until - F.expr(f"interval {int(days)} days"))
        .groupBy(F.date_trunc("hour", "ingestion_timestamp").alias("ingestion_hour"))
        .agg(
            F.count("*").alias("files_ingested"),
            F.sum("file_size").alias("total_size_bytes"),
            F.count_if(status == "valid").alias("valid_files"),
            F.count_if(status != "valid").alias("invalid_files"),
        )
        .orderBy(F.desc("ingestion_hour"))
    )


def recent_events(log: DataFrame, event_types: tuple[str, ...], limit: int = 100, tie: str | None = None) -> DataFrame:
    """The newest log entries of some types, with the flow named in their JSON details."""
    order = [F.desc("timestamp"), *([F.desc(tie)] if tie else [])]
    return (
        log.filter(F.col("event_type").isin(*event_types))
        .orderBy(*order)
        .limit(limit)
        .select(
            *([tie] if tie else []),
            "timestamp",
            "event_type",
            "level",
            "message",
            F.get_json_object("details", "$.flow_name").alias("flow_name"),
            F.get_json_object("details", "$.flow_type").alias("flow_type"),
        )
    )


def threshold_alert(metrics: DataFrame, metric: str, threshold: float | Column) -> DataFrame:
    limit = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    return metrics.select(
        F.lit(metric).alias("metric"),
        F.col(metric).cast("double").alias("value"),
        limit.alias("threshold"),
        (F.col(metric) > limit).alias("breached"),
    )


def failure_rate(extracted: DataFrame) -> DataFrame:
    failed = F.coalesce(F.col("extraction_status") != "success", F.lit(True))
    return extracted.groupBy("extraction_method_used").agg(
        F.count("*").alias("documents"),
        F.count_if(failed).alias("failed"),
        F.round(F.count_if(failed) / F.count("*"), 6).alias("failure_rate"),
    )


def method_usage(df: DataFrame, method: str) -> DataFrame:
    """Rows and share per method; the total is a window over the few aggregated rows."""
    counts = df.groupBy(method).agg(F.count("*").alias("uses"))
    total = F.sum("uses").over(Window.partitionBy())
    return counts.select(method, "uses", F.round(F.col("uses") / total, 6).alias("share"))


def quartile_fences(df: DataFrame, value: str, reach: float = 1.5, keys: tuple[str, ...] = ()) -> DataFrame:
    """Exact quartile fences of an integer column, per key.

    Exact percentiles of an integer are taken over its distinct values and their counts, which
    partial aggregation reduces map-side.
    """
    q1, q3 = F.percentile(value, F.lit(0.25)), F.percentile(value, F.lit(0.75))
    return df.groupBy(*keys).agg(q1.alias("_q1"), q3.alias("_q3")).select(
        *keys,
        (F.col("_q1") - reach * (F.col("_q3") - F.col("_q1"))).alias("low_fence"),
        (F.col("_q3") + reach * (F.col("_q3") - F.col("_q1"))).alias("high_fence"),
    )


def token_outliers(chunks: DataFrame, key: str = "chunking_method_used") -> DataFrame:
    """Chunks whose token count lies outside the fences of their method.

    There is one fence row per method, a closed vocabulary, so AQE broadcasts that side.
    """
    fences = quartile_fences(chunks, "token_count", keys=(key,))
    return chunks.join(fences, key).filter(
        (F.col("token_count") < F.col("low_fence")) | (F.col("token_count") > F.col("high_fence"))
    )


def flag(df: DataFrame, expectations: dict[str, Column]) -> DataFrame:
    """Keep every row; one boolean column per expectation (NULL counts as failed)."""
    return df.withColumns({name: F.coalesce(cond, F.lit(False)) for name, cond in expectations.items()})


def expectation_report(df: DataFrame, expectations: dict[str, Column]) -> DataFrame:
    """``expectation, passed, failed`` for all expectations in one pass."""
    flags = flag(df, expectations)
    names = list(expectations)
    counts = flags.agg(
        *[F.count_if(F.col(n)).alias(f"p{i}") for i, n in enumerate(names)],
        *[F.count_if(~F.col(n)).alias(f"f{i}") for i, n in enumerate(names)],
    )
    rows = [
        F.struct(F.lit(n).alias("expectation"), F.col(f"p{i}").alias("passed"), F.col(f"f{i}").alias("failed"))
        for i, n in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def enforce(df: DataFrame, expectations: dict[str, Column], mode: str) -> DataFrame:
    """``warn`` keeps and flags, ``drop`` filters, ``fail`` stops the job at the first bad row."""
    if mode == "warn":
        return flag(df, expectations)
    if mode == "drop":
        for cond in expectations.values():
            df = df.filter(cond)
        return df
    if mode != "fail":
        raise ValueError(f"no such mode: {mode}")
    for name, cond in expectations.items():
        # assert_true gives NULL when it holds, so the filter keeps the row and cannot be pruned.
        df = df.filter(F.assert_true(F.coalesce(cond, F.lit(False)), F.lit(f"expectation failed: {name}")).isNull())
    return df
