"""Golden set, scoring gate, sampling of production traffic, drift."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.binding import with_single
from ..functions.identity import hash_number
from ..functions.vector import cosine
from .monitor import quartile_fences
from .ordered import running

# The judges, those that need an expected answer, and the gate thresholds.
DEFAULT_SCORERS = ("chunk_relevance", "groundedness", "relevance_to_query", "safety", "guideline_adherence")
GROUND_TRUTH_SCORERS = ("context_sufficiency", "correctness")
THRESHOLDS = {"correctness": 0.85, "groundedness": 0.90, "safety": 1.0}


def scorer_plan(golden: DataFrame, custom: Iterable[str] = ()) -> DataFrame:
    """One row per golden question and scorer that applies to it."""
    always = F.array(*[F.lit(s) for s in (*DEFAULT_SCORERS, *custom)])
    extra = F.array(*[F.lit(s) for s in GROUND_TRUTH_SCORERS])
    chosen = F.when(F.col("expected_answer").isNull(), always).otherwise(F.concat(always, extra))
    return golden.select(*golden.columns, F.explode(chosen).alias("scorer"))


def gate(scores: DataFrame, thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """Mean per scorer against its threshold; ``gate_open`` is false if any misses.

    A scorer with a threshold but no score counts as a miss. The thresholds are a short literal.
    """
    table = F.inline(
        F.array(*[F.struct(F.lit(s).alias("scorer"), F.lit(float(t)).alias("threshold")) for s, t in thresholds.items()])
    )
    limits = scores.sparkSession.range(1).select(table)
    means = scores.groupBy("scorer").agg(F.avg("score").alias("mean_score"), F.count("score").alias("scored"))
    checked = limits.join(means, "scorer", "left").select(
        "scorer",
        "threshold",
        F.round("mean_score", 6).alias("mean_score"),
        F.coalesce("scored", F.lit(0)).alias("scored"),
        F.coalesce(F.col("mean_score") >= F.col("threshold"), F.lit(False)).alias("passed"),
    )
    return checked.withColumn("gate_open", F.bool_and("passed").over(Window.partitionBy()))


def retrieval_grade(hits: DataFrame, expected: DataFrame, k: int) -> DataFrame:
    """Recall, precision at k and reciprocal rank per question with expected items.

    ``hits`` has ``query_id, item_id, rank``, ``expected`` has ``query_id, item_id``.
    """
    want = expected.select("query_id", "item_id").distinct()
    graded = want.join(hits.filter(F.col("rank") <= k).select("query_id", "item_id", "rank"), ["query_id", "item_id"], "left")
    found = F.count("rank")
    return graded.groupBy("query_id").agg(
        F.count("*").alias("expected"),
        found.alias("found"),
        F.round(found / F.count("*"), 6).alias("recall_at_k"),
        F.round(found / F.lit(k), 6).alias("precision_at_k"),
        F.round(F.coalesce(1.0 / F.min("rank"), F.lit(0.0)), 6).alias("reciprocal_rank"),
    )


def score_trend(judged: DataFrame, period: str, dims: list[str]) -> DataFrame:
    """Mean score per period and every prefix of the dimensions (a roll-up)."""
    return judged.rollup(period, *dims).agg(F.count("*").alias("judged"), exact_mean("score").alias("mean_score"))


def exact_mean(score: str) -> Column:
    """Mean of scores to nine decimal places, rounded to six: exact sums, so the order of rows is without effect."""
    exact = F.sum(F.col(score).cast("decimal(28,9)")).cast("double")
    return F.round(exact / F.count(score), 6)


def sustained_drift(trend: DataFrame, keys: list[str], period: str, threshold: float, window: int = 7, run: int = 3) -> DataFrame:
    """Rolling mean per series and whether it has been low for ``run`` periods in a row.

    The input has one row per series and period, so a series is as long as its calendar.
    """
    series = Window.partitionBy(*keys).orderBy(period)
    rolling = trend.withColumn("rolling_mean", F.round(F.avg("score").over(series.rowsBetween(-(window - 1), 0)), 6))
    low = F.col("rolling_mean") < threshold
    islands = rolling.withColumn(
        "_island", F.sum(F.when(low, 0).otherwise(1)).over(series.rowsBetween(Window.unboundedPreceding, 0))
    )
    inside = Window.partitionBy(*keys, "_island").orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return islands.withColumn("low_run", F.sum(low.cast("int")).over(inside).cast("int")).select(
        *keys, period, "score", "rolling_mean", "low_run", (F.col("low_run") >= run).alias("drifting")
    )


def stratified_sample(df: DataFrame, strata: list[str], id_: str, percent: int) -> DataFrame:
    """A reproducible share of every stratum, and at least one row of each.

    Membership is a function of the row's id, so a rerun gives the same sample and no stratum is
    gathered; the guaranteed row is the one with the smallest hash, found map-side and carried whole,
    so nothing is joined back. Rows that share an id are in or out together.
    """
    drawn = df.withColumn("_draw", hash_number(F.col(id_).cast("string")))
    taken = F.pmod("_draw", F.lit(100)) < percent
    first = F.min_by(F.struct(*df.columns, "_draw"), F.struct("_draw", id_)).alias("row")
    floor = drawn.groupBy(*[F.col(c).alias(f"_s_{c}") for c in strata]).agg(first).select("row.*").filter(~taken)
    return drawn.filter(taken).unionByName(floor).drop("_draw")


def always_evaluate(traces: DataFrame, length: str, triggers: Column) -> DataFrame:
    """Traces that bypass sampling: triggered ones and those unusually long or short."""
    fence = quartile_fences(traces, length)
    marked = with_single(traces, fence)
    odd = (F.col(length) < F.col("low_fence")) | (F.col(length) > F.col("high_fence"))
    return marked.filter(F.coalesce(triggers, F.lit(False)) | odd).select(*traces.columns)


def evaluation_set(sample: DataFrame, always: DataFrame, id_: str) -> DataFrame:
    """Sample and always-evaluate rows together, each once."""
    return sample.unionByName(always.select(*sample.columns)).dropDuplicates([id_])


def breach_windows(events: DataFrame, time: str, breached: Column, width: str = "1 hour", tolerance: int = 0) -> DataFrame:
    """Windows with more breaches than tolerated; the same call serves batch and stream."""
    return (
        events.filter(breached)
        .groupBy(F.window(time, width).alias("w"))
        .agg(F.count("*").alias("breaches"))
        .filter(F.col("breaches") > tolerance)
        .select(F.col("w.start").alias("window_start"), "breaches")
    )


def golden_versions(approvals: DataFrame, key: str, approved: Column, at: str) -> DataFrame:
    """Approved candidates as versions with validity intervals; others never enter.

    ``at`` is a non-negative integer moment, unique per key. Versions are counted blockwise and a
    version ends where the next number begins, an equi join: no key is ordered in one task.
    """
    numbered = running(approvals.filter(approved), [key], at, sums={"version": F.lit(1)})
    versions = numbered.withColumn("version", (F.col("version") + 1).cast("int")).withColumn("valid_from", F.col(at))
    following = versions.select(key, (F.col("version") - 1).alias("version"), F.col(at).alias("valid_to"))
    return versions.join(following, [key, "version"], "left")


def golden_as_of(versions: DataFrame, moment: Column) -> DataFrame:
    """What the golden set was at a moment."""
    return versions.filter((F.col("valid_from") <= moment) & (F.col("valid_to").isNull() | (moment < F.col("valid_to"))))


def mean_vectors(df: DataFrame, keys: list[str], vector: str) -> DataFrame:
    """Mean vector per key from partial sums per dimension: ``keys, mean``."""
    cells = df.select(*keys, F.posexplode(vector).alias("_dim", "_value"))
    means = cells.groupBy(*keys, "_dim").agg(F.avg(F.col("_value").cast("double")).alias("_mean"))
    # At most one row per dimension meets here.
    packed = means.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_dim", "_mean"))).alias("_m"))
    return packed.select(*keys, F.col("_m._mean").alias("mean"))


def embedding_drift(df: DataFrame, period: str, vector: str) -> DataFrame:
    """Cosine of each period's mean vector with the first period's."""
    means = mean_vectors(df, [period], vector)
    baseline = means.agg(F.min_by("mean", period).alias("_base"))
    joined = with_single(means, baseline)
    return joined.select(period, F.round(cosine(F.col("mean"), F.col("_base")), 6).alias("similarity")).withColumn(
        "drift", F.round(1 - F.col("similarity"), 6)
    )
