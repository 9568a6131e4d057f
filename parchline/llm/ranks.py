"""Dense positions in a sort order, computed without gathering a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.tables import stored


def ranked(rows: DataFrame, order: Sequence[Column], group: str | None, purpose: str) -> DataFrame:
    """``rows`` with ``_rank`` (0-based position in ``order``, counted within ``group`` or over all rows) and
    ``_total`` (rows of the group).

    Rows are dealt by range of (group, order), so a group of any size spreads over many tasks, and sorted
    within each task; a row's place in its task is read from ``monotonically_increasing_id``. One count per
    task and group, summed in task order, gives each task's offset. The tagged rows are written to the shared
    folder first, so a lost executor cannot give other places on recomputation. Rows equal in ``group`` and
    ``order`` take consecutive positions in an undefined order among themselves; pass a tiebreak that makes
    them equal in every column that matters. ``group`` must not be null (callers map null to a key).
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ([F.col(group)] if group else []) + list(order)
    tagged = stored(
        rows.repartitionByRange(width, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id()),
        purpose,
    )
    by = [group] if group else []
    counts = tagged.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    # One row per task and group: a window over a group holds as many rows as the group spans tasks.
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = counts.select(
        "_part", *by, "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    )
    found = tagged.join(offsets, ["_part", *by])
    rank = F.col("_before") + F.col("_pos") - F.col("_first")
    return found.withColumn("_rank", rank).drop("_part", "_pos", "_first", "_before")
