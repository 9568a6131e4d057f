"""Order-dependent work inside groups that may be huge.

A window over a whole group puts the group into one task. Here each group is cut into blocks of
consecutive positions; only one small row per block is ordered per group, and the rows themselves
are ordered inside their block. A group with a third of all rows then spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_ROWS = 4096


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add running values per group, in ``order`` (a non-negative integer, unique in its group).

    ``sums`` adds the sum over all *earlier* rows, ``lasts`` the last non-NULL value up to and
    including the row.
    """
    sums, lasts = sums or {}, lasts or {}
    block = F.floor(F.col(order) / F.lit(block_rows)).cast("long")
    rows = df.withColumn("_block", block)

    totals = rows.groupBy(*keys, "_block").agg(
        *[F.sum(value).alias(f"_t_{name}") for name, value in sums.items()],
        *[
            F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(f"_l_{name}")
            for name, value in lasts.items()
        ],
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        "_block",
        *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_o_{name}") for name in sums],
        *[F.last(f"_l_{name}", ignorenulls=True).over(before).alias(f"_c_{name}") for name in lasts],
    )

    inside = Window.partitionBy(*keys, "_block").orderBy(order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(carried, [*keys, "_block"], "left").select(
        *df.columns,
        *[
            (F.col(f"_o_{name}") + F.coalesce(F.sum(value).over(earlier), F.lit(0))).alias(name)
            for name, value in sums.items()
        ],
        *[
            F.coalesce(F.last(value, ignorenulls=True).over(upto), F.col(f"_c_{name}")).alias(name)
            for name, value in lasts.items()
        ],
    )


def concat_ordered(
    df: DataFrame,
    keys: list[str],
    order: str,
    text: str,
    separator: str,
    part_chars: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Join the texts of each group in order: ``keys, part_no, text``.

    Each group is one row, part 0, however long, joined from one row per block; a text beyond what a cell can hold (2 GB) is an
    error. A caller who names ``part_chars`` gets longer results in further parts (joining the parts
    by the separator gives the whole).
    """
    if part_chars is None:
        some = F.exists("_parts.t", lambda t: t.isNotNull())
        blocks = (
            df.groupBy(*keys, F.floor(F.col(order) / F.lit(block_rows)).alias("_block"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("_parts"))
            .select(*keys, "_block", F.when(some, F.array_join(F.col("_parts.t"), separator)).alias("t"))
        )
        whole = blocks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_block", "t"))).alias("_parts"))
        return whole.select(*keys, F.lit(0).alias("part_no"), F.array_join(F.col("_parts.t"), separator).alias(text))
    length = F.length(text).cast("long") + F.lit(len(separator))
    placed = running(df.select(*keys, order, text), keys, order, sums={"_at": length}, block_rows=block_rows)
    return (
        placed.withColumn("part_no", F.floor(F.col("_at") / F.lit(part_chars)).cast("int"))
        .groupBy(*keys, "part_no")
        .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("_parts"))
        .select(*keys, "part_no", F.array_join(F.col("_parts.t"), separator).alias(text))
    )
