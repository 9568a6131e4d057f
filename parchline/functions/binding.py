"""Naming an intermediate value inside one expression."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it.

    Repeating a column in an expression repeats its computation, per element inside a lambda.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def explode_rows(df: DataFrame, array: str, *keep: str, index: str | None = None, value: str = "value") -> DataFrame:
    """One row per array element; rows with empty or NULL arrays vanish.

    A plain ``explode`` makes the optimizer filter on the array first, which would compute a costly
    array twice. The outer form with a filter on its output computes it once.
    """
    if index is None:
        return df.select(*keep, F.explode_outer(array).alias(value)).filter(F.col(value).isNotNull())
    return df.select(*keep, F.posexplode_outer(array).alias(index, value)).filter(F.col(index).isNotNull())


def with_single(df: DataFrame, one: DataFrame) -> DataFrame:
    """Every row of ``df`` with the columns of a global aggregate, which is exactly one row."""
    row = one.select(F.struct(*one.columns).alias("one")).scalar()
    return df.withColumn("_one", row).select(*df.columns, "_one.*")
