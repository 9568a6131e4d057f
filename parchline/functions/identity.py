"""Stable identities derived from content."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def chunk_id(hash_: Column, index: Column) -> Column:
    return F.sha2(F.concat(hash_, F.lit("_"), index.cast("string")), 256)


def hash_number(value: Column) -> Column:
    """32 bits of md5 as a non-negative number; the same in any engine."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")


def path_part(path: Column, from_end: int) -> Column:
    """The n-th path part counted from the end (1 = file name); NULL on shorter paths."""
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))
