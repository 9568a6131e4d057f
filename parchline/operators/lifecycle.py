"""Content and instances over time: dedup, new content, deletions, orphans, serving sync.

One content may have a third of all instances. Everything keyed by content hash is therefore
reduced by partial aggregates first, or tested by semi and anti joins against a distinct key set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..sources.tables import stored
from .capture import valid_only

# Fixed value: the columns of an instance.
INSTANCE = (
    "source_path string, file_name string, content_hash string, ingestion_timestamp timestamp, file_type string, "
    "resolved_acl_group string, is_active boolean, deactivated_at timestamp"
)


def one_per_content(bronze: DataFrame) -> DataFrame:
    """The row with the smallest path for each content hash.

    The winner is found on the narrow ``hash, path`` pair by a partial aggregate; the wide bytes
    are attached by path afterwards, so copies of one content never meet in one task. Paths are
    unique within a capture batch.
    """
    return with_bytes(bronze, winners(bronze))


def not_seen(new: DataFrame, seen: DataFrame, key: str = "content_hash") -> DataFrame:
    """Rows whose key is absent from ``seen``.

    ``seen`` grows for ever while ``new`` is one batch. So ``seen`` is first narrowed to the keys
    of the batch (the batch's keys are the small side, which AQE broadcasts when they fit), and
    only that remainder takes part in the anti join.
    """
    batch_keys = new.select(key).distinct()
    return new.join(seen.select(key).join(batch_keys, key, "left_semi"), key, "left_anti")


def new_content(bronze: DataFrame, extracted: DataFrame, retry_failed: bool = True) -> DataFrame:
    """Content to extract: valid, one row per hash, not extracted before.

    With ``retry_failed`` only ``success`` and ``empty`` count as done.
    """
    done = extracted.filter(F.col("extraction_status").isin("success", "empty")) if retry_failed else extracted
    pairs = stored(valid_only(bronze).select("content_hash", "source_path").dropna(), "pairs")
    chosen = stored(not_seen(winners(pairs), done).select("content_hash", "source_path"), "chosen")
    return without(valid_only(bronze), pairs.join(chosen, pairs.columns, "left_anti"), chosen)


def without(bronze: DataFrame, dropped: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``bronze`` named by ``chosen``, which with ``dropped`` makes up all its (hash, path).

    Both lists are stored, so the planner knows their sizes, and the shorter one is joined: few copies or few
    new contents are broadcast, and no file's bytes are shuffled.
    """
    dropped = stored(dropped.select("content_hash", "source_path"), "dropped")
    if dropped.count() >= chosen.count():  # from the files' footers
        return with_bytes(bronze, chosen)
    return bronze.dropna(subset=dropped.columns).join(dropped, dropped.columns, "left_anti")


def winners(bronze: DataFrame) -> DataFrame:
    """(content_hash, source_path): the smallest path of each content, from the narrow pair alone."""
    return bronze.groupBy("content_hash").agg(F.min("source_path").alias("source_path"))


def with_bytes(bronze: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``bronze`` named by ``chosen`` (content_hash, source_path), attached in one semi join.

    Everything is decided on narrow rows first, so the wide rows take part in a single join, whose key
    side is the one AQE can broadcast when it is small (a micro-batch's new content); Spark's runtime
    Bloom filter on that side prunes the wide scan before any exchange.
    """
    return bronze.join(chosen.select("content_hash", "source_path"), ["content_hash", "source_path"], "left_semi")


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key (not null); only rows whose key repeats are shuffled.

    The repeating keys are found on the key column and stored, so that the planner knows their size: few of
    them are broadcast and all other rows stay where they are.
    """
    again = stored(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key), "again")
    return rows.join(again, key, "left_anti").unionByName(rows.join(again, key, "left_semi").dropDuplicates([key]))


def instances(bronze: DataFrame) -> DataFrame:
    """One active instance row per captured file, whether or not its content is new.

    What capture does not know yet is NULL of the declared type.
    """
    known = valid_only(bronze).withColumn("is_active", F.lit(True))
    return known.select(
        *[
            (F.col(field.name) if field.name in known.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in StructType.fromDDL(INSTANCE)
        ]
    )


def latest_instance(history: DataFrame) -> DataFrame:
    """The newest row per path, as an aggregate: a path re-captured endlessly combines map-side."""
    others = [c for c in history.columns if c not in ("source_path", "ingestion_timestamp", "content_hash")]
    newest = F.max(
        F.struct("ingestion_timestamp", "content_hash", F.struct(*others).alias("rest"))
    ).alias("n")
    picked = history.groupBy("source_path").agg(newest)
    return picked.select(
        "source_path",
        "n.ingestion_timestamp",
        "n.content_hash",
        *[F.col(f"n.rest.{c}").alias(c) for c in others],
    ).select(*history.columns)


def pending(listing: DataFrame, bronze: DataFrame) -> DataFrame:
    """Listed files not captured yet."""
    return listing.join(bronze.select(F.col("source_path").alias("path")), "path", "left_anti")


def pending_summary(listing: DataFrame, bronze: DataFrame) -> DataFrame:
    return pending(listing, bronze).agg(
        F.count("*").alias("pending_files"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("pending_size_bytes"),
    )


def reconcile(current: DataFrame, listing: DataFrame, now: Column) -> DataFrame:
    """Deactivate active instances whose file is gone."""
    live = listing.select(F.col("path").alias("source_path")).distinct().withColumn("_live", F.lit(True))
    gone = F.col("is_active") & F.col("_live").isNull()
    return current.join(live, "source_path", "left").select(
        *[
            F.when(gone, F.lit(False)).otherwise(F.col("is_active")).alias(c)
            if c == "is_active"
            else F.when(gone, now).otherwise(F.col("deactivated_at")).alias(c)
            if c == "deactivated_at"
            else F.col(c)
            for c in current.columns
        ]
    )


def reconcile_report(current: DataFrame, listing: DataFrame) -> DataFrame:
    """Every path on either side as ``live``, ``changed``, ``missing`` or ``new``.

    The file stream does not notice an overwritten file, so length and modification time are
    compared where both sides carry them.
    """
    left = current.filter("is_active").select(
        "source_path", F.col("file_size").alias("_size"), F.col("file_modification_time").alias("_time")
    )
    right = listing.select(F.col("path").alias("source_path"), "length", "modificationTime")
    same = (F.col("_size") == F.col("length")) & (F.col("_time") == F.col("modificationTime"))
    return left.join(right, "source_path", "full_outer").select(
        "source_path",
        F.when(F.col("length").isNull(), "missing")
        .when(F.col("_size").isNull(), "new")
        .when(same, "live")
        .otherwise("changed")
        .alias("state"),
    )


def _active_hashes(current: DataFrame) -> DataFrame:
    return current.filter("is_active").select("content_hash").distinct()


def active_chunks(chunks: DataFrame, current: DataFrame) -> DataFrame:
    """Chunks some active instance still refers to."""
    return chunks.join(_active_hashes(current), "content_hash", "left_semi")


def orphan_chunks(chunks: DataFrame, current: DataFrame) -> DataFrame:
    """Chunks no active instance refers to; a rename, a move and a deletion look the same."""
    return chunks.join(_active_hashes(current), "content_hash", "left_anti")


def instance_only(bronze: DataFrame, seen: DataFrame) -> DataFrame:
    """Captured files whose content is known: they add an instance and nothing else."""
    new = valid_only(bronze)
    hits = seen.select("content_hash").join(new.select("content_hash").distinct(), "content_hash", "left_semi")
    return new.join(hits, "content_hash", "left_semi")


def snapshot_changes(before: DataFrame, after: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """What a mirror of ``before`` must do to become ``after``: ``key, change``.

    Compared columns travel as one hash, so the join carries two narrow columns per side.
    """

    def digest(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.sha2(F.to_json(F.struct(*compared)), 256).alias(name))

    joined = digest(before, "_old").join(digest(after, "_new"), key, "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(F.col("_old") != F.col("_new"), "update")
    )
    return joined.select(key, change.alias("change")).filter(F.col("change").isNotNull())
