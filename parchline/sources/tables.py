"""Table input and idempotent table output."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import fresh_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores one split per core; leave any other alone.

    For input in few unsplittable pieces that feeds costly per-row work. A table of many files has
    more splits than cores, so nothing is shuffled there.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a result to the shared folder and read it back: the hand-over between two stages.

    What several consumers read is computed once, and lost executors cost no recomputation of it.
    """
    folder = fresh_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


COMMITS = "_commits"
COMMIT = "batch_id long, files array<string>, rows long, bytes long, inputs array<long>"


def write_batch(df: DataFrame, folder: str, batch_id: int, inputs: list[int] | None = None) -> None:
    """Write one micro-batch so that writing it again replaces it, then commit it.

    Each batch owns one sub-folder; a replay after a failure replaces exactly that. The files are written to a
    hidden folder first and renamed into place, so a batch may be made from its own earlier files, and its
    old files stay until the new ones are whole. Once its files are in place, the batch gets a commit record: a file of one JSON line named after the batch (its files,
    rows and the input batches it was made from), written under a hidden name and renamed into place.
    Flows that read the table follow these records, not the folder, so a batch is handed on once: a
    replay that writes new file names keeps the record it had, and readers never see half a batch.
    """
    target, staged = f"{folder}/batch_id={batch_id}", f"{folder}/_staged/batch_{batch_id}.{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(staged)  # whole texts, each read a few times: bytes matter most
    _replace(df.sparkSession, staged, target)
    _commit(df.sparkSession, folder, batch_id, target, inputs or [])


def _replace(spark: SparkSession, staged: str, target: str) -> None:
    """Put a folder that is written out in the place of another."""
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, target))
    files = _fs(spark, staged)
    files.delete(old, True)
    files.mkdirs(old.getParent())
    if not files.rename(new, old):
        raise OSError(f"could not put {staged} in the place of {target}")


def _commit(spark: SparkSession, folder: str, batch_id: int, target: str, inputs: list[int]) -> None:
    jvm = spark._jvm
    record = jvm.org.apache.hadoop.fs.Path(f"{folder}/{COMMITS}/batch_{batch_id}.json")
    files = record.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(record):
        return
    names = sorted(
        str(status.getPath().getName())
        for status in files.listStatus(jvm.org.apache.hadoop.fs.Path(target))
        if str(status.getPath().getName()).endswith(".parquet")
    )
    rows = spark.read.parquet(target).count() if names else 0  # from the files' footers
    size = int(files.getContentSummary(jvm.org.apache.hadoop.fs.Path(target)).getLength())
    line = json.dumps({"batch_id": batch_id, "files": names, "rows": rows, "bytes": size, "inputs": sorted(inputs)}) + "\n"
    hidden = jvm.org.apache.hadoop.fs.Path(f"{folder}/{COMMITS}/.batch_{batch_id}.json.{uuid.uuid4().hex}")
    out = files.create(hidden, True)
    out.writeBytes(line)
    out.close()
    if not files.rename(hidden, record):
        files.delete(hidden, False)
        if not files.exists(record):
            raise OSError(f"could not commit batch {batch_id} of {folder}")


def follow_commits(spark: SparkSession, folder: str, max_batches: int | None = None) -> DataFrame:
    """The commit records of a table written by ``write_batch``, as a stream: each batch exactly once."""
    jvm = spark._jvm
    records = jvm.org.apache.hadoop.fs.Path(f"{folder}/{COMMITS}")
    records.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(records)
    reader = spark.readStream.schema(COMMIT)
    if max_batches:
        reader = reader.option("maxFilesPerTrigger", max_batches)
    return reader.json(f"{folder}/{COMMITS}")


def read_committed(spark: SparkSession, folder: str, schema: str, commits: DataFrame) -> tuple[DataFrame, list[int]]:
    """The rows of the batches named in a micro-batch of commit records, and their batch ids.

    The records of one micro-batch are few (one per input batch), so their ids are read at the driver.
    """
    ids = sorted({r["batch_id"] for r in commits.select("batch_id").collect()})
    if not ids:
        return spark.createDataFrame([], schema), ids
    return spark.read.schema(schema).parquet(*[f"{folder}/batch_id={i}" for i in ids]), ids


def read_table(spark: SparkSession, folder: str, schema: str, before: int | None = None) -> DataFrame:
    """The table as it is now, with its ``batch_id``; an empty one before its first batch.

    ``before`` leaves out that batch and later ones. A flow that looks up its own output needs it:
    when a batch is replayed, its first attempt must not count as already done.
    """
    table_ = read_rows(spark, folder, f"{schema}, batch_id bigint")
    return table_ if before is None else table_.filter(F.col("batch_id") < before)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path))


def read_rows(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A table that need not exist yet."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def stream_table(spark: SparkSession, folder: str, schema: str, max_files: int | None = None) -> DataFrame:
    """Follow a table written in batches by another flow."""
    reader = spark.readStream.schema(f"{schema}, batch_id bigint")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder).drop("batch_id")


def sync_mirror(
    folder: str, after: DataFrame, changes: DataFrame, key: str, buckets: int = 64, files_per_bucket: int = 4
) -> None:
    """Bring a mirror of a table up to date by rewriting only the buckets that have changes.

    ``changes`` lists changed keys, deletions included; other buckets keep their files. Each
    rewritten bucket gets one row without key, so that one left empty is overwritten too. Choose
    ``buckets`` so that one of them is ``files_per_bucket`` files; it must not change for a given folder.
    """

    def bucket(df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))

    touched = bucket(changes.select(key)).select("bucket").distinct()
    rows = bucket(after).join(touched, "bucket", "left_semi").unionByName(touched, allowMissingColumns=True)
    dealt = rows.repartition(buckets, "bucket", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(files_per_bucket)))
    dealt.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(folder)


def read_mirror(spark: SparkSession, folder: str, key: str) -> DataFrame:
    return spark.read.parquet(folder).filter(F.col(key).isNotNull()).drop("bucket")



# --- versioned tables: rewrite only the buckets a change touches, swap one pointer ------------------
#
# A key's 64-bit hash decides its bucket: bucket "d-v" holds the keys whose hash is v modulo 2^d. The
# buckets of a table always cover every hash exactly once; a bucket that grows past a row bound is split
# into "(d+1)-v" and "(d+1)-(v + 2^d)" when it is written again. A pointer file per version maps every
# bucket to the folder holding its files (or to nothing, when it is empty).

VERSIONS = "_versions"


def _fs(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def current_version(spark: SparkSession, folder: str) -> tuple[int, dict[str, str | None]]:
    """The newest committed pointer of a versioned table: its number and, per bucket, the folder holding it."""
    jvm, files = spark._jvm, _fs(spark, folder)
    pointers = jvm.org.apache.hadoop.fs.Path(f"{folder}/{VERSIONS}")
    names = [str(s.getPath().getName()) for s in files.listStatus(pointers)] if files.exists(pointers) else []
    numbers = [int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith(".")]
    if not numbers:
        raise FileNotFoundError(f"{folder} is not a versioned table")
    number = max(numbers)
    stream = files.open(jvm.org.apache.hadoop.fs.Path(f"{folder}/{VERSIONS}/{number:010d}.json"))
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return number, json.loads(text)["buckets"]


def _swap(spark: SparkSession, folder: str, number: int, buckets: dict[str, str | None]) -> None:
    """Commit pointer ``number``: written under a hidden name, renamed into place; a pointer that exists
    already means another writer won, and this change fails instead of overwriting it."""
    jvm, files = spark._jvm, _fs(spark, folder)
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/{VERSIONS}/{number:010d}.json")
    hidden = jvm.org.apache.hadoop.fs.Path(f"{folder}/{VERSIONS}/.{number:010d}.{uuid.uuid4().hex}")
    out = files.create(hidden, True)
    out.writeBytes(json.dumps({"version": number, "buckets": buckets}, sort_keys=True))
    out.close()
    if files.exists(target) or not files.rename(hidden, target):
        files.delete(hidden, False)
        raise RuntimeError(f"version {number} of {folder} was committed by another writer")


def bucket_of(key: str, names: list[str]) -> Column:
    """The name of the bucket, among ``names`` (which cover every hash once), that holds the key."""
    code = F.xxhash64(key)
    picked = None
    for depth in sorted({int(n.split("-")[0]) for n in names}):
        name = F.concat(F.lit(f"{depth}-"), F.pmod(code, F.lit(1 << depth)).cast("string"))
        here = F.when(name.isin([n for n in names if n.startswith(f"{depth}-")]), name)
        picked = here if picked is None else F.coalesce(picked, here)
    return picked


def _split(name: str) -> list[str]:
    depth, value = (int(x) for x in name.split("-"))
    return [f"{depth + 1}-{value}", f"{depth + 1}-{value + (1 << depth)}"]


def _write_buckets(rows: DataFrame, key: str, names: list[str], data: str, max_rows: int | None) -> dict[str, str | None]:
    """Write ``rows`` (all rows of the buckets ``names``) to ``data``, splitting buckets over ``max_rows``.

    Counting is one small aggregate per round of splits; a bucket of one repeated key cannot be split
    and stays whole.
    """
    names = list(names)
    while max_rows:
        counts = rows.withColumn("_bucket", bucket_of(key, names)).groupBy("_bucket").agg(
            F.count(F.lit(1)).alias("n"), (F.min(key) != F.max(key)).alias("keys")
        )
        big = [r["_bucket"] for r in counts.filter((F.col("n") > max_rows) & F.col("keys")).collect()]
        if not big:
            break
        names = [n for n in names if n not in big] + [c for b in big for c in _split(b)]
    dealt = rows.withColumn("_bucket", bucket_of(key, names))
    dealt.repartition(max(1, len(names)), "_bucket").write.partitionBy("_bucket").parquet(data)
    present = _listed_buckets(dealt.sparkSession, data)
    return {n: (data if n in present else None) for n in names}


def _listed_buckets(spark: SparkSession, data: str) -> set[str]:
    """Buckets that a write left files in (an empty bucket gets no folder)."""
    if not exists(spark, data):
        return set()
    found = _fs(spark, data).listStatus(spark._jvm.org.apache.hadoop.fs.Path(data))
    return {str(s.getPath().getName()).split("=", 1)[1] for s in found if str(s.getPath().getName()).startswith("_bucket=")}


def write_versioned(df: DataFrame, folder: str, key: str, depth: int = 6, max_rows: int | None = None) -> None:
    """Version 0 of a table dealt into 2^depth hash buckets of ``key`` (split further beyond ``max_rows``)."""
    names = [f"{depth}-{v}" for v in range(1 << depth)]
    _swap(df.sparkSession, folder, 0, _write_buckets(df, key, names, f"{folder}/v0", max_rows))


def read_versioned(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The table as of its newest pointer; files are listed now, so a reader keeps the version it opened."""
    _, buckets = current_version(spark, folder)
    paths = [f"{where}/_bucket={b}" for b, where in sorted(buckets.items()) if where]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def _rewrite(spark, folder, number, buckets, touched, rows, key, max_rows) -> int:
    mapping = {b: w for b, w in buckets.items() if b not in touched}
    mapping |= _write_buckets(rows, key, touched, f"{folder}/v{number + 1}", max_rows)
    _swap(spark, folder, number + 1, mapping)
    return number + 1


def _named(keys: DataFrame, key: str, buckets: dict) -> list[str]:
    """Buckets that the keys fall in; one row per bucket reaches the driver."""
    return sorted(str(r["_b"]) for r in keys.select(bucket_of(key, list(buckets)).alias("_b")).distinct().collect())


def _rows_of(spark, buckets: dict, names: list[str], schema: str) -> DataFrame:
    paths = [f"{buckets[b]}/_bucket={b}" for b in names if buckets.get(b)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def delete_keys(spark: SparkSession, folder: str, keys: DataFrame, key: str, schema: str, max_rows: int | None = None) -> int:
    """Remove the rows of ``keys`` from a versioned table by rewriting only the buckets that hold them.

    The kept rows of each touched bucket go to a new version folder; untouched buckets keep their files.
    Then one pointer names the new mapping. Readers see the old mapping or the new one, never a mix, and
    old version folders stay until they are cleaned away. Returns the new version number.
    """
    number, buckets = current_version(spark, folder)
    doomed = keys.select(key).distinct()
    # Of the buckets the keys fall in, only those holding one of them are written again (key column only).
    held = _rows_of(spark, buckets, _named(doomed, key, buckets), schema).select(key).join(doomed, key, "left_semi")
    touched = _named(held, key, buckets)
    if not touched:
        return number
    kept = _rows_of(spark, buckets, touched, schema).join(doomed, key, "left_anti")
    return _rewrite(spark, folder, number, buckets, touched, kept, key, max_rows)


def sync_versioned(folder: str, after: DataFrame, changes: DataFrame, key: str, max_rows: int | None = None) -> int:
    """Bring a versioned table to ``after`` by rewriting the buckets of the changed keys (deletions included),
    splitting those that outgrow ``max_rows``; other buckets keep their files. Returns the new version."""
    spark = after.sparkSession
    number, buckets = current_version(spark, folder)
    touched = _named(changes.select(key).distinct(), key, buckets)
    if not touched:
        return number
    rows = after.filter(bucket_of(key, list(buckets)).isin(touched))
    return _rewrite(spark, folder, number, buckets, touched, rows, key, max_rows)
