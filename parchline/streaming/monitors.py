"""Windowed monitoring over event streams, and progress of the flows themselves."""

from __future__ import annotations

import json
import threading
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.listener import StreamingQueryProgress

from ..operators.evaluate import breach_windows
from ..sources.tables import COMMIT, COMMITS, exists, read_rows

PROGRESS = (
    "flow string, run_id string, batch_id bigint, timestamp string, input_rows bigint, "
    "rows_per_second double, duration_ms bigint, sources string"
)


def hourly_counts(events: DataFrame, time: str, keys: list[str], late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts per window and key; rows later than ``late`` are dropped and state is bounded."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.window(time, width).alias("w"), *keys)
        .agg(F.count("*").alias("events"))
        .select(F.col("w.start").alias("window_start"), *keys, "events")
    )


def sessions(events: DataFrame, time: str, user: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """User sessions separated by a gap; each is emitted once it can no longer grow.

    Sessions merge inside each partition before the shuffle when
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is on, which keeps a
    very busy user from sending every event to one task.
    """
    return (
        events.withWatermark(time, late)
        .groupBy(F.session_window(time, gap).alias("s"), user)
        .agg(F.count("*").alias("events"))
        .select(user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events")
    )


def deduplicated(events: DataFrame, time: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Repeats within the watermark delay dropped; older keys leave the state."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def safety_breaches(events: DataFrame, time: str, breached: Column, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    return breach_windows(events.withWatermark(time, late), time, breached, width)


def _progress_row(report: StreamingQueryProgress) -> tuple:
    item = json.loads(report.json)
    return (
        item.get("name"),
        item["runId"],
        int(item["batchId"]),
        item["timestamp"],
        int(item["numInputRows"]),
        float(item.get("processedRowsPerSecond") or 0.0),
        int(item.get("durationMs", {}).get("triggerExecution", 0)),
        json.dumps(item.get("sources", []), default=str),
    )


class ProgressLog(StreamingQueryListener):
    """Progress of all flows as a table: one row per micro-batch, however many there are.

    Used as a context around the flows. Rows are appended as files of ``rows_per_file`` and when a flow ends;
    ``wait`` returns once everything a flow reported has been written.
    """

    def __init__(self, spark: SparkSession, folder: str, rows_per_file: int = 64):
        self.spark, self.folder, self.rows_per_file = spark, folder, rows_per_file
        self._rows: list[tuple] = []
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._rows.append(_progress_row(event.progress))
        if len(self._rows) >= self.rows_per_file:
            self._write()

    def onQueryTerminated(self, event) -> None:
        self._write()
        self._ended[str(event.runId)].set()

    def _write(self) -> None:
        if self._rows:
            self.spark.createDataFrame(self._rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.folder)
            self._rows = []

    def wait(self, query: StreamingQuery, timeout: float = 60) -> None:
        if not self._ended[str(query.runId)].wait(timeout):
            raise TimeoutError(f"no end of flow {query.name} was reported in {timeout} s")

    def table(self) -> DataFrame:
        return read_rows(self.spark, self.folder, PROGRESS)


def backlog(spark: SparkSession, root: str, flow: str, table: str, source: int = 0) -> DataFrame:
    """What a flow has still to take from a table: committed batches that its checkpoint has not seen.

    One row: flow, table, outstanding batches, files, rows and bytes (0 when it is up to date). The
    table's commit records give files, rows and bytes of each batch; the flow's file source log (its
    ``source``-th input) names the records it has taken. Both are small: one line per batch.
    """
    folder = f"{root}/{table}/{COMMITS}"
    records = spark.read.schema(COMMIT).json(folder) if exists(spark, folder) else spark.createDataFrame([], COMMIT)
    records = records.withColumn("record", F.element_at(F.split(F.input_file_name(), "/"), -1))
    log = f"{root}/checkpoints/{flow}/sources/{source}"
    if exists(spark, log):
        lines = spark.read.text(log).filter(F.col("value").startswith("{"))
        taken = lines.select(F.element_at(F.split(F.get_json_object("value", "$.path"), "/"), -1).alias("record"))
        records = records.join(taken, "record", "left_anti")
    return records.agg(
        F.lit(flow).alias("flow"),
        F.lit(table).alias("table"),
        F.count(F.lit(1)).alias("outstanding_batches"),
        F.coalesce(F.sum(F.size("files")), F.lit(0)).cast("long").alias("outstanding_files"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("outstanding_rows"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("long").alias("outstanding_bytes"),
    )
