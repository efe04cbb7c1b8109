"""Streaming jobs.

* Sources: a file stream over a folder of Parquet files, or of raw NDJSON lines
  with a quarantine for malformed ones; a consumer group is one streaming query with its own
  ``checkpointLocation`` (the cursor); the commit log is the acknowledgement.
  ``max_files`` bounds a read like the reference's ``count``.
* Sinks are ``foreachBatch`` writers keyed by ``batch_id``: a replayed batch
  rewrites the same ``batch_id=<n>`` folder (overwrite), so output is
  idempotent and the stream is exactly-once end to end.
* Keyed tables are append-only update logs; readers take the newest version
  per key (``latest``), so no in-place merge is needed.
* Late data: ``log_counts`` writes each batch's own counts, which add up
  whatever order events arrive in.  Rows older than the newest event of the
  earlier batches by more than the allowed lateness still count and are also
  written to a side table, so lateness is visible.
* Triggers: ``run`` drains what is there (``availableNow``), or works at a
  fixed interval (``every`` seconds) until the input is used up.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.session import scratch_path
from postlake.sources import events as ev

ALLOWED_LATENESS = "1 hour"
#: Rows of one arriving file, at most, where a step has many.
ROWS_PER_FILE = 1_000_000
#: Rows of one arriving file, at least, where a step has one for each core.
LEAST_ROWS = 2_000


def files_per_step(df: DataFrame, steps: int = 4, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Files of one arrival step: as many as its rows need, two at least, and one
    for each core where every file still has ``LEAST_ROWS`` (tasks write and
    read a step by its files)."""
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return max(2, -(-rows // (steps * rows_per_file)), min(cores, rows // (steps * LEAST_ROWS)))


def arriving_files(df: DataFrame, order_col: str, files: int = 4, newest_first: bool = False, per_step: int = 1) -> str:
    """Writes ``df`` in ``files`` ranges of ``order_col``, one after the other,
    each as ``per_step`` files by as many tasks: the arrival order of a stream
    that takes ``per_step`` files a trigger from the folder returned."""
    spark, base = df.sparkSession, scratch_path(df.sparkSession, "arriving")
    ranged = df.repartitionByRange(files * per_step, order_col).sortWithinPartitions(order_col)
    ranged.withColumn("__part", F.spark_partition_id()).write.parquet(base + "/ranged")
    parts = spark.read.parquet(base + "/ranged")
    for p in sorted(range(files), reverse=newest_first):
        step = parts.where((F.col("__part") >= p * per_step) & (F.col("__part") < (p + 1) * per_step)).drop("__part")
        step = step.coalesce(1) if per_step == 1 else step.repartitionByRange(per_step, order_col)
        step.sortWithinPartitions(order_col).write.mode("append").parquet(base + "/in")
    return base + "/in"


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream the Parquet files of a folder, oldest first, from the start."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def batch_writer(path: str, mode: str = "overwrite", transform=None):
    """foreachBatch sink writing each micro-batch to ``path/batch_id=<n>``."""
    def write(df: DataFrame, batch_id: int) -> None:
        out = transform(df, batch_id) if transform else df
        out.write.mode(mode).parquet(f"{path}/batch_id={batch_id}")
    return write


def run(query_builder, checkpoint: str, every: float | None = None) -> list[dict]:
    """Start ``query_builder`` (a DataStreamWriter) and wait until the input is
    used up: with ``availableNow``, or every ``every`` seconds.  Returns the
    batches' progress."""
    writer = query_builder.option("checkpointLocation", checkpoint)
    if every is None:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return progress(q)
    q = writer.trigger(processingTime=f"{every} seconds").start()
    try:
        q.processAllAvailable()
        return progress(q)
    finally:
        q.stop()


def progress(query) -> list[dict]:
    """The batches of a query so far, as plain dicts."""
    return [json.loads(p.json) for p in query.recentProgress]


def raw_events(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A folder of NDJSON files as a stream of lines (``value``).  Rows
    and malformed rows are observed as ``raw`` (``rows``, ``quarantined``)."""
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    parsed = ev.parse_events(r.text(path))
    return parsed.observe("raw", F.count(F.lit(1)).alias("rows"), F.count_if(ev.is_malformed()).alias("quarantined"))


def split_sinks(path: str, transform):
    """foreachBatch sink of parsed events: ``path/events`` gets
    ``transform(good)``, ``path/quarantine`` the malformed lines as they came."""
    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        good, bad = ev.split_quarantine(df)
        for name, out in (("events", transform(good)), ("quarantine", bad.select("value"))):
            out.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        df.unpersist()
    return write


def earlier(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What batches before ``batch_id`` wrote below ``path``; None for the
    first.  Errors of reading it are raised."""
    return spark.read.parquet(path).where(F.col("batch_id") < batch_id) if batch_id else None


def log_counts(path: str, counts, ts_col: str, lateness: str = ALLOWED_LATENESS):
    """foreachBatch sink for additive counts: ``path/counts`` gets
    ``counts(batch)``, ``path/late`` the batch's late rows and ``path/seen``
    its newest event time."""
    def write(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        seen = earlier(df.sparkSession, f"{path}/seen", batch_id)
        newest = seen.agg(F.max("newest")).first()[0] if seen is not None else None
        late = F.lit(False) if newest is None else F.col(ts_col) < F.lit(newest) - F.expr(f"INTERVAL {lateness}")
        for name, out in (("counts", counts(df)), ("late", df.where(late)), ("seen", df.agg(F.max(ts_col).alias("newest")))):
            out.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
        df.unpersist()
    return write


def latest(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """Newest version of every key in an update log written by batch_writer."""
    log = spark.read.parquet(path)
    other = [c for c in log.columns if c not in key and c != "batch_id"]
    return (log.groupBy(*key).agg(F.max_by(F.struct(*other), F.col("batch_id")).alias("__r"))
               .select(*key, *[F.col(f"__r.{c}").alias(c) for c in other]))


def new_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
