"""Event-time operators with a watermark (W4) and deduplication whose state
expires (D1 on a stream).

The watermark of a batch is the newest event time of all earlier batches minus
the allowed lateness.  A row at or behind it (for windows: a row whose window
ends at or behind it) is late and dropped; state behind it is evicted, so it
grows with the lateness and not with the stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.streaming import jobs


def windowed_counts(stream: DataFrame, keys: list[str], ts_col: str = "ts", window: str = "1 hour",
                    lateness: str = jobs.ALLOWED_LATENESS) -> DataFrame:
    """Counts per window and ``keys``; in append mode a window comes out once,
    when the watermark has passed its end.  ``start, keys..., n``."""
    counts = (stream.withWatermark(ts_col, lateness).groupBy(F.window(ts_col, window).alias("__w"), *keys)
              .agg(F.count(F.lit(1)).alias("n")))
    return counts.select(F.col("__w.start").alias("start"), *keys, "n")


def first_deliveries(stream: DataFrame, keys: list[str], ts_col: str = "ts", lateness: str = jobs.ALLOWED_LATENESS) -> DataFrame:
    """Rows whose ``keys`` have not come within the watermark: repeats are
    dropped, a key's state goes once the watermark is ``lateness`` past it."""
    return stream.withWatermark(ts_col, lateness).dropDuplicatesWithinWatermark(keys)


def in_steps(df: DataFrame, step_col: str, steps: int, make: Callable[[DataFrame], object], name: str) -> list[dict]:
    """Lets the rows of one step after the other arrive in a folder, each as
    many files as Spark has tasks for it, and after each step drains the stream
    ``make(stream)`` (a DataStreamWriter): every step is a restart from the
    checkpoint.  Returns the progress of all batches; rows read are observed."""
    spark, base = df.sparkSession, jobs.new_dir(df.sparkSession, name)
    df.write.partitionBy(step_col).parquet(base + "/all")
    rows = spark.read.schema(df.schema).parquet(base + "/all")
    schema = df.drop(step_col).schema
    progress = []
    for step in range(steps):
        rows.where(F.col(step_col) == step).drop(step_col).write.mode("append").parquet(base + "/in")
        stream = spark.readStream.schema(schema).parquet(base + "/in").observe("arrived", F.count(F.lit(1)).alias("rows"))
        progress += jobs.run(make(stream), base + "/_checkpoint")
    return progress


def observed_rows(progress: list[dict]) -> int:
    return sum((p["observedMetrics"].get("arrived") or {"rows": 0})["rows"] for p in progress)
