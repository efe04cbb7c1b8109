"""Exact global ordering helpers that never pull all rows into one task.

* ``global_rank``: 1-based rank of every row under a total order.  The data
  is range-partitioned and sorted once and checkpointed to the shared folder
  (both passes then see the same partitions).  The monotonically increasing
  id of a sorted row encodes (partition, position); per-partition counts (one
  row per partition) give offsets, and rank = offset + position + 1.
* ``newest_n``: the ``n`` rows with the largest values of a unique numeric
  id, found by refining a count histogram over the id range until the
  boundary bucket is small; only bucket counts (<= ``fanout`` rows) reach the
  driver, and each pass reads only the boundary range (pushed to the scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOW33 = (1 << 33) - 1


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank") -> DataFrame:
    from postlake.session import shared_dir
    shared_dir(df.sparkSession)
    s = df.orderBy(*order).withColumn("__mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    s = s.withColumn("__pid", F.shiftright("__mid", 33)).withColumn("__pos", F.col("__mid").bitwiseAND(F.lit(_LOW33)))
    counts = s.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: a small, bounded table (window over it is cheap)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))
    return (s.join(F.broadcast(offsets), "__pid")
             .withColumn(rank_col, F.col("__off") + F.col("__pos") + 1)
             .drop("__pid", "__pos", "__off", "__mid"))


def newest_n(df: DataFrame, id_col: str, n: int, fanout: int = 1024,
             exact_below: int = 200_000) -> DataFrame:
    """Rows with the ``n`` largest values of the unique numeric ``id_col``."""
    if n <= 0:
        return df.limit(0)
    st = df.agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi"),
                F.count(F.lit(1)).alias("c")).first()
    if st["c"] <= n:
        return df
    lo, hi, need, c = int(st["lo"]), int(st["hi"]), n, int(st["c"])
    while c > exact_below and lo < hi:
        width = max(1, (hi - lo + fanout) // fanout)
        part = df.filter((F.col(id_col) >= lo) & (F.col(id_col) <= hi))
        hist = (part.groupBy(F.floor((F.col(id_col) - F.lit(lo)) / F.lit(width)).cast("long").alias("b"))
                    .agg(F.count(F.lit(1)).alias("c")).collect())
        acc = 0
        for row in sorted(hist, key=lambda r: -r["b"]):
            if acc + row["c"] >= need:
                b = int(row["b"])
                lo, hi, c = lo + b * width, min(hi, lo + (b + 1) * width - 1), int(row["c"])
                need -= acc
                break
            acc += row["c"]
    boundary = df.filter((F.col(id_col) >= lo) & (F.col(id_col) <= hi))
    cutoff = (boundary.select(id_col).orderBy(F.desc(id_col)).limit(need)
                      .agg(F.min(id_col).alias("m")).first()["m"])
    return df.filter(F.col(id_col) >= F.lit(cutoff))
