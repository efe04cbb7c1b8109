"""Probabilistic structures as DataFrames.

Hashes are derived from ``md5`` (hex -> integer), which both Spark and the
DuckDB oracle compute identically; double hashing ``h1 + i * h2`` gives the
i-th hash without overflow (both halves < 2**32).

* **approx top-k** uses Spark's mergeable ``approx_top_k`` sketches
  (accumulate, combine, estimate).
* **count-min**: ``depth`` rows x ``width`` counters per group, kept as a
  sparse table ``(group, row, bucket, count)``; the estimate is the minimum
  over rows, never below the true count.
* **Bloom dedup**: the filter is the set of bit positions set so far (bounded
  by ``m``, which grows with the distinct items).  With the state updated once per batch, an occurrence in batch n
  is rejected iff every one of its k positions was first set by an earlier
  batch; so one aggregate (first batch per position) replaces the sequential
  test-then-add loop, and the answer equals the sequential filter's.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.topk import rank_within

# Fixed values of the reference's Bloom filter (capacity, error rate).
BLOOM_CAPACITY = 1_000_000
BLOOM_ERROR = 0.01
CMS_WIDTH = 2000
CMS_DEPTH = 5


def bloom_size(capacity: int = BLOOM_CAPACITY, error: float = BLOOM_ERROR) -> tuple[int, int]:
    """Optimal bit count m and hash count k for a capacity and error rate."""
    m = math.ceil(-capacity * math.log(error) / (math.log(2) ** 2))
    k = max(1, round(m / capacity * math.log(2)))
    return m, k


def md5_part(s: Column, part: int) -> Column:
    """32-bit unsigned integer from hex digits [8*part, 8*part+8) of md5(s)."""
    return F.conv(F.substring(F.md5(s), 8 * part + 1, 8), 16, 10).cast("bigint")


def hash_positions(item: Column, n: int, modulo: int) -> Column:
    """Array of ``n`` positions in ``[0, modulo)`` by double hashing."""
    h1, h2 = md5_part(item, 0), md5_part(item, 1)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.pmod(h1 + i.cast("bigint") * h2, F.lit(modulo)))


def approx_topk_state(df: DataFrame, group_cols: list[str], item_col: str, max_items: int = 10000) -> DataFrame:
    """A3 mergeable form: one sketch per group, ``group..., state``."""
    return df.groupBy(*group_cols).agg(F.expr(f"approx_top_k_accumulate({item_col}, {max_items})").alias("state"))


def approx_topk(states: DataFrame, group_cols: list[str], item_col: str, k: int = 15, max_items: int = 10000) -> DataFrame:
    """A3: merges sketches and ranks: ``group..., rank, item, item_count``.

    All tracked items of a group (``max_items`` at most) are estimated and
    ranked by (count, item), so items tied at the cut are chosen by name."""
    merged = states.groupBy(*group_cols).agg(F.expr(f"approx_top_k_combine(state, {max_items})").alias("s"))
    items = merged.select(*group_cols, F.explode(F.expr(f"approx_top_k_estimate(s, {max_items})")).alias("e"))
    flat = items.select(*group_cols, F.col("e.item").alias(item_col), F.col("e.count").alias("item_count"))
    return rank_within(flat, group_cols, [F.desc("item_count"), F.asc(item_col)], k)


def count_min_sketch(df: DataFrame, group_cols: list[str], item_col: str,
                     width: int = CMS_WIDTH, depth: int = CMS_DEPTH) -> DataFrame:
    """Sparse CMS table ``group..., row, bucket, counter``.  Items are
    counted first, so ``depth`` rows arise per distinct item, not per row."""
    buckets = F.transform(F.sequence(F.lit(0), F.lit(depth - 1)),
                          lambda r: F.struct(r.alias("row"), F.pmod(
                              md5_part(F.concat(r.cast("string"), F.lit(":"), F.col(item_col)), 0),
                              F.lit(width)).alias("bucket")))
    counts = df.groupBy(*group_cols, item_col).agg(F.count(F.lit(1)).alias("__n"))
    return (counts.select(*group_cols, "__n", F.explode(buckets).alias("__b"))
              .groupBy(*group_cols, F.col("__b.row").alias("row"), F.col("__b.bucket").alias("bucket"))
              .agg(F.sum("__n").alias("counter")))


def count_min_estimate(sketch: DataFrame, probes: DataFrame, group_cols: list[str], item_col: str,
                       width: int = CMS_WIDTH, depth: int = CMS_DEPTH) -> DataFrame:
    """A7 query: estimated count of each (group, item) in ``probes``."""
    rows = F.transform(F.sequence(F.lit(0), F.lit(depth - 1)),
                       lambda r: F.struct(r.alias("row"), F.pmod(
                           md5_part(F.concat(r.cast("string"), F.lit(":"), F.col(item_col)), 0),
                           F.lit(width)).alias("bucket")))
    p = probes.select(*group_cols, item_col, F.explode(rows).alias("__b")).select(
        *group_cols, item_col, F.col("__b.row").alias("row"), F.col("__b.bucket").alias("bucket"))
    return (p.join(sketch, [*group_cols, "row", "bucket"], "left")
             .groupBy(*group_cols, item_col)
             .agg(F.min(F.coalesce(F.col("counter"), F.lit(0))).alias("estimate")))


def bloom_dedup(df: DataFrame, item_col: str, batch_col: str, order_col: str,
                capacity: int = BLOOM_CAPACITY, error: float = BLOOM_ERROR) -> DataFrame:
    """Test-then-add Bloom dedup with one filter update per batch.

    Returns one row per (item, batch) first occurrence with ``accepted``:
    false when the filter (built from all earlier batches) claims the item.
    Hot items cost one row per batch: occurrences are first reduced to
    (item, batch) pairs by a partial aggregate.  The filter is sized for the
    distinct items where they are more than ``capacity``, so the error rate
    holds at any size.
    """
    firsts = df.groupBy(item_col, batch_col).agg(F.min(order_col).alias(order_col))
    distinct = df.select(F.approx_count_distinct(item_col, 0.02)).first()[0]
    m, k = bloom_size(max(capacity, math.ceil(1.1 * distinct)), error)
    pos = firsts.select(item_col, batch_col, order_col,
                        F.explode(hash_positions(F.col(item_col), k, m)).alias("__pos"))
    seen = pos.withColumn("__first", F.min(batch_col).over(Window.partitionBy("__pos")))
    probed = seen.groupBy(item_col, batch_col, order_col).agg(F.max("__first").alias("__latest"))
    return probed.select(item_col, batch_col, order_col,
                         (F.col("__latest") >= F.col(batch_col)).alias("accepted"))
