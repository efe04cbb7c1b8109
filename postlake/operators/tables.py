"""Keyed-table operators.

Latest/first-per-key uses ``max_by``/``min_by`` aggregates instead of a
ranked window: partial aggregation runs map-side, so a key holding a third
of all rows costs one partial row per map task, not a sort of the hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.ranking import global_rank, newest_n

STREAM_MAX_LEN = 1_000_000        # fixed value: exact trimming length of the stream
SEARCH_PAGE_SIZE = 100            # fixed value: posts per search page
SEARCH_LOOKBACK_HOURS = 15        # fixed value: search window


def latest_per_key(df: DataFrame, key: list[str], order_col: str, newest: bool = True) -> DataFrame:
    """Upsert semantics (last write wins) or first occurrence (``newest=False``)."""
    other = [c for c in df.columns if c not in key]
    agg = F.max_by if newest else F.min_by
    # rows without an order value lose to all others but are not skipped
    order = F.struct((F.col(order_col).isNotNull() if newest else F.col(order_col).isNull()).alias("k"), F.col(order_col).alias("o"))
    packed = agg(F.struct(*other), order).alias("__r")
    return df.groupBy(*key).agg(packed).select(*key, *[F.col(f"__r.{c}").alias(c) for c in other])


def upsert(old: DataFrame, new: DataFrame, key: list[str], order_col: str) -> DataFrame:
    """Old ∪ new, keep the newest version of every key."""
    return latest_per_key(old.unionByName(new), key, order_col, newest=True)


def dedup_exact(df: DataFrame, key: list[str], order_col: str) -> DataFrame:
    """Process every key once, the earliest occurrence wins."""
    return latest_per_key(df, key, order_col, newest=False)


def update_field(table: DataFrame, updates: DataFrame, key: str, field: str, order_col: str | None = None) -> DataFrame:
    """Replace one column for keys present in ``updates`` (others keep
    their value; unknown keys in ``updates`` are ignored).  Of several updates
    of a key the last by ``order_col`` wins (else the largest value), so a key
    stays one row."""
    u = updates.select(key, F.col(field).alias("__new"), (F.col(order_col) if order_col else F.col(field)).alias("__order"))
    u = latest_per_key(u, [key], "__order").drop("__order")
    return (table.join(u, key, "left")
                 .withColumn(field, F.coalesce(F.col("__new"), F.col(field)))
                 .drop("__new").select(*table.columns))


def capped_stream(df: DataFrame, id_col: str, max_len: int = STREAM_MAX_LEN) -> DataFrame:
    """Keep exactly the newest ``max_len`` entries (exact trimming)."""
    return newest_n(df, id_col, max_len)


def batch_metrics(df: DataFrame, batch: Column, stored: Column) -> DataFrame:
    """Rows processed and rows stored per batch."""
    return df.groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(stored).alias("stored"))


def search_posts(posts: DataFrame, term: str, as_of_us: Column, hours: int = SEARCH_LOOKBACK_HOURS,
                 page_size: int = SEARCH_PAGE_SIZE, text_col: str = "text", ts_col: str = "time_us",
                 id_col: str = "uri") -> DataFrame:
    """Posts containing ``term`` newer than ``as_of - hours``, newest
    first, split into pages of ``page_size``.  Filters run first; the global
    order is computed without a single-partition window."""
    since = as_of_us - F.lit(hours * 3600 * 1_000_000)
    hits = posts.filter(F.col(text_col).contains(term) & (F.col(ts_col) >= since) & (F.col(ts_col) <= as_of_us))
    ranked = global_rank(hits, [F.desc(ts_col), F.asc(id_col)], "position")
    return ranked.withColumn("page_no", F.floor((F.col("position") - 1) / page_size).cast("long"))


def page_totals(pages: DataFrame) -> DataFrame:
    """Rows per page and the running total (one row per page).  Positions
    count from 1 without gaps, so a page's last position is the running total."""
    return pages.groupBy("page_no").agg(F.count(F.lit(1)).alias("fetched"), F.max("position").alias("running_total"))
