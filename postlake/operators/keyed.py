"""A keyed table on disk (S13, S14): rows by key in hash buckets, and a cursor
over it (S16).

``KeyedTable`` holds one row per key below ``path``, partitioned by
``bucket = hash(key) mod buckets``.  An update reads the buckets that its keys
fall into (the others are pruned), merges them and overwrites just these
(dynamic partition overwrite: staged by the tasks, which may be lost and run
again, and put in place by the driver's commit), so the bytes
rewritten grow with the update and not with the table.  The last version by
``order_col`` wins, also against the stored one, so a replayed update changes
nothing.  Buckets are many and small: one task each, of bounded size if
``buckets`` grows with the table (``buckets_for``).

Cases: a null key is a key; rows without an order value lose to all others; of
equal order values the largest row wins; an empty update writes nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.operators.tables import SEARCH_LOOKBACK_HOURS, SEARCH_PAGE_SIZE
from postlake.operators.topics import saved

BUCKET_ROWS = 500_000


def buckets_for(rows: int, least: int = 16) -> int:
    """Buckets of a table that is to hold ``rows`` keys."""
    return max(least, -(-rows // BUCKET_ROWS))


@dataclass
class KeyedTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    key: str
    order_col: str
    buckets: int = 16

    def read(self) -> DataFrame:
        """All rows, one per key (none before the first update)."""
        return self._stored().drop("bucket")

    def _stored(self) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        try:
            return self.spark.read.schema(full).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], full)

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names).withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _merge(self, rows: DataFrame) -> DataFrame:
        """The newest row per key.  The rows are dealt by bucket once, for the
        merge and the write, and the greatest (has an order value, order value,
        other columns) is the row itself, so it is moved once and held once."""
        other = [c for c in self.schema.names if c != self.key]
        order = F.struct(F.col(self.order_col).isNotNull().alias("__has"), F.col(self.order_col).alias("__order"), *other)
        best = rows.repartition("bucket").groupBy("bucket", self.key).agg(F.max(order).alias("__r"))
        return best.select(*(F.col(self.key) if c == self.key else F.col(f"__r.{c}").alias(c) for c in self.schema.names), "bucket")

    def upsert(self, rows: DataFrame) -> list[int]:
        """Merges ``rows`` into the table; the buckets rewritten."""
        new = self._bucketed(rows)
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # at most ``buckets`` numbers
        if touched:
            old = self._stored().where(F.col("bucket").isin(touched))
            self._write(self._merge(new.unionByName(old)), dealt=True)
        return touched

    def update_field(self, updates: DataFrame, field: str) -> list[int]:
        """Replaces ``field`` of the keys in ``updates`` (key, field; one row a
        key); unknown keys are ignored, others keep their value, as do keys
        whose new value is null."""
        key = self.key
        new = updates.select(F.col(key).alias("__k"), F.col(field).alias("__v"), F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int").alias("bucket"))
        touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())
        if touched:
            old = self._stored().where(F.col("bucket").isin(touched))
            # Written, so that Spark knows the size and need not move the table for a small update.
            new = saved(new, "field-updates")
            joined = old.join(new.drop("bucket"), old[key].eqNullSafe(new["__k"]), "left")
            kept = F.when(F.col("__v").isNotNull(), F.col("__v")).otherwise(F.col(field))
            self._write(joined.select(*(kept.alias(c) if c == field else F.col(c) for c in self.schema.names), "bucket"))
        return touched

    def _write(self, rows: DataFrame, dealt: bool = False) -> None:
        ((rows if dealt else rows.repartition("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(self.path))


@dataclass(frozen=True)
class Cursor:
    """Place behind the last hit of a page."""
    ts: int
    id: str


def search_page(posts: DataFrame, term: str, as_of_us: Column, cursor: Cursor | None = None, hours: int = SEARCH_LOOKBACK_HOURS,
                page_size: int = SEARCH_PAGE_SIZE, text_col: str = "text", ts_col: str = "time_us",
                id_col: str = "uri") -> tuple[DataFrame, Cursor | None]:
    """S16 with a resumable cursor: the next page of posts containing ``term``
    newer than ``as_of - hours``, newest first (ties by id), and the cursor
    behind it; none behind the last page.

    The cursor is a filter on (time, id), so a page is a top-n over what is left
    (each task keeps a page at most) and no hit list is ranked or stored; it
    holds across restarts and as long as posts only arrive at the top."""
    since = as_of_us - F.lit(hours * 3600 * 1_000_000)
    hits = posts.filter(F.col(text_col).contains(term) & (F.col(ts_col) >= since) & (F.col(ts_col) <= as_of_us))
    if cursor:
        hits = hits.filter((F.col(ts_col) < cursor.ts) | ((F.col(ts_col) == cursor.ts) & (F.col(id_col) > cursor.id)))
    # one more row than the page tells whether there is another page
    rows = hits.orderBy(F.desc(ts_col), F.asc(id_col)).limit(page_size + 1).collect()
    page = rows[:page_size]
    schema = hits.schema
    behind = Cursor(page[-1][ts_col], page[-1][id_col]) if len(rows) > page_size else None
    return posts.sparkSession.createDataFrame(page, schema), behind
