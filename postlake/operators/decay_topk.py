"""Decaying top-k (A3, A4): a count table whose cells are held by one item.

``depth`` rows of ``width`` cells per group.  A cell is held by the most frequent
of the items that hash to it; each occurrence of another item takes one off the
holder's count ``c`` with probability ``decay ** c``, so heavy holders keep their
count and light ones fade.  The table is kept before decay: the holder, its own
count and the occurrences of others.  That is a grouped aggregate, needs no
order of arrival, and tables of parts or batches add up cell by cell; the decay
of ``m`` others is then applied at once, by its expectation: with ``b = 1 /
decay``, ``b ** c`` shrinks by ``ln b`` each time, so ``c`` becomes
``c + log_b(1 - m * ln(b) * decay ** c)``, or 0.

Merging loses only counts of items that did not hold their cell in a part.  So
for every merge order a cell's total is the same, a holder's count is at most
the item's true count, and short of it by at most the cell's ``others``.

Items are counted per group before they meet the table, so a hot item is one
row a map task; ``depth`` rows arise per distinct item.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.sketches import md5_part
from postlake.operators.topk import TOPK_K, rank_within

# Fixed values of the reference's sketch.
WIDTH, DEPTH, DECAY = 3000, 10, 0.9


def count_table(df: DataFrame, group_cols: list[str], item_col: str, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """``group..., row, bucket, item, n, others`` of the items of each group.
    Null items do not count."""
    cells = F.transform(F.sequence(F.lit(0), F.lit(depth - 1)), lambda r: F.struct(r.alias("row"), F.pmod(
        md5_part(F.concat(r.cast("string"), F.lit(":"), F.col(item_col)), 0), F.lit(width)).alias("bucket")))
    counts = df.where(F.col(item_col).isNotNull()).groupBy(*group_cols, item_col).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.select(*group_cols, F.explode(cells).alias("cell"), F.col(item_col).alias("item"), "n", F.lit(0).cast("long").alias("others"))
    return _held(rows.select(*group_cols, "cell.row", "cell.bucket", "item", "n", "others"), group_cols)


def merge(tables: DataFrame, group_cols: list[str]) -> DataFrame:
    """Adds up tables of the same groups (any rows of :func:`count_table`)."""
    cell = [*group_cols, "row", "bucket"]
    return _held(tables.groupBy(*cell, "item").agg(F.sum("n").alias("n"), F.sum("others").alias("others")), group_cols)


def _held(rows: DataFrame, group_cols: list[str]) -> DataFrame:
    """One row per cell: its holder (the smallest of equally frequent items)."""
    top = F.min(F.struct((-F.col("n")).alias("less"), "item"))
    held = rows.groupBy(*group_cols, "row", "bucket").agg(top.alias("top"), F.sum(F.col("n") + F.col("others")).alias("total"))
    return held.select(*group_cols, "row", "bucket", F.col("top.item").alias("item"), (-F.col("top.less")).alias("n"),
                       (F.col("total") + F.col("top.less")).alias("others"))


def decayed(n: Column, others: Column, decay: float = DECAY) -> Column:
    """A holder's count after the occurrences of others, rounded to 6 digits."""
    left = 1 - others * F.lit(math.log(1 / decay)) * F.pow(F.lit(decay), n)
    return F.round(F.greatest(F.lit(0.0), F.when(left > 0, n + F.log(left) / F.lit(math.log(1 / decay))).otherwise(0.0)), 6)


def top_items(table: DataFrame, group_cols: list[str], k: int = TOPK_K, decay: float = DECAY) -> DataFrame:
    """``group..., item, item_count, rank``: the ``k`` items of the largest
    counts; an item's count is the largest of the cells it holds."""
    items = table.groupBy(*group_cols, "item").agg(F.max(decayed(F.col("n"), F.col("others"), decay)).alias("item_count"))
    return rank_within(items.where("item_count > 0"), group_cols, [F.desc("item_count"), F.asc("item")], k)


def top_by_batch(tables: DataFrame, group_cols: list[str], batch_col: str, k: int = TOPK_K, decay: float = DECAY) -> DataFrame:
    """Top items after each batch of a group, and the batch that evicts them.

    ``tables`` holds one table per (group, ``batch_col``); batches are numbered
    in order and accumulate.  Adds ``evicted``: true if the item is not among
    the top items after the group's next batch.  A table's rows are repeated for
    the group's later batches, so batches of a group should be few.
    """
    keys = tables.select(*group_cols, batch_col).distinct()
    order = Window.partitionBy(*group_cols).orderBy(batch_col)
    after = keys.withColumn("next", F.lead(batch_col).over(order))
    later = keys.join(keys.withColumnRenamed(batch_col, "from"), group_cols).where(F.col("from") <= F.col(batch_col))
    grown = tables.withColumnRenamed(batch_col, "from").join(later, [*group_cols, "from"]).drop("from")
    top = top_items(merge(grown, [*group_cols, batch_col]), [*group_cols, batch_col], k, decay)
    stays = top.select(*group_cols, F.col(batch_col).alias("next"), "item", F.lit(True).alias("stays"))
    return (top.join(after, [*group_cols, batch_col]).join(stays, [*group_cols, "next", "item"], "left")
            .withColumn("evicted", F.col("next").isNotNull() & F.col("stays").isNull()).drop("next", "stays"))
