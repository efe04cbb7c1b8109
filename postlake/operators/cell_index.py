"""V7 over a stored index: coarse cells, a few of them probed per query.

``fit`` takes a bounded sample (the ``SAMPLE`` rows of smallest id hash), finds
coarse centres by spherical k-means on it and picks the smallest number of
probes whose recall on the sample reaches a target, against exact search there.
``build`` puts every row into its nearest centre's cell and writes the cells as
blocks of about ``BLOCK_ROWS`` rows, so a cell of any size is many rows of the
index.  ``search`` assigns queries to their nearest cells, packs them into
blocks and multiplies each with the blocks of its cells; only ``k`` candidates
per query and block leave a task.  ``measured_recall`` compares with exact
search for a bounded sample of queries.

An id stands for one row.  Null, zero and other-width vectors have no
direction: as rows they are left out of the index, as queries they find nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.operators.knn import DIST_DIGITS, matrix, nearest, top_candidates

#: Rows that fitting reads, and queries that recall is measured on, at most.
SAMPLE, CHECKED = 20_000, 256
BLOCK_ROWS = 4096
_ITERATIONS = 12
_ROWS = "array<struct<id:long,vec:array<double>>>"


def _sample(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of smallest id hash: the same rows in every run."""
    return df.orderBy(F.xxhash64("id"), "id").limit(n)


def _rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    vec = F.col(vec_col).cast("array<double>")
    usable = vec.isNotNull() & F.exists(vec, lambda x: x != 0) & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x))
    return df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).where(usable & F.col("id").isNotNull())


@dataclass
class Centres:
    """Unit centres, one row each, and the number of cells to probe."""

    unit: np.ndarray
    probes: int
    sample_recall: float


def _kmeans(unit: np.ndarray, cells: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = unit[rng.choice(len(unit), cells, replace=False)].copy()
    for _ in range(_ITERATIONS):
        own = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, unit)
        norm = np.linalg.norm(sums, axis=1)
        centres[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return centres


def fit(vectors: DataFrame, *, id_col: str = "id", vec_col: str = "embedding", cells: int | None = None, k: int = 5,
        target: float = 0.97, sample: int = SAMPLE, seed: int = 5) -> Centres:
    """Centres and probes from at most ``sample`` rows.  ``cells`` defaults to
    the root of the table's row count, at most a tenth of the sample."""
    rows = _rows(vectors, id_col, vec_col)
    got = _sample(rows, sample).toArrow()
    unit = matrix(got["vec"])
    unit = unit[np.linalg.norm(unit, axis=1) > 0]
    if not len(unit):
        return Centres(np.zeros((1, 0)), 1, 1.0)
    cells = max(1, min(cells or math.isqrt(rows.count()), max(1, len(unit) // 10)))
    centres = _kmeans(unit, cells, seed)
    own = (unit @ centres.T).argmax(1)
    queries = unit[:2_000]
    exact, _ = top_candidates(queries, unit, k + 1)          # a sample row also finds itself
    order = np.argsort(-(queries @ centres.T), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(cells)[None, :], 1)
    needed = np.sort(np.take_along_axis(place, own[exact], 1)[:, 1:].ravel()) + 1
    probes = int(needed[min(len(needed) - 1, math.ceil(target * len(needed)))]) if len(needed) else 1
    return Centres(centres, probes, float((needed <= probes).mean()) if len(needed) else 1.0)


def _nearest_cells(df: DataFrame, centres: Centres, n: int) -> DataFrame:
    """Adds ``cell``, one row for each of the ``n`` nearest cells."""
    shared = df.sparkSession.sparkContext.broadcast(centres.unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = shared.value
        for batch in batches:
            own = matrix(batch["vec"], unit.shape[1])
            keep = np.flatnonzero(np.linalg.norm(own, axis=1) > 0)
            where, _ = top_candidates(own[keep], unit, n)
            at = pa.array(np.repeat(keep, where.shape[1]))
            yield pa.RecordBatch.from_arrays([batch["id"].take(at), batch["vec"].take(at), pa.array(where.ravel().astype(np.int32))], names=["id", "vec", "cell"])

    return df.mapInArrow(run, "id long, vec array<double>, cell int")


def _blocks(assigned: DataFrame, sizes: DataFrame, name: str) -> DataFrame:
    """``cell, <name>, rows``: rows of a cell in blocks.  ``sizes`` has one row a cell."""
    key = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias(name)
    return (assigned.join(F.broadcast(sizes), "cell").select("cell", key, F.struct("id", "vec").alias("r"))
            .groupBy("cell", name).agg(F.collect_list("r").alias("rows")))


def _sizes(assigned: DataFrame, block_rows: int) -> DataFrame:
    return assigned.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))


def build(vectors: DataFrame, centres: Centres, path: str, *, id_col: str = "id", vec_col: str = "embedding",
          block_rows: int = BLOCK_ROWS) -> None:
    """Writes the index of every row: ``path/cells`` (assigned rows), ``path/sizes``, ``path/blocks``."""
    spark = vectors.sparkSession
    _nearest_cells(_rows(vectors, id_col, vec_col), centres, 1).write.parquet(f"{path}/cells")
    cells = spark.read.parquet(f"{path}/cells")
    _sizes(cells, block_rows).write.parquet(f"{path}/sizes")
    _blocks(cells, spark.read.parquet(f"{path}/sizes"), "block").write.parquet(f"{path}/blocks")


def search(spark: SparkSession, path: str, centres: Centres, queries: DataFrame, k: int, *, id_col: str = "query_id",
           vec_col: str = "embedding", probes: int | None = None, block_rows: int = BLOCK_ROWS,
           round_digits: int | None = DIST_DIGITS) -> DataFrame:
    """``query_id, ref_id, distance, rank`` of the ``k`` nearest rows in the
    probed cells; ties by id."""
    index, sizes = spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/sizes")
    assigned = _nearest_cells(_rows(queries, id_col, vec_col), centres, min(probes or centres.probes, len(centres.unit)))
    packed = _blocks(assigned, _sizes(assigned, block_rows), "q").withColumnRenamed("rows", "queries")
    pairs = (packed.join(F.broadcast(sizes), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .join(index, ["cell", "block"]).select("queries", "rows"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, refs = (pa.Table.from_struct_array(batch[c][i].values).sort_by("id") for c in ("queries", "rows"))
                unit = matrix(refs["vec"])
                where, dist = top_candidates(matrix(own["vec"], unit.shape[1]), unit, k)
                ids = refs["id"].combine_chunks().take(pa.array(where.ravel()))
                query = own["id"].combine_chunks().take(pa.array(np.repeat(np.arange(own.num_rows), where.shape[1])))
                yield pa.RecordBatch.from_arrays([query, ids, pa.array(dist.ravel())], names=["query_id", "ref_id", "distance"])

    found = pairs.mapInArrow(run, "query_id long, ref_id long, distance double")
    best = found.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "ref_id"))), 1, k).alias("top"))
    top = best.select("query_id", F.posexplode("top").alias("at", "c"))
    dist = F.col("c.distance") if round_digits is None else F.round("c.distance", round_digits)
    return top.select("query_id", F.col("c.ref_id").alias("ref_id"), dist.alias("distance"), (F.col("at") + 1).alias("rank"))


def measured_recall(found: DataFrame, queries: DataFrame, vectors: DataFrame, k: int, *, id_col: str = "id", query_col: str = "query_id",
                    vec_col: str = "embedding", checked: int = CHECKED) -> DataFrame:
    """One row ``recall, checked``: the share of the exact ``k`` nearest that
    ``found`` holds, over the ``checked`` queries of smallest id hash."""
    some = _sample(_rows(queries, query_col, vec_col), checked)
    refs = _rows(vectors, id_col, vec_col).withColumnRenamed("id", "ref_id")
    exact = nearest(some, refs, k, q_vec="vec", r_vec="vec", keep=("id",)).where(F.col("ref_id").isNotNull())
    hits = found.select(F.col("query_id").alias("id"), "ref_id", F.lit(1).alias("hit"))
    return exact.join(hits, ["id", "ref_id"], "left").agg(
        F.round(F.coalesce(F.sum("hit"), F.lit(0)) / F.count(F.lit(1)), 6).alias("recall"), F.count_distinct("id").alias("checked"))
