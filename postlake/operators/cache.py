"""Semantic cache filling with the reference's sequential semantics (V6).

Requests are answered in id order.  Request j *hits* iff some entry inserted
earlier (an entry of the initial cache, or an earlier miss with an answer: a
*leader*) lies strictly within ``max_distance``; it then gets the answer of
the nearest such entry.  Otherwise it misses, is answered and inserted.  A
request whose answer is blank is a miss and is not inserted.

Rounds, each a written table in the shared folder:

1. the ``window`` smallest ids not yet known to hit are resolved in order in
   one task (``window`` rows at most); the leaders among them are final;
2. these new leaders, at most ``window``, are broadcast and every remaining
   row is scored against them alone, in Arrow batches; rows keep the best
   earlier entry so far;
3. rows up to the window's last id are finished and leave the work table.

So neither a broadcast nor a task grows with the leader set, and each row is
scored once against each earlier leader.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.operators.knn import matrix, nearest
from postlake.session import scratch_path

WINDOW = 2000
#: Distances that a task holds at once.
SCORE_CELLS = 1_000_000
_STATE = "id long, vec array<double>, blank boolean, best double, source long, cached boolean"


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "cache-fill")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _resolve(t: float):
    """The leaders of one window, in id order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).sort_by("id")
        unit, blank = matrix(rows["vec"]), rows["blank"].to_pylist()
        lead: list[int] = []
        for i in range(len(unit)):
            if not blank[i] and not (lead and bool((1.0 - unit[lead] @ unit[i] < t).any())):
                lead.append(i)
        leaders = rows.take(pa.array(lead, pa.int64())).select(["id", "vec"])
        yield from leaders.combine_chunks().to_batches()
    return run


def _score(leaders):
    """Best earlier entry of each row, given the broadcast new leaders."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, unit = leaders.value
        step = max(1, SCORE_CELLS // max(1, len(ids)))
        for batch in (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step)):
            own, best = batch["id"].to_numpy(), batch["best"].to_numpy(zero_copy_only=False).astype(float)
            source, cached = batch["source"].to_pylist(), batch["cached"].to_pylist()
            d = matrix(batch["vec"], unit.shape[1]) @ unit.T
            np.subtract(1.0, d, out=d)
            d[ids[None, :] >= own[:, None]] = np.inf
            at = d.argmin(1)
            low = d[np.arange(len(d)), at]
            for i in np.flatnonzero((low < best) | (np.isnan(best) & np.isfinite(low))):
                best[i], source[i], cached[i] = low[i], int(ids[at[i]]), False
            yield pa.RecordBatch.from_arrays([batch["id"], batch["vec"], batch["blank"], pa.array(best, from_pandas=True),
                                              pa.array(source, pa.int64()), pa.array(cached, pa.bool_())], names=["id", "vec", "blank", "best", "source", "cached"])
    return run


def semantic_cache_fill(requests: DataFrame, max_distance: float, id_col: str = "id", vec_col: str = "embedding",
                        window: int = WINDOW, cache: DataFrame | None = None, blank_col: str | None = None) -> DataFrame:
    """Output ``id, hit, source_id, distance, from_cache``: ``source_id`` is the
    request (or, with ``from_cache``, the entry of ``cache``: ``ref_id,
    embedding``) whose answer is served; a miss serves itself."""
    spark, t = requests.sparkSession, float(max_distance)
    blank = F.coalesce(F.col(blank_col), F.lit(False)) if blank_col else F.lit(False)
    base = requests.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), blank.alias("blank"))
    none = [F.lit(None).cast("double").alias("best"), F.lit(None).cast("long").alias("source"), F.lit(False).alias("cached")]
    if cache is not None:
        near = nearest(base, cache, 1, q_vec="vec", keep=("id",), round_digits=None).select(
            F.col("id").alias("__id"), "distance", F.col("ref_id").cast("long").alias("__ref"))
        base = base.join(near, base["id"] == near["__id"], "left").select(
            "id", "vec", "blank", F.col("distance").alias("best"), F.col("__ref").alias("source"), F.col("__ref").isNotNull().alias("cached"))
    else:
        base = base.select("*", *none)
    todo, done = _written(base), []
    while True:
        open_rows = todo.where(F.col("best").isNull() | (F.col("best") >= t))
        win = _written(open_rows.orderBy("id").limit(window).coalesce(1))
        last = win.agg(F.max("id")).first()[0]
        if last is None:
            done.append(todo)
            break
        leaders = win.select("id", "vec", "blank").coalesce(1).mapInArrow(_resolve(t), "id long, vec array<double>").toArrow()
        if leaders.num_rows:
            shared = spark.sparkContext.broadcast((leaders["id"].to_numpy(), matrix(leaders["vec"])))
            todo = _written(todo.mapInArrow(_score(shared), _STATE))
        done.append(todo.where(F.col("id") <= last))
        todo = todo.where(F.col("id") > last)
    rows = reduce(DataFrame.unionByName, done)
    hit = F.coalesce(F.col("best") < t, F.lit(False))
    return rows.select(
        F.col("id").alias(id_col), hit.alias("hit"),
        F.when(hit, F.col("source")).otherwise(F.col("id")).alias("source_id"),
        F.when(hit, F.round("best", 9)).otherwise(F.lit(0.0)).alias("distance"),
        (hit & F.col("cached")).alias("from_cache"))
