"""V6 sequential cache semantics vs a plain loop."""

import numpy as np
from pyspark.sql import functions as F

from postlake.operators.cache import semantic_cache_fill
from postlake.sources.tables import read_table
from tests.conftest import SF001


def _loop(ids, vecs, t):
    vecs = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    cache, out = [], {}
    for i, v in zip(ids, vecs):
        if cache:
            d = 1 - np.array([vecs[j] @ v for j in cache])
            k = int(np.argmin(d))
            if d[k] < t:
                out[i] = (True, ids[cache[k]])
                continue
        cache.append(len(out))
        out[i] = (False, i)
    return out


def test_cache_fill_equals_sequential_loop(spark):
    e = read_table(spark, SF001, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    pdf = e.toPandas().sort_values("id")
    ids = [int(x) for x in pdf["id"]]
    vecs = np.stack(pdf["embedding"].map(np.asarray).to_numpy()).astype(np.float64)
    for t, win in ((0.68, 2000), (0.72, 37)):
        want = _loop(ids, vecs, t)
        got = {r.id: (r.hit, r.source_id) for r in semantic_cache_fill(e, t, window=win).collect()}
        assert got == want
        assert any(h for h, _ in got.values())


def test_initial_cache_and_blank_answers(spark):
    v = {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [0.7, 0.7]}
    req = spark.createDataFrame([(1, v["a"], False), (2, v["b"], True), (3, v["b"], False), (4, v["b"], False), (5, v["a"], False), (6, None, False)],
                                "id long, embedding array<float>, blank boolean")
    cache = spark.createDataFrame([(100, v["a"])], "ref_id long, embedding array<float>")
    for window in (1, 100):
        got = {r.id: (r.hit, r.source_id, r.from_cache) for r in
               semantic_cache_fill(req, 0.2, cache=cache, blank_col="blank", window=window).collect()}
        assert got == {1: (True, 100, True), 2: (False, 2, False), 3: (False, 3, False), 4: (True, 3, False), 5: (True, 100, True), 6: (False, 6, False)}
    assert semantic_cache_fill(req.limit(0), 0.2).count() == 0


def test_scores_are_held_in_small_slices(monkeypatch):
    """A task scores as many rows at once as ``SCORE_CELLS`` allows, not a whole Arrow batch."""
    from types import SimpleNamespace

    import pyarrow as pa

    from postlake.operators import cache
    monkeypatch.setattr(cache, "SCORE_CELLS", 60, raising=False)
    vecs = np.random.default_rng(1).normal(size=(100, 4))
    ids, unit = np.arange(20), vecs[:20] / np.linalg.norm(vecs[:20], axis=1, keepdims=True)
    batch = pa.record_batch([pa.array(range(100)), pa.array(vecs.tolist()), pa.array([False] * 100), pa.nulls(100, pa.float64()),
                             pa.nulls(100, pa.int64()), pa.array([False] * 100)], names=["id", "vec", "blank", "best", "source", "cached"])
    out = list(cache._score(SimpleNamespace(value=(ids, unit)))([batch]))
    assert max(b.num_rows for b in out) == 3 and sum(b.num_rows for b in out) == 100
    near = 1 - (vecs / np.linalg.norm(vecs, axis=1, keepdims=True)) @ unit.T
    near[ids[None, :] >= np.arange(100)[:, None]] = np.inf
    assert [r["source"] for b in out for r in b.to_pylist()][1:] == near.argmin(1)[1:].tolist()
