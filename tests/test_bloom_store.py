"""The stored Bloom filter: no item is forgotten, few are taken for known, at any size."""

import pytest

from postlake.operators.bloom_store import BloomStore
from postlake.session import scratch_path


def _items(spark, lo, hi):
    return spark.range(lo, hi).selectExpr("concat('at://post/', id) AS item")


def _accepted(df):
    rows = df.collect()
    assert len(rows) == len({r.item for r in rows})
    return {r.item for r in rows if r.accepted}


def test_second_run_rejects_what_the_first_added(spark):
    path = scratch_path(spark, "bloom")
    first = _accepted(BloomStore(spark, path, 2_000).add(_items(spark, 0, 1_500), 0))
    again = BloomStore(spark, path, 2_000)          # another run: only the stored table is left
    assert len(first) > 1_480 and not _accepted(again.add(_items(spark, 0, 1_500), 1)) & first
    known = {r.item for r in again.known(_items(spark, 0, 3_000)).collect() if r.known}
    assert first <= known and len(known) < 1_500 + 0.01 * 1_500


def test_error_holds_at_ten_times_the_first_size(spark):
    store = BloomStore(spark, scratch_path(spark, "bloom"), 1_000)
    wrong = 0
    for batch in range(5):
        wrong += 2_000 - len(_accepted(store.add(_items(spark, batch * 2_000, (batch + 1) * 2_000), batch)))
    layers = {layer for layer, _ in store.log().values()}
    assert wrong <= 0.02 * 10_000 and len(layers) > 1 and max(layers) <= 4
    assert store.known(_items(spark, 0, 10_000)).where("not known").count() <= wrong
    fresh = store.known(_items(spark, 10_000, 20_000)).where("known").count()
    assert fresh <= 0.02 * 10_000


def test_replay_and_awkward_items(spark):
    store = BloomStore(spark, scratch_path(spark, "bloom"), 100)
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4), ("x" * 100_000, 5)], "item string, batch_id int")
    first = _accepted(store.add(rows, 0))
    assert first == {"a", None, "", "x" * 100_000}
    assert _accepted(store.add(rows, 0)) == first      # the same batch again: the same answer, nothing added
    assert store.log() == {0: (0, 4)}
    assert _accepted(store.add(rows.limit(0), 1)) == set() and _accepted(store.add(rows, 2)) == set()


@pytest.mark.parametrize("batches", [(30, 30, 30)])
def test_only_touched_pieces_are_rewritten(spark, batches):
    store = BloomStore(spark, scratch_path(spark, "bloom"), 1_000_000)
    lo = 0
    for i, n in enumerate(batches):
        store.add(_items(spark, lo, lo + n), i)
        lo += n
        pieces = spark.read.parquet(f"{store.path}/pieces/batch_id={i}").count()
        assert pieces <= n * store.layer_size(0)[1] and pieces < store.layer_size(0)[0] // 32_768
