"""Keyed-table operators and the scalable ordering helpers vs brute force."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from postlake.operators import tables, topk
from postlake.operators.ranking import global_rank, newest_n
from postlake.sources.tables import read_table
from tests.conftest import SF001


def test_newest_n_histogram_refinement(spark):
    e = read_table(spark, SF001, "events").select("event_id")
    for n in (1, 17, 333, 999, 5000):
        got = sorted(r.event_id for r in newest_n(e, "event_id", n, fanout=4, exact_below=10).collect())
        want = sorted(r.event_id for r in e.orderBy(F.desc("event_id")).limit(n).collect())
        assert got == want


def test_global_rank_equals_row_number(spark):
    e = read_table(spark, SF001, "events").select("event_id", "user_id").repartition(5)
    order = [F.desc("user_id"), F.asc("event_id")]
    got = {r.event_id: r["rank"] for r in global_rank(e, order).collect()}
    want = {r.event_id: r.rn for r in e.withColumn("rn", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want


def test_upsert_last_write_wins(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "k int, v int, s string")
    new = spark.createDataFrame([(1, 3, "c"), (3, 4, "d")], "k int, v int, s string")
    got = sorted(tuple(r) for r in tables.upsert(old, new, ["k"], "v").collect())
    assert got == [(1, 3, "c"), (2, 2, "b"), (3, 4, "d")]


def test_update_field(spark):
    t = spark.createDataFrame([(1, ["x"]), (2, ["y"])], "id int, topics array<string>")
    u = spark.createDataFrame([(2, ["z"]), (9, ["q"])], "id int, topics array<string>")
    got = sorted((r.id, r.topics) for r in tables.update_field(t, u, "id", "topics").collect())
    assert got == [(1, ["x"]), (2, ["z"])]


def test_update_field_takes_the_last_update(spark):
    t = spark.createDataFrame([(1, "x")], "id int, v string")
    u = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (1, "c", None)], "id int, v string, at int")
    assert [tuple(r) for r in tables.update_field(t, u, "id", "v", "at").collect()] == [(1, "a")]


def test_null_order_value_keeps_the_row(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, 5, "c")], "k int, v int, s string")
    for newest in (True, False):
        assert sorted(map(tuple, tables.latest_per_key(df, ["k"], "v", newest).collect()), key=str) == [(1, None, "a"), (2, 5, "c")]


def test_page_totals_without_window(spark):
    pages = spark.range(1, 251).selectExpr("id AS position", "cast((id - 1) div 100 AS bigint) AS page_no")
    out = tables.page_totals(pages)
    assert sorted(map(tuple, out.collect())) == [(0, 100, 100), (1, 100, 200), (2, 50, 250)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_evictions_in_one_pass(spark):
    from postlake.sources.tables import event_topics
    plan = topk.topk_evictions(event_topics(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_time_range_reaches_the_scan(spark):
    import __spark_entry__ as E
    plan = E.queries()["time_range"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id" in plan


def test_guarded_load_keeps_unreadable_tables(spark, tmp_path):
    from postlake.sources import refs
    rows = spark.createDataFrame([(1, "a")], "id int, text string")
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|corrupt"):
        refs.load_once(spark, rows, str(bad))
    assert (bad / "part-0.parquet").read_text() == "not parquet"
    assert refs.load_once(spark, rows, str(tmp_path / "new")) and not refs.load_once(spark, rows, str(tmp_path / "new"))


def test_shared_folder_is_needed_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from postlake import session
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="spark://h:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake)


def test_topk_ties_break_by_topic(spark):
    rows = [("2024-01-01 00:10:00", t) for t in ["b", "a", "c", "a", "b"]]
    df = spark.createDataFrame(rows, "ts string, topic string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = [(r.topic, r.topic_count) for r in topk.hourly_topk(df, k=2).orderBy("rank").collect()]
    assert got == [("a", 2), ("b", 2)]
