"""Stream result = batch result for the streaming operators."""

from tests.conftest import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_topk_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    assert _rows(q["stream_topk"](spark, SF001)) == _rows(q["hourly_topk"](spark, SF001))


def test_stream_dedup_equals_batch(spark):
    import __spark_entry__ as E
    q = E.queries()
    s = q["stream_dedup"](spark, SF001)
    b = q["dedup_exact"](spark, SF001).select("user_id", "event_type", "event_id")
    assert _rows(s) == _rows(b)


def test_late_rows_count_and_are_written_out(spark):
    from postlake.plans.q_streaming import stream_topk_log
    from postlake.sources.tables import read_table
    events = read_table(spark, SF001, "events")
    late = stream_topk_log(spark, events, newest_first=True)
    in_order = stream_topk_log(spark, events, newest_first=False)
    total = lambda p: spark.read.parquet(p + "/counts").agg({"topic_count": "sum"}).first()[0]
    assert total(late) == total(in_order) == 2 * events.count()
    assert spark.read.parquet(late + "/counts").select("batch_id").distinct().count() == 4
    assert spark.read.parquet(late + "/late").count() > events.count() // 2 and spark.read.parquet(in_order + "/late").count() == 0


def test_restart_between_batches(spark):
    """A stopped stream goes on behind its last batch and counts nothing twice."""
    from postlake.sources.tables import read_table
    from postlake.streaming import jobs
    events = read_table(spark, SF001, "events").select("event_id", "ts")
    path, out = jobs.arriving_files(events, "event_id"), jobs.new_dir(spark, "restart")
    write = lambda: jobs.file_stream(spark, path, max_files=1).writeStream.foreachBatch(jobs.batch_writer(out + "/rows"))
    q = write().option("checkpointLocation", out + "/ck").trigger(processingTime="0 seconds").start()
    while q.lastProgress is None or q.lastProgress["batchId"] < 1:
        q.awaitTermination(0.05)
    q.stop()
    jobs.run(write(), out + "/ck", every=0.1)
    jobs.run(write(), out + "/ck")
    rows = spark.read.parquet(out + "/rows")
    assert rows.count() == rows.select("event_id").distinct().count() == events.count()
    assert rows.select("batch_id").distinct().count() == 4


def test_entry_ids_grow_over_batches(spark):
    from postlake.plans.q_streaming import _documents, append_posts
    rows = sorted((r.batch_id, r.seq, r.doc_id) for r in append_posts(spark, *_documents(spark, SF001, 3)).collect())
    assert [d for *_, d in rows] == sorted(d for *_, d in rows) and len({b for b, *_ in rows}) == 3


def test_vocabulary_gets_each_topic_once(spark):
    from postlake.plans.q_streaming import stream_enrich
    base = stream_enrich(spark, SF001)
    words = [r.topic for r in spark.read.parquet(base + "/vocabulary").collect()]
    counted = {r.topic for r in spark.read.parquet(base + "/counts").collect()}
    assert sorted(words) == sorted(set(words)) and set(words) == counted


def test_consumer_groups_independent_and_idempotent(spark):
    import __spark_entry__ as E
    rows = {(r.grp, r.run): r.n for r in E.queries()["consume_group"](spark, SF001).collect()}
    assert rows[("filter-group", 1)] == rows[("topic-group", 1)] > 0
    assert rows[("filter-group", 2)] == rows[("topic-group", 2)] == 0


def test_state_stays_bounded_and_repeats_are_dropped(spark):
    """D1 with expiring state: ten batches hold what arrives within the lateness, not the stream."""
    from postlake.plans.q_streaming import deliveries, stream_unique
    from postlake.sources.tables import read_table
    from postlake.streaming import late
    events = read_table(spark, SF001, "events")
    out, progress = stream_unique(spark, events, steps=10)
    ids = [r.event_id for r in out.select("event_id").collect()]
    assert len(ids) == len(set(ids)) < events.count()
    assert late.observed_rows(progress) == deliveries(events, 10).count()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert len(held) >= 10 and max(held) <= 1.5 * held[0] and max(held) < 0.2 * events.count()
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress if p["stateOperators"]) > 0


def test_windows_close_behind_the_watermark(spark):
    from pyspark.sql import functions as F

    from postlake.plans.q_streaming import stream_windows
    from postlake.sources.tables import read_table
    from postlake.streaming import late
    events = read_table(spark, SF001, "events")
    out, progress = stream_windows(spark, events)
    rows = out.collect()
    assert len({(r.hour, r.event_type) for r in rows}) == len(rows)      # each window comes out once
    batch = {(r.hour, r.event_type): r.n for r in events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_type")
             .agg(F.count("*").alias("n")).collect()}
    assert all(r.n <= batch[r.hour, r.event_type] for r in rows) and sum(r.n for r in rows) < events.count()
    assert late.observed_rows(progress) == events.count()
    assert sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"]) > 0


def test_raw_lines_and_quarantine(spark):
    from postlake.plans.q_streaming import stream_raw
    from postlake.sources.tables import posts
    rows = posts(spark, SF001)
    out, progress = stream_raw(spark, rows)
    bad = rows.where("doc_id % 11 = 3").count()
    seen = [p["observedMetrics"]["raw"] for p in progress if "raw" in p["observedMetrics"]]
    assert sum(s["rows"] for s in seen) == rows.count() and sum(s["quarantined"] for s in seen) == bad > 0
    assert out.where("sink = 'quarantine'").count() == bad and out.where("line IS NOT NULL AND uri IS NOT NULL").count() == 0


def test_a_step_has_a_file_for_each_core(spark):
    """A large step is written and read by all cores, a small one by two."""
    from postlake.streaming import jobs
    cores = spark.sparkContext.defaultParallelism
    assert jobs.files_per_step(spark.range(400_000)) == max(2, cores) > 2 == jobs.files_per_step(spark.range(200))
    path = jobs.arriving_files(spark.range(40_000), "id", 4, per_step=cores)
    assert len(spark.read.parquet(path).inputFiles()) == 4 * cores and spark.read.parquet(path).count() == 40_000


def test_enrich_finds_a_post_once_and_counts_it_from_there(spark):
    """The posts' topics are one written row a post, from which table and counts come."""
    import glob

    from pyspark.sql import functions as F

    from postlake.plans.q_streaming import stream_enrich
    from postlake.session import shared_dir
    before = set(glob.glob(shared_dir(spark) + "/said-*"))
    base = stream_enrich(spark, SF001)
    said = spark.read.parquet(*(set(glob.glob(shared_dir(spark) + "/said-*")) - before))
    assert said.count() == said.select("doc_id").distinct().count() > 0
    total = spark.read.parquet(base + "/counts").agg(F.sum("topic_count")).first()[0]
    assert total == said.agg(F.sum(F.size("topics"))).first()[0]
    assert total == spark.read.parquet(base + "/posts").agg(F.sum(F.greatest(F.size("topics"), F.lit(0)))).first()[0]
