"""Vector queries on ``embeddings``: references are every tenth vector, the
rest are queries (FIXTURES.md).  The reference thresholds (0.53 / 0.2 / 0.55)
find nothing on these 64-d fixtures, so the registered queries use
calibrated ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.operators import cell_index, knn
from postlake.plans.registry import register
from postlake.plans.sql import QUERIES, REFS, fill_cte, with_
from postlake.session import scratch_path
from postlake.sources.tables import query_vectors, read_table, ref_vectors

FIX_CLASSIFY = 0.72
FIX_ROUTE = {"r0": 0.70, "r1": 0.75}
FIX_CACHE = 0.68

_D = """d AS (
  SELECT q.query_id, r.ref_id, r.route, r.answer,
         list_cosine_distance(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS distance
  FROM queries q, refs r)"""
_NN = """nn AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, ref_id) AS rank FROM d)
  WHERE rank <= {k})"""
_HEAD = with_(REFS, QUERIES, _D)


def _q(spark, sf_dir):
    return query_vectors(spark, sf_dir).select("query_id", "embedding")


@register("knn", sql=_HEAD + "," + _NN.format(k=3) + """
SELECT query_id, ref_id, round(distance, 9) AS distance, rank FROM nn""")
def q_knn(spark, sf_dir):
    return knn.nearest(_q(spark, sf_dir), ref_vectors(spark, sf_dir), k=3)


@register("score_projection", sql=_HEAD + "," + _NN.format(k=1) + """
SELECT query_id, ref_id, route, answer, round(distance, 9) AS distance FROM nn""")
def q_score_projection(spark, sf_dir):
    nn = knn.nearest(_q(spark, sf_dir), ref_vectors(spark, sf_dir), 1, payload=("route", "answer"))
    return nn.select("query_id", "ref_id", "route", "answer", "distance")


@register("distance_predicate", sql=_HEAD + "," + _NN.format(k=1) + f"""
SELECT query_id, ref_id, round(distance, 9) AS distance FROM nn WHERE distance < {FIX_CLASSIFY}""")
def q_distance_predicate(spark, sf_dir):
    nn = knn.nearest(_q(spark, sf_dir), ref_vectors(spark, sf_dir), 1, round_digits=None)
    return (nn.filter(F.col("distance") < FIX_CLASSIFY)
              .select("query_id", "ref_id", F.round("distance", 9).alias("distance")))


@register("classified_pairs", sql=_HEAD + "," + _NN.format(k=1) + f"""
SELECT query_id, ref_id, round(distance, 9) AS distance, distance < {FIX_CLASSIFY} AS is_related FROM nn""")
def q_classified_pairs(spark, sf_dir):
    return knn.classify(_q(spark, sf_dir), ref_vectors(spark, sf_dir), FIX_CLASSIFY)


@register("semantic_classify", sql=_HEAD + "," + _NN.format(k=1) + f"""
SELECT query_id FROM nn WHERE distance < {FIX_CLASSIFY}""")
def q_semantic_classify(spark, sf_dir):
    c = knn.classify(_q(spark, sf_dir), ref_vectors(spark, sf_dir), FIX_CLASSIFY)
    return c.filter("is_related").select("query_id")


def _route_refs(spark, sf_dir):
    r = ref_vectors(spark, sf_dir)
    thr = F.when(F.col("route") == "r0", F.lit(FIX_ROUTE["r0"])).otherwise(F.lit(FIX_ROUTE["r1"]))
    return r.select("ref_id", "embedding", "route", thr.alias("max_distance"))


@register("semantic_route", sql=_HEAD + "," + _NN.format(k=1) + f"""
SELECT CAST(floor(query_id / 10) AS BIGINT) AS request_id,
       coalesce(list_sort(list_distinct(list(route) FILTER (WHERE distance <
         CASE WHEN route = 'r0' THEN {FIX_ROUTE['r0']} ELSE {FIX_ROUTE['r1']} END))), []) AS routes
FROM nn GROUP BY 1""")
def q_semantic_route(spark, sf_dir):
    clauses = _q(spark, sf_dir).withColumn("request_id", F.floor(F.col("query_id") / 10).cast("bigint"))
    return knn.route(clauses, _route_refs(spark, sf_dir), keep=("query_id", "request_id"))


@register("semantic_cache_lookup", sql=_HEAD + "," + _NN.format(k=1) + f"""
SELECT query_id, CASE WHEN distance < {FIX_CACHE} THEN answer ELSE '' END AS cached_answer FROM nn""")
def q_semantic_cache_lookup(spark, sf_dir):
    return knn.cache_lookup(_q(spark, sf_dir), ref_vectors(spark, sf_dir), FIX_CACHE)


@register("post_vector_search", sql=with_(REFS, QUERIES) + """,
d AS (SELECT r.ref_id AS search_id, q.query_id AS post_id,
             list_cosine_distance(CAST(r.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])) AS distance
      FROM refs r, queries q)
SELECT search_id, post_id, round(distance, 9) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY search_id ORDER BY distance, post_id) AS rank FROM d)
WHERE rank <= 5""")
def q_post_vector_search(spark, sf_dir):
    """V7: search vectors against a growing post store, by the blocked path."""
    searches = ref_vectors(spark, sf_dir).select(F.col("ref_id").alias("search_id"), "embedding")
    store = query_vectors(spark, sf_dir).select(F.col("query_id").alias("post_id"), "embedding")
    return knn.nearest(searches, store, 5, r_id="post_id", pack_max_bytes=0)


@register("vector_index")
def q_vector_index(spark, sf_dir):
    """V7 over a stored index of every vector: five nearest of each ``vec_id``
    divisible by 20, with the recall against exact search on 256 of them."""
    rows = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    queries = rows.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    path = scratch_path(spark, "cell-index")
    centres = cell_index.fit(rows)
    cell_index.build(rows, centres, path)
    cell_index.search(spark, path, centres, queries, 5).write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")
    recall = cell_index.measured_recall(found, queries, rows, 5)
    return found.crossJoin(F.broadcast(recall)).select("query_id", "ref_id", "distance", "rank", "recall", "checked")


@register("semantic_cache_fill", sql="WITH RECURSIVE " + fill_cte("embeddings", "vec_id", FIX_CACHE) + """
SELECT vec_id AS id, hit, source_id, distance, false AS from_cache, 'a' || CAST(source_id AS VARCHAR) AS answer FROM fill""")
def q_semantic_cache_fill(spark, sf_dir):
    """V6: all ``embeddings`` vectors as requests in ``vec_id`` order filling
    an initially empty cache (answer = ``'a' || source_id``)."""
    from postlake.operators.cache import semantic_cache_fill
    from postlake.sources.tables import read_table
    e = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    out = semantic_cache_fill(e, FIX_CACHE)
    return out.withColumn("answer", F.concat(F.lit("a"), F.col("source_id").cast("string")))
