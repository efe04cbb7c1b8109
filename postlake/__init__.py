"""postlake: social-post stream analytics expressed as Spark DataFrame plans.

Layout
------
sources/    readers and derived views (posts, event topics, vector sides, raw events)
functions/  Column -> Column helpers (text, vectors, hashing); no actions
operators/  DataFrame -> DataFrame operators (filters, knn, top-k, sketches, dedup, bot)
streaming/  Structured Streaming builders (file sources, foreachBatch sinks)
plans/      the registered query catalogue used by ``__spark_entry__`` and ``bench.py``
"""

__version__ = "0.1.0"
