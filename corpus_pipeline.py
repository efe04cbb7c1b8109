"""Corpus pipeline: five stages over ``documents``, each written and reread.

Quality rules, line dedup, MinHash near-dedup, benchmark decontamination and
BPE encoding.  A stage takes (spark, docs, sf_dir) and returns a DataFrame; all
but the last return the columns they were given.  Part of ``postlake.llm``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.llm import bpe, decontaminate, line_dedup, neardup, quality_rules
from postlake.llm.common import table, written
from postlake.llm.queries import tokenizer_path


def keep_good(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def cut_lines(spark, docs, sf_dir):
    """Lines that many documents share go, but for the largest doc_id's."""
    return line_dedup.dedup_lines(docs)


def keep_one_of_each(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return neardup.drop_near_duplicates(docs)


def keep_clean(spark, docs, sf_dir):
    """Documents with a benchmark item's passage go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark, docs, sf_dir):
    """doc_id, n_tokens, ids and the digests of ids and decoded text."""
    coded = bpe.encode_documents(docs, tokenizer_path())
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality_rules", keep_good), ("line_dedup", cut_lines), ("near_dedup", keep_one_of_each),
          ("decontaminate", keep_clean), ("bpe", encode)]


def run(spark, sf_dir):
    """All stages over ``documents``; every stage but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the line rules, template slots and merges.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
