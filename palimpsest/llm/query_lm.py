"""op9: log probabilities of all documents, learned from those outside the held-out fold."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.llm import lm
from palimpsest.llm.common import in_fold, read
from palimpsest.llm.registry import query


@query("op9_lm_score")
def op9(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    learned = lm.learn(docs.filter(~in_fold(F.col("doc_id"), 7, 2)))
    return lm.scored(docs, learned).withColumn("held_out", in_fold(F.col("doc_id"), 7, 2))
