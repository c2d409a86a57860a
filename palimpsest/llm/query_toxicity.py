"""op2: toxicity of all documents, learned from two thirds of the labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.llm import toxicity
from palimpsest.llm.common import in_fold, read
from palimpsest.llm.registry import query


@query("op2_toxicity")
def op2(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(~in_fold(F.col("doc_id"), 3, 1))
    model = toxicity.fit(docs, labels.select("doc_id", "toxic"))
    return toxicity.scored(docs, model).select(
        "doc_id", in_fold(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted",
        "n_toxic_words", "spans")
