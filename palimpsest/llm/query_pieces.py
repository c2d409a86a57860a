"""op13: ids and decoded texts of all documents under a public vocabulary."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from palimpsest.llm import pieces
from palimpsest.llm.common import read
from palimpsest.llm.registry import query


@query("op13_sentencepiece")
def op13(spark, sf_dir):
    rows = pieces.encoded(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")
