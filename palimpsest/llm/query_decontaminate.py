"""op1: documents that hold passages of the benchmark."""

from __future__ import annotations

from palimpsest.llm.common import read
from palimpsest.llm.decontaminate import contamination
from palimpsest.llm.registry import query


@query("op1_decontamination")
def op1(spark, sf_dir):
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
