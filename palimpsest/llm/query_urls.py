"""op5: every page's URL by rules and a lexical classifier.

The labels of a URL are those of the document whose id ends its path: blocked if
that document is of bad quality or toxic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from palimpsest.llm.common import read
from palimpsest.llm.registry import query
from palimpsest.llm.urls import judged_urls

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/")]


@query("op5_url_filter")
def op5(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    number = F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[^?#]*?([0-9]+)[^0-9/?#]*/?(?:[?#]|$)', 1) as bigint)")
    labels = read(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("label"))
    labelled = pages.withColumn("doc_id", number).join(labels, "doc_id").select("url", "label")
    return judged_urls(pages, labelled, RULES)
