"""All registered queries of this subpackage."""

from __future__ import annotations

from palimpsest.llm import (  # noqa: F401
    query_codes, query_decontaminate, query_html, query_lm, query_mixing, query_near, query_pieces,
    query_quality, query_sharding, query_toxicity, query_trie, query_urls, query_warc)
from palimpsest.llm.registry import ORACLE, QUERIES  # noqa: F401
