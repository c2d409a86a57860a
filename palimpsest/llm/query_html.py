"""op10: the visible text of every page."""

from __future__ import annotations

from palimpsest.llm.common import read
from palimpsest.llm.html_text import extract_text
from palimpsest.llm.registry import query


@query("op10_html_text")
def op10(spark, sf_dir):
    return extract_text(read(spark, sf_dir, "pages").select("page_id", "html"))
