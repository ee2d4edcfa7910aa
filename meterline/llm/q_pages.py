"""Queries over the pages table."""

from __future__ import annotations

from meterline.llm import site_tree
from meterline.llm.queries import query
from meterline.llm.storage import table


@query("op10_html_extraction")
def op10(spark, folder):
    return site_tree.extract(table(spark, folder, "pages"))
