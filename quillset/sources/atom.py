"""Atom feeds of a paper search service."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillset.functions.text import last_url_segment, one_line
from quillset.schemas import ATOM_ENTRY

# The element that holds one paper and the title of its document link.
ENTRY_TAG = "entry"
PDF_LINK_TITLE = "pdf"


def read_atom(spark: SparkSession, path: str) -> DataFrame:
    """One raw paper per feed entry."""
    entries = spark.read.format("xml").option("rowTag", ENTRY_TAG).option("mode", "FAILFAST").schema(ATOM_ENTRY)
    pdf_links = F.filter("link", lambda link: link["_title"] == PDF_LINK_TITLE)
    return entries.load(path).select(
        last_url_segment(F.col("id")).alias("arxiv_id"),
        one_line(F.col("title")).alias("title"),
        one_line(F.col("summary")).alias("abstract"),
        F.transform("author", lambda a: a["name"]).alias("authors"),
        F.transform("category", lambda c: c["_term"]).alias("categories"),
        F.col("published"),
        F.get(pdf_links, F.lit(0))["_href"].alias("pdf_url"),
    )
