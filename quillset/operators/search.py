"""Search over a stored corpus: categories, free text, newest first."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillset.functions.text import WHITESPACE, WORD_CHARACTER, csv_items
from quillset.schemas import MAX_RESULTS

# What joins terms, also at the ends of a text, and what is refused.
OPERATOR_OR = re.compile(r"(?:^|(?<=\s))OR(?=\s|$)")
OPERATOR_AND = re.compile(r"(?:^|(?<=\s))AND(?=\s|$)")
UNREAD = re.compile(r"[\"()\[\]{}]")

# Neither space nor word: no term matches across the two fields.
FIELD_SEPARATOR = " | "


def _mentions(terms: list[str]) -> Column:
    """Any of the terms as whole words, in any case, in title or abstract: one pattern over both."""
    spelled = "|".join(f"{WHITESPACE}+".join(re.escape(word) for word in term.lower().split()) for term in terms)
    pattern = f"(?<!{WORD_CHARACTER})(?:{spelled})(?!{WORD_CHARACTER})"
    return F.lower(F.concat_ws(FIELD_SEPARATOR, "title", "abstract")).rlike(pattern)


def parse_terms(free_text: str) -> list[list[str]]:
    """``a AND b OR c`` as [[a, b], [c]]. Grouping and quotes are not read, and every operator needs a term on each side."""
    if found := UNREAD.search(free_text):
        raise ValueError(f"{found[0]} is not read in a search: terms are joined by OR and AND, without groups or quotes")
    alternatives = [
        [term.strip() for term in OPERATOR_AND.split(alternative)] for alternative in OPERATOR_OR.split(free_text)
    ]
    if not all(term and term not in ("OR", "AND") for terms in alternatives for term in terms):
        raise ValueError(f"a term is missing beside OR or AND: {free_text.strip()}")
    return alternatives


def search_predicate(categories_csv: str = "", free_text: str = "") -> Column:
    """Any of the categories AND the free text, a list of terms joined by ``OR`` and ``AND``."""
    categories = csv_items(categories_csv)
    if not categories and not free_text.strip():
        raise ValueError("empty query: give categories, free text or both")
    keep = F.lit(True)
    if categories:
        keep = keep & F.arrays_overlap("categories", F.array(*[F.lit(c) for c in categories]))
    if free_text.strip():
        alternatives = parse_terms(free_text)
        single = [terms[0] for terms in alternatives if len(terms) == 1]
        any_of = _mentions(single) if single else F.lit(False)
        for terms in alternatives:
            if len(terms) > 1:
                any_of = any_of | reduce(and_, [_mentions([term]) for term in terms])
        keep = keep & any_of
    return keep


def search_papers(
    papers: DataFrame, categories_csv: str = "", free_text: str = "", max_results: int = MAX_RESULTS
) -> DataFrame:
    """The newest matching papers; ties by id. The limit is merged from per-task top lists."""
    matching = papers.where(search_predicate(categories_csv, free_text))
    return matching.orderBy(F.col("published").desc_nulls_last(), F.col("arxiv_id")).limit(max_results)
