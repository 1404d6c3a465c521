"""Contexts for retrieval: ranked texts joined under a budget of words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillset.functions.text import NON_WHITESPACE

CONTEXT_WORDS = 400
SEPARATOR = "\n\n"


def rag_context(
    hits: DataFrame,
    texts: DataFrame,
    budget: int = CONTEXT_WORDS,
    query_col: str = "query_id",
    id_col: str = "id",
    text_col: str = "text",
    rank_col: str = "rank",
    separator: str = SEPARATOR,
) -> DataFrame:
    """(query, context, n_texts, n_words, truncated): the texts of each query's hits in order of rank, one row per query.

    Words are runs of anything but space, joined by one blank. The text that crosses the budget is cut at a word and later
    ones are left out; ``truncated`` says that words are missing. Hits without text, or with a blank one, add nothing;
    a query with no other hits has an empty context. Equal ranks are ordered by id. ``texts`` has one row per id. The
    running sums and the lists share one exchange by query, and a query has as many rows as hits.
    """
    words = F.regexp_extract_all(text_col, F.lit(NON_WHITESPACE + "+"), F.lit(0))
    joined = hits.select(query_col, id_col, rank_col).join(texts.select(id_col, text_col), id_col, "left")
    ranked = joined.select(query_col, id_col, rank_col, F.coalesce(words, F.array()).alias("words"))
    ahead = Window.partitionBy(query_col).orderBy(rank_col, id_col).rowsBetween(Window.unboundedPreceding, -1)
    room = F.greatest(F.lit(budget) - F.coalesce(F.sum(F.size("words")).over(ahead), F.lit(0)), F.lit(0)).cast("int")
    cut = ranked.withColumn("room", room).select(
        query_col,
        rank_col,
        id_col,
        F.size("words").alias("held"),
        F.slice("words", F.lit(1), F.col("room")).alias("taken"),
    )
    part = F.struct(rank_col, id_col, F.size("taken").alias("n"), F.array_join("taken", " ").alias("text"))
    parts = F.filter(F.sort_array(F.collect_list(part)), lambda p: p.n > 0)
    lists = cut.groupBy(query_col).agg(parts.alias("parts"), F.sum("held").alias("held"))
    n_words = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p.n)
    return lists.select(
        query_col,
        F.array_join(F.transform("parts", lambda p: p.text), separator).alias("context"),
        F.size("parts").alias("n_texts"),
        n_words.alias("n_words"),
        (n_words < F.col("held")).alias("truncated"),
    )
