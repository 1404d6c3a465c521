"""What the plans must look like to hold at scale."""

import contextlib
import io
import re

import pytest

from quillset.catalog import tables
from quillset.catalog.queries import QUERIES
from quillset.operators.papers import prepare_papers
from quillset.operators.rouge import rouge_scores
from quillset.operators.search import search_papers
from quillset.operators.stats import prep_stats

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def count(pattern, text):
    return len(re.findall(pattern, text, re.M))


@pytest.fixture()
def raw(spark, monkeypatch):
    monkeypatch.setattr(tables, "spread", lambda df: df)
    return tables.raw_papers(spark, SF)


def test_preparation_shuffles_once_after_a_partial_limit(raw):
    text = plan(prepare_papers(raw))
    assert count(r"^Arguments: hashpartitioning", text) == count(r"\) Exchange", text) == 1
    assert count(r", 1, Partial$", text) == count(r", 1, Final$", text) == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in text
    # The cleaning chain runs once per row.
    assert text.count("cite") == 1


def test_unused_columns_are_not_read(spark, raw):
    text = plan(prepare_papers(raw).select("id", "abs_words"))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_stats_shuffle_only_titles_and_counters(raw):
    text = plan(prep_stats(raw))
    assert re.search(r"\) Exchange\nInput \[4\]: \[title#\d+, count#\d+L, count#\d+L, count#\d+L\]", text)


def test_search_is_a_distributed_top_list(raw):
    assert "TakeOrderedAndProject" in plan(search_papers(raw, "en", "the"))


def test_rouge_on_stored_pairs_shuffles_once(spark):
    pairs = tables.table(spark, SF, "documents").selectExpr("doc_id as id", "text as prediction", "source as reference")
    text = plan(rouge_scores(pairs, ("rouge1", "rouge2")))
    assert count(r"\) Exchange", text) == 1
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_python_metrics_never_shuffle_ngrams(spark):
    pairs = tables.table(spark, SF, "documents").selectExpr("doc_id as id", "text as prediction", "source as reference")
    text = plan(rouge_scores(pairs))
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert len(exchanges) == 2 and not any("gram" in columns for columns in exchanges)
    assert count(r"\) Exchange", plan(rouge_scores(pairs, ("rougeL",)))) == 1


PYTHON = {"label_with_model", "truncate_custom_tokens", "rougeL", "rougeLsum", "rouge_corpus_stem"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_crosses_tables_or_leaves_the_jvm_needlessly(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text
    assert ("EvalPython" in text) == (name in PYTHON)
