"""Ranked search: the exact ranking of a plain scorer, whatever the blocks, cells and shards."""

import collections
import math
import random
import re

import duckdb
import numpy as np
import pytest

from quillset.llm import lexical_search
from quillset.llm.queries import ORACLES, op11_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=50):
    counted = [(d, collections.Counter(terms(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    total = sum(c.total() for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for t, x in df.items()}
    found = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counted:
            m = 100 - 50 + (50 * c.total() * n_docs) // max(total, 1)
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for i, (score, null, doc_id) in enumerate(sorted(scores)[:k], 1):
            found.append((item_id, i, None if null else doc_id, -score))
    return sorted(found, key=repr)


def ranked(spark, docs, items, k=50):
    left = spark.createDataFrame([(t, d, 1, 2) for d, t in docs], "text string, doc_id int, n int, row int").repartition(3)
    right = spark.createDataFrame([(t, i, 1) for i, t in items], "text string, item_id string, item int")
    return sorted(map(tuple, lexical_search.rank(left, right, k=k).collect()), key=repr)


def made(seed, n_docs, n_items):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé7", k=rng.randint(1, 6))) for _ in range(250)]
    groups = [rng.sample(words, 40) for _ in range(6)]

    def text(n):
        return " ".join(rng.choice([w, w.upper(), w + ",", w + "-x"]) for w in rng.choices(rng.choice(groups), k=n))

    docs = [(i, text(rng.choice([0, 1, 5, 30, 200]))) for i in range(n_docs)]
    docs += [(n_docs, docs[5][1]), (3, docs[7][1]), (None, docs[9][1]), (None, None), (n_docs + 1, ""), (n_docs + 2, "... \n")]
    docs += [(5000 + i, "same text of many copies " + words[3]) for i in range(120)]
    items = [(str(i), text(rng.randint(1, 25))) for i in range(n_items)]
    items += [("1", items[0][1]), (None, "same words of copies"), ("none", "zzzzzz"), ("empty", ""), ("null", None)]
    return docs, items


@pytest.mark.parametrize(("block", "postings", "shard"), [(2, 200, 1 << 16), (8, 4000, 60), (64, 1 << 18, 1 << 16)])
def test_equals_plain_scores(spark, monkeypatch, block, postings, shard):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    monkeypatch.setattr(lexical_search, "CELL_POSTINGS", postings)
    monkeypatch.setattr(lexical_search, "SHARD_TERMS", shard)
    monkeypatch.setattr(lexical_search, "ENTRIES_AT_ONCE", 500)
    docs, items = made(block, 300, 12)
    assert ranked(spark, docs, items) == brute(docs, items)
    assert ranked(spark, docs, items, k=3) == brute(docs, items, 3)


def test_query_and_sql_on_whole_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = sorted(map(tuple, op11_lexical_search(spark, sf_dir).collect()), key=repr)
    assert got == brute(docs, items)
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    assert sorted(db.execute(ORACLES["op11_lexical_search"]).fetchall(), key=repr) == got


def test_empty_tables(spark):
    docs, items = made(1, 12, 3)
    assert ranked(spark, [], items) == []
    assert ranked(spark, docs, []) == []
    assert ranked(spark, [(1, None), (2, "")], items) == []


def cell(seed, n=400):
    rng = np.random.default_rng(seed)
    topics = [rng.choice(120, 25, replace=False) for _ in range(5)]
    found = [np.unique(rng.choice(topics[i % 5], rng.integers(1, 15))) for i in range(n)]
    counts = [rng.integers(1, 4, len(t)) for t in found]
    by = lexical_search.Weights(rng.integers(1, 9000, 120), n, 10 * n)
    asked = lexical_search.Asked.of([sorted(rng.choice(120, 6, replace=False).tolist()) for _ in range(30)], 120)
    raw = [[x.astype("<i4").tobytes() for x in xs] for xs in (found, counts)]
    n_terms = np.array([c.sum() for c in counts])
    made = lexical_search.Cell.build(list(range(n)), list(range(n)), *raw, n_terms, by, asked.partners)
    impacts = np.zeros((n, 120), np.int64)
    for i, (t, c) in enumerate(zip(found, counts)):
        impacts[i, t] = by.impacts(t, c, np.full(len(t), n_terms[i]))
    return lexical_search.Cell.from_row(*made.to_row()), asked, by, impacts


def test_bounds_hold_and_blocks_are_skipped(monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK", 8)
    monkeypatch.setattr(lexical_search, "ENTRIES_AT_ONCE", 300)
    c, asked, by, impacts = cell(2)
    widths = [len(asked.partners[t]) for t in c.own]
    starts = np.cumsum([0, *[w * n for w, n in zip(widths, np.diff(c.lists))]])
    skipped = total = 0
    for item, terms_ in enumerate(asked.items):
        scores = impacts[:, terms_].sum(1)
        least = max(1, int(np.sort(scores)[-20]))
        for t in np.flatnonzero(np.isin(c.own, terms_)).tolist():
            summary = c.summary[starts[t] : starts[t + 1]].reshape(-1, widths[t])
            bounds = summary[:, np.isin(asked.partners[c.own[t]], terms_)].sum(1, dtype=int) * c.unit
            for b, bound in zip(range(c.lists[t], c.lists[t + 1]), bounds, strict=True):
                members = c.members[c.blocks[b] : c.blocks[b + 1]]
                assert 1 <= len(members) <= 8
                assert bound >= scores[members].max()
                skipped, total = skipped + (bound < least), total + 1
        limits = np.full(len(asked.items), 1 << 60)
        limits[item] = least
        (number, documents, found), *rest = lexical_search.searched(c, asked, by, limits, 400, False)
        assert number == item and not rest
        assert sorted(documents) == np.flatnonzero(scores >= least).tolist()
        assert found.tolist() == sorted(scores[scores >= least].tolist(), reverse=True)
    assert skipped > 0.2 * total


def test_each_list_is_in_blocks_once():
    c, _, _, impacts = cell(3)
    for t in range(len(c.own)):
        members = c.members[c.blocks[c.lists[t]] : c.blocks[c.lists[t + 1]]]
        assert sorted(members) == np.flatnonzero(impacts[:, c.own[t]]).tolist()
