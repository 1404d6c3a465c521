"""Decontamination against a search for every window in every text."""

import hashlib
import random
import re

import pytest

from quillset.llm import decontaminate
from quillset.llm.queries import op4_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(text, items, window):
    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        parts = words(item)
        size = min(window, len(parts))
        windows = {tuple(parts[i : i + size]) for i in range(len(parts) - size + 1)} if size else set()
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(item_id)
    return len(own), len(hit), sorted(x for x in found if x is not None)


def cases(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "c", "d", "é", "3"]
    items = [(str(i), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9)))) for i in range(25)]
    items += [(None, "a b c d"), ("x", None), ("", "c c"), ("3", "b b b b b"), ("3", "d a d")]
    texts = [" ".join(rng.choice([*vocabulary, "z"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    return items, [*texts, None, "", "A-B, C!d", "z" * 5000]


@pytest.mark.parametrize("window", [1, 3, 5])
def test_automaton_equals_search(window):
    for seed in range(20):
        items, texts = cases(seed)
        automaton = decontaminate.Automaton.of(items, window)
        for text in texts:
            n, spans, ids, _ = automaton.scan(text)
            got = n, sum(b - a for a, b in spans), sorted(x for x in ids if x is not None)
            assert got == brute(text, items, window), (seed, text)


@pytest.mark.parametrize("shard", [1_000_000, 30])
def test_operator(spark, monkeypatch, shard):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    items, texts = cases(3)
    docs = spark.createDataFrame([(i, t, "h") for i, t in enumerate(texts)], "doc_id long, text string, hits string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: r.hits for r in decontaminate.find_contamination(docs, bench, window=4).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == brute(t, items, 4)
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.find_contamination(docs, none).filter("hits.n_hit > 0").count() == 0
    assert decontaminate.find_contamination(docs.limit(0), bench).count() == 0


def test_clean_cuts_and_drops(spark):
    item = "one two three four five six seven eight nine ten eleven"
    texts = [f"Before, it. {item.upper()}! After that come enough other words to keep this text and all", item, None, "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.clean(docs, bench).collect()}
    assert got == {0: "Before, it. ! After that come enough other words to keep this text and all", 2: None, 3: "x"}


def test_query_on_whole_table(spark, sf_dir):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in op4_decontaminate(spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        n, hit, ids = brute(r.text, items, 10)
        own = got[r.doc_id]
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert (own.n_words, own.n_hit, own.n_items, own.items_sha256) == (n, hit, len(ids), digest)
        assert own.contaminated == (hit > 0)
