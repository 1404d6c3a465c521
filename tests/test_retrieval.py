"""Contexts under a budget, and what the summary guard says about repeated runs of words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillset.functions.text import first_repeat, is_valid_summary
from quillset.operators.context import rag_context


def plain_context(hits, texts, budget):
    found = {}
    for query, _, doc in sorted(hits, key=lambda h: (str(h[0]), h[1], h[2])):
        parts, room, missing = found.setdefault(query, ([], [budget], [0]))
        words = (texts.get(doc) or "").split()
        taken = words[: max(room[0], 0)]
        room[0] -= len(words)
        missing[0] += len(words) - len(taken)
        if taken:
            parts.append(" ".join(taken))
    return {
        q: ("\n\n".join(parts), len(parts), sum(len(p.split()) for p in parts), missing[0] > 0)
        for q, (parts, _, missing) in found.items()
    }


@pytest.mark.parametrize("budget", [0, 1, 7, 30, 1000])
def test_contexts_against_a_plain_version(spark, budget):
    rng = random.Random(budget)
    texts = {i: rng.choice([" ", "\n", " \t"]).join(f"w{i}x{j}" for j in range(rng.randint(0, 12))) for i in range(20)}
    texts |= {20: None, 21: " \n "}
    hits = [(q, r, rng.randint(0, 25)) for q in ("a", "b", "c", "d") for r in range(1, rng.randint(2, 7))]
    hits += [("tie", 1, 5), ("tie", 1, 3), ("none", 1, 99), ("none", 2, 20)]
    got = rag_context(
        spark.createDataFrame([(*h, "x") for h in hits], "query_id string, rank int, id long, text string").repartition(3),
        spark.createDataFrame(list(texts.items()), "id long, text string"),
        budget,
    )
    assert {r.query_id: tuple(r)[1:] for r in got.collect()} == plain_context(hits, texts, budget)


def test_running_sums_and_lists_share_an_exchange(spark):
    hits = spark.range(100).select((F.col("id") % 7).alias("query_id"), F.col("id").alias("rank"), "id")
    texts = spark.range(100).select("id", F.lit("some words").alias("text"))
    plan = rag_context(hits, texts.hint("merge"))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(query_id", plan)) == 1


def plain_repeat(text, n):
    words, seen = re.findall(r"\w+", (text or "").lower()), set()
    for i in range(len(words) - n + 1):
        gram = tuple(words[i : i + n])
        if gram in seen:
            return i + 1
        seen.add(gram)
    return None


@pytest.mark.parametrize("n", [1, 3, 4])
def test_first_repeat_against_a_plain_version(spark, n):
    rng = random.Random(n)
    texts = [None, "", "a", "a b c", "A b, c. a B c", "a a a a", "x " * 5000, "aaa aa a aaaa aa aaa"]
    for _ in range(120):
        kinds = rng.choice([3, 30, 3000])
        texts.append(" ".join(rng.choice(["W", "w", "é"]) + str(rng.randrange(kinds)) for _ in range(rng.randint(0, 150))))
    long_ = [f"q{i}" for i in range(6000)]
    texts += [" ".join(long_), " ".join([*long_, *long_[40:60]]), " ".join([*long_[:70], *long_[10:20], *long_])]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: r.at for r in rows.select("i", first_repeat(F.col("text"), n).alias("at")).collect()}
    assert got == {i: plain_repeat(t, n) for i, t in enumerate(texts)}


def test_repeats_count_only_if_asked(spark):
    text = "the same three words and then the same three words again to the end"
    rows = spark.createDataFrame([(text,), ("each word of this summary is another one so nothing repeats",)], "s string")
    plain, strict = is_valid_summary(F.col("s")), is_valid_summary(F.col("s"), no_repeat=3)
    assert [tuple(r) for r in rows.select(plain, strict).collect()] == [(True, False), (True, True)]


def test_a_beginning_is_cut_off_once(spark):
    """Not once for each of its words, which takes the square of its length."""
    rows = spark.range(1).select(first_repeat(F.col("id").cast("string")).alias("at"))
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "slice(slice(" not in plan and "array_distinct" in plan
