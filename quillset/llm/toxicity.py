"""Toxicity by a factorization machine over hashed terms.

The score of a text is the logistic of ``bias + sum(w) + sum over pairs(v_i . v_j)`` over its distinct terms: words and
the beginnings of long words, hashed. The pair part learns what an additive model misses, such as an insult together
with the mention of a group. Learned on a bounded sample of labelled rows; scoring reads whole texts and shuffles nothing.

Null and empty texts have no term and score by the bias. Rows with repeated or null ids are scored each for itself.
Without any labelled row of both kinds the model is constant: the share of toxic labels, or 0 without labels.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns, bounded_sample, held_out
from quillset.session import stage

#: Labelled rows of each kind that the model is fitted on, at most.
SAMPLE_ROWS = 8000
#: Scores from here on count as toxic.
THRESHOLD = 0.5
HASH_BITS = 22
FACTORS = 6
PREFIXES = (4, 5)
#: A term takes part if this many sampled texts hold it and its G statistic or its frequency speaks for it.
LEAST_TEXTS = 3
LEAST_G = 12.0
FREQUENT_TERMS = 512
MOST_TERMS = 20_000
CACHED_WORDS = 100_000

find_words = re.compile(r"\w+").findall


def word_terms(word: str) -> list[int]:
    """The hashed terms of one word: itself, and how it begins."""
    terms = [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) > n]
    return [zlib.crc32(t.encode("utf-8", "replace")) & ((1 << HASH_BITS) - 1) for t in terms]


def text_terms(text: str | None) -> list[int]:
    found: set[int] = set()
    for word in set(find_words((text or "").lower())):
        found.update(word_terms(word))
    return sorted(found)


@dataclass(frozen=True)
class FactorizationMachine:
    """Hashed terms with their weights and factors; terms that are absent weigh nothing."""

    bias: float
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def scorer(self) -> Callable[[list[str | None]], np.ndarray]:
        """Scores for batches of texts; words that were met before are not hashed again."""
        index = {int(t): i for i, t in enumerate(self.terms)}
        known: dict[str, tuple[int, ...]] = {}

        def scores(texts: list[str | None]) -> np.ndarray:
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                found: set[int] = set()
                for word in set(find_words((text or "").lower())):
                    rows = known.get(word)
                    if rows is None:
                        if len(known) >= CACHED_WORDS:
                            known.clear()
                        rows = known[word] = tuple(index[t] for t in word_terms(word) if t in index)
                    if rows:
                        found.update(rows)
                out[i] = self.margin(sorted(found))
            return 1 / (1 + np.exp(-np.clip(out, -35, 35)))

        return scores

    def margin(self, rows: list[int]) -> float:
        v = self.factors[rows]
        total = v.sum(0)
        return float(self.bias + self.weights[rows].sum() + 0.5 * (total @ total - (v * v).sum()))


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label="toxic", rows=SAMPLE_ROWS):
    """A machine learned from ``labels`` (id, 0 or 1), never from rows of the held-out fold.

    An id with several labels has the largest. The sample of ids is bounded by ``rows`` of each kind, so it is
    broadcast, and the texts are not shuffled to find their labels. The executors hash the texts and count the terms;
    the driver gets at most ``MOST_TERMS`` terms and which of them the sampled texts hold.
    """
    from quillset.llm.toxicity import text_terms

    known = labels.filter(F.col(label).isin(0, 1) & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max(F.col(label).cast("int")).alias("label"))
    sample, shares = bounded_sample(known, id_col, "label", rows)
    toxic, clean = shares.get(1, 0), shares.get(0, 0)
    if not toxic or not clean:
        return constant(toxic, clean)

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"terms": [text_terms(t) for t in frame["text"]], "label": frame["label"]})

    texts = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(sample), id_col)
    found = texts.select("text", "label").mapInPandas(hashed, "terms array<int>, label int")
    held = stage(found.limit(4 * rows), "toxicity-sample")
    terms = informative_terms(held)
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def narrowed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["terms"] = [np.flatnonzero(np.isin(shared.value, t)).astype(np.int32) for t in frame["terms"]]
            yield frame

    got = held.mapInPandas(narrowed, "terms array<int>, label int").toArrow()
    lists = [np.asarray(x, dtype=np.int64) for x in got.column("terms").to_pylist()]
    return learn(lists, np.asarray(got.column("label").to_pylist(), float), terms, toxic, clean)


def informative_terms(held: DataFrame) -> np.ndarray:
    """The hashed terms that take part, sorted: those that go with the label, and the most frequent ones."""
    sums = held.agg(F.sum("label"), F.count(F.lit(1))).first()
    n1, n = float(sums[0] or 0), float(sums[1])
    counts = held.select("label", F.explode("terms").alias("term")).groupBy("term")
    counts = counts.agg(F.sum("label").cast("double").alias("pos"), F.count(F.lit(1)).cast("double").alias("seen"))

    def part(found: Column, share: float) -> Column:
        return F.when(found > 0, found * F.log(found / (F.col("seen") * share))).otherwise(0.0)

    share = min(max(n1 / max(n, 1), 1e-9), 1 - 1e-9)
    g = 2 * (part(F.col("pos"), share) + part(F.col("seen") - F.col("pos"), 1 - share))
    counts = counts.filter(F.col("seen") >= LEAST_TEXTS).withColumn("g", g)
    telling = counts.filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "term").limit(MOST_TERMS)
    often = counts.orderBy(F.desc("seen"), "term").limit(FREQUENT_TERMS)
    return np.array(sorted({r[0] for r in telling.select("term").union(often.select("term")).collect()}), dtype=np.int64)


def constant(toxic: int, clean: int) -> FactorizationMachine:
    share = min(max(toxic / max(1, toxic + clean), 1e-6), 1 - 1e-6)
    none = np.zeros(0)
    return FactorizationMachine(float(np.log(share / (1 - share))), none.astype(int), none, np.zeros((0, FACTORS)))


def learn(
    rows: list[np.ndarray], y: np.ndarray, terms: np.ndarray, toxic: int, clean: int, epochs=14, seed=7
) -> FactorizationMachine:
    """Fit by AdaGrad with an L1 step. ``rows`` number the ``terms``; the label counts correct the bias of the sample."""
    n1, n0 = float(y.sum()), float(len(y) - y.sum())
    if not n1 or not n0:
        return constant(toxic, clean)
    order = np.random.default_rng(seed).permutation(len(y))
    rows, y = [rows[i] for i in order], y[order]
    rng = np.random.default_rng(seed)
    w, v, bias = np.zeros(len(terms)), rng.normal(0, 0.01, (len(terms), FACTORS)), 0.0
    gw, gv, gb = np.full(len(terms), 1.0), np.full(v.shape, 1.0), 1.0
    step, l1 = 0.5, 2e-4
    for _ in range(epochs):
        for at in range(0, len(rows), 128):
            part, target = rows[at : at + 128], y[at : at + 128]
            idx = np.concatenate(part)
            own = np.repeat(np.arange(len(part)), [len(r) for r in part])
            vs = v[idx]
            total = np.zeros((len(part), FACTORS))
            np.add.at(total, own, vs)
            square = np.bincount(own, (vs * vs).sum(1), minlength=len(part))
            z = bias + np.bincount(own, w[idx], minlength=len(part)) + 0.5 * ((total * total).sum(1) - square)
            err = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - target) / len(part)
            touched, back = np.unique(idx, return_inverse=True)
            dw = np.bincount(back, err[own], minlength=len(touched))
            dv = np.zeros((len(touched), FACTORS))
            np.add.at(dv, back, err[own, None] * (total[own] - vs))
            dv += 1e-4 * v[touched]
            gw[touched] += (dw * len(part)) ** 2
            gv[touched] += (dv * len(part)) ** 2
            rate = step * len(part) / np.sqrt(gw[touched])
            moved = w[touched] - rate * dw
            w[touched] = np.sign(moved) * np.maximum(np.abs(moved) - rate * l1, 0)
            v[touched] -= 0.1 * len(part) * dv / np.sqrt(gv[touched])
            gb += err.sum() ** 2
            bias -= step * err.sum() / np.sqrt(gb)
    prior = np.log(max(toxic, 1) / max(clean, 1)) - np.log(n1 / n0)
    return FactorizationMachine(float(bias + prior), terms, w, v)


def score(docs: DataFrame, model: FactorizationMachine, text_col="text", out="score") -> DataFrame:
    """All columns of ``docs`` and the score of every whole text, in column ``out`` (replaced if it is there)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_columns(docs, lambda: shared.value.scorer(), text_col, [T.StructField(out, T.DoubleType())])
