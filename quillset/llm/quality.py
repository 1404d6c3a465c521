"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text has one latent score ``s``, the product of shared weights with its hashed terms, and the chance of a grade of at
least ``k`` is the logistic of ``s - threshold[k]``; the thresholds are kept in order. That gives the expected grade and
the tail probability by which texts are selected. Terms are words and the shapes of tokens (``A!!``, ``a***``, ``|``,
a token equal to the one before), each with the logarithm of its count, and each of the two parts has length one.

Learned on a bounded sample of labelled rows; scoring reads whole texts and shuffles nothing. Null and empty texts have
no terms and the score 0. Without labels of two grades every text gets the grade that there is, or 0.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.llm.common import add_columns, bounded_sample, held_out

#: Labelled rows of each grade that the model is fitted on, at most about.
SAMPLE_ROWS = 3000
WORD_BITS = 16
SHAPE_BITS = 10
SIZE = (1 << WORD_BITS) + (1 << SHAPE_BITS)
#: Texts with at least this chance of the wanted grade are selected.
LEAST_TAIL = 0.5
CACHED_TOKENS = 100_000

SHAPES = ((re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"\d+"), "0"))


def shape_of(token: str) -> str:
    """Letters as a or A, digits as 0, up to three of any other character."""
    letters = "A" if token.isupper() else "a"
    for pattern, sign in SHAPES:
        token = pattern.sub(letters if sign == "a" else sign, token)
    return token[:4]


def hashed(term: str, bits: int) -> int:
    return zlib.crc32(term.encode("utf-8", "replace")) & ((1 << bits) - 1)


def featurizer() -> Callable[[str | None], tuple[np.ndarray, np.ndarray]]:
    """A function from a text to the numbers and values of its terms."""
    known: dict[str, tuple[int, int]] = {}
    again = (1 << WORD_BITS) + hashed("same as before", SHAPE_BITS)

    def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
        tokens = (text or "").split()
        counts: dict[int, int] = {}
        for token, n in Counter(tokens).items():
            ids = known.get(token)
            if ids is None:
                if len(known) >= CACHED_TOKENS:
                    known.clear()
                word = hashed(token.lower().strip(".,;:!?"), WORD_BITS)
                ids = known[token] = word, (1 << WORD_BITS) + hashed(shape_of(token), SHAPE_BITS)
            for i in ids:
                counts[i] = counts.get(i, 0) + n
        repeats = sum(map(str.__eq__, tokens, tokens[1:]))
        if repeats:
            counts[again] = counts.get(again, 0) + repeats
        numbers = np.fromiter(counts, np.int64, len(counts))
        values = np.log1p(np.fromiter(counts.values(), float, len(counts)))
        for part in (numbers < 1 << WORD_BITS, numbers >= 1 << WORD_BITS):
            values[part] /= np.sqrt((values[part] ** 2).sum()) or 1.0
        return numbers, values

    return terms


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass(frozen=True)
class OrdinalModel:
    """``thresholds[k - 1]`` is the one for a grade of at least ``k``."""

    weights: np.ndarray
    thresholds: np.ndarray
    lowest: int = 0

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """The chances of a grade of at least 1, 2, ... above the lowest: one row per score."""
        return logistic(scores[:, None] - self.thresholds[None, :])

    def scorer(self) -> Callable[[list[str | None]], np.ndarray]:
        terms = featurizer()

        def scores(texts: list[str | None]) -> np.ndarray:
            out = np.empty(len(texts))
            for i, text in enumerate(texts):
                numbers, values = terms(text)
                out[i] = self.weights[numbers] @ values
            return out

        return scores


def learn(starts: np.ndarray, numbers: np.ndarray, values: np.ndarray, y: np.ndarray, epochs=12, seed=3) -> OrdinalModel:
    """Fit by AdaGrad. Row ``i`` has the terms ``starts[i]`` to ``starts[i + 1]``; grades ``y`` count from 0."""
    grades = int(y.max(initial=0)) + 1
    weights, squares = np.zeros(SIZE), np.full(SIZE, 0.1)
    share = np.array([(y >= k).mean() for k in range(1, grades)])
    first = -np.log(share / (1 - share))[:1] if grades > 1 else np.zeros(0)
    gaps = np.zeros(max(0, grades - 2))
    free = np.concatenate((first, gaps))
    free_squares = np.full(len(free), 1.0)
    rng = np.random.default_rng(seed)
    for _ in range(epochs if grades > 1 else 0):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 64):
            rows = order[at : at + 64]
            sizes = starts[rows + 1] - starts[rows]
            own = np.repeat(np.arange(len(rows)), sizes)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[rows], sizes)
            idx, val = numbers[place], values[place]
            s = np.bincount(own, weights[idx] * val, minlength=len(rows))
            limits = np.concatenate(([-np.inf], free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:])))), [np.inf]))
            a, b = logistic(s - limits[y[rows]]), logistic(s - limits[y[rows] + 1])
            chance = np.maximum(a - b, 1e-12)
            slope = -(1 - a - b)
            touched, back = np.unique(idx, return_inverse=True)
            grad = np.bincount(back, slope[own] * val, minlength=len(touched)) + 1e-3 * weights[touched]
            squares[touched] += grad**2
            weights[touched] -= 0.3 * grad / np.sqrt(squares[touched])
            by_limit = np.bincount(y[rows], a * (1 - a) / chance, minlength=grades + 1)
            by_limit -= np.bincount(y[rows] + 1, b * (1 - b) / chance, minlength=grades + 1)
            inner = by_limit[1:grades]
            later = np.cumsum(inner[::-1])[::-1]
            grad = np.concatenate((later[:1], later[1:] * np.exp(free[1:])))
            free_squares += grad**2
            free = free - 0.3 * grad / np.sqrt(free_squares)
    thresholds = free[:1] if grades < 3 else free[0] + np.concatenate(([0], np.cumsum(np.exp(free[1:]))))
    return OrdinalModel(weights, thresholds)


def fit(docs: DataFrame, ratings: DataFrame, id_col="doc_id", text_col="text", grade_col="grade", rows=SAMPLE_ROWS):
    """A model of the grades in ``ratings`` (id, grade as whole numbers), never of rows of the held-out fold.

    An id with several grades has the least. The sample of ids is bounded and broadcast; the executors make the terms.
    """
    known = ratings.filter(F.col(grade_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.min(F.col(grade_col).cast("int")).alias("grade"))
    sample, counts = bounded_sample(known, id_col, "grade", rows)
    if len(counts) < 2:
        return OrdinalModel(np.zeros(SIZE), np.zeros(0), min(counts, default=0))
    texts = docs.select(id_col, F.col(text_col).alias("text")).join(F.broadcast(sample), id_col)
    texts = texts.select("text", "grade")

    def load():
        terms = featurizer()

        def made(rows: list) -> tuple[list, list]:
            found = [terms(t) for t in rows]
            return [x[0] for x in found], [x[1] for x in found]

        return made

    lists = [("terms", T.ArrayType(T.IntegerType())), ("values", T.ArrayType(T.FloatType()))]
    held = texts.withColumn("terms", F.col("text")).drop("text")
    got = add_columns(held, load, "terms", [T.StructField(*x) for x in lists])
    got = got.limit(4 * rows * len(counts)).toArrow().combine_chunks()
    terms, values = (got.column(c).combine_chunks() for c in ("terms", "values"))
    starts = np.concatenate(([0], np.cumsum(terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
    grade = got.column("grade").to_numpy()
    levels = np.array(sorted(counts))
    model = learn(
        starts.astype(np.int64),
        terms.flatten().to_numpy(),
        values.flatten().to_numpy().astype(float),
        np.searchsorted(levels, grade),
    )
    return OrdinalModel(model.weights, model.thresholds, int(levels[0]))


def rate(docs: DataFrame, model: OrdinalModel, text_col="text", wanted: int = 1) -> DataFrame:
    """All columns of ``docs``, ``expected_grade`` and ``tail_probability``, the chance of a grade of at least ``wanted``.

    Grades are taken to be the whole numbers from the lowest on. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def load():
        model = shared.value
        scores = model.scorer()

        def rated(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
            tails = model.tails(scores([r["text"] for r in rows]))
            k = wanted - model.lowest
            tail = np.ones(len(rows)) if k <= 0 else tails[:, k - 1] if k <= tails.shape[1] else np.zeros(len(rows))
            return model.lowest + tails.sum(1), tail

        return rated

    asked = docs.withColumn("expected_grade", F.struct(F.col(text_col).alias("text")))
    fields = [T.StructField(c, T.DoubleType()) for c in ("expected_grade", "tail_probability")]
    return add_columns(asked, load, "expected_grade", fields)
