import random
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillset.functions.lcs import lcs_positions, lcs_size, union_lcs_hits
from quillset.functions import stemming
from quillset.functions.stemming import stem
from quillset.operators.rouge import corpus_scores, eval_pairs, rouge_scores
from quillset.plans.evaluate import evaluate_predictions

EXACT_METRICS = ("rouge1", "rouge2", "rougeL", "rougeLsum")


def table(a, b):
    grid = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            grid[i][j] = grid[i - 1][j - 1] + 1 if x == y else max(grid[i - 1][j], grid[i][j - 1])
    return grid


def traced(a, b):
    grid, i, j, found = table(a, b), len(a), len(b), set()
    while i > 0 and j > 0:
        if a[i - 1] == b[j - 1]:
            found.add(i - 1)
            i, j = i - 1, j - 1
        elif grid[i][j - 1] > grid[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return found


def random_tokens(rng, most=14):
    return [rng.choice("abcde") for _ in range(rng.randrange(most))]


def test_lcs_against_the_full_table():
    rng = random.Random(1)
    for _ in range(500):
        a, b = random_tokens(rng), random_tokens(rng)
        assert lcs_size(a, b) == table(a, b)[-1][-1]
        assert lcs_positions(a, b) == traced(a, b)


def test_lcs_of_many_equal_and_many_different_tokens():
    rng = random.Random(4)
    for kinds, n in ((2, 150), (400, 300)):
        a, b = [[str(rng.randrange(kinds)) for _ in range(n)] for _ in range(2)]
        assert lcs_size(a, b) == table(a, b)[-1][-1]
        assert lcs_positions(a, b) == traced(a, b)


def test_memory_of_long_texts_stays_small():
    rng = random.Random(5)
    a, b = [[str(int(rng.paretovariate(0.6)) % 30_000) for _ in range(40_000)] for _ in range(2)]
    tracemalloc.start()
    lcs_size(a, b)
    assert tracemalloc.get_traced_memory()[1] < 40e6
    tracemalloc.reset_peak()
    lcs_positions(a[:20_000], b[:20_000])
    assert tracemalloc.get_traced_memory()[1] < 60e6
    tracemalloc.stop()


def test_union_lcs_example():
    # Lin 2004: reference w1..w5 against w1 w2 w6 w7 w8 and w1 w3 w8 w9 w5 covers w1 w2 w3 w5.
    assert union_lcs_hits([list("12345")], [list("12678"), list("13895")]) == 4


def brute_scores(prediction, reference, metric):
    def tokens(text):
        return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in text.lower()).split()

    p, r = tokens(prediction), tokens(reference)
    if metric == "rougeL":
        overlap, np, nr = table(r, p)[-1][-1], len(p), len(r)
    elif metric == "rougeLsum":
        ps, rs = ([tokens(x) for x in text.strip().split("\n") if x] for text in (prediction, reference))
        left_p, left_r, overlap = Counter(p), Counter(r), 0
        for line in rs:
            for i in sorted(set().union(*(traced(line, other) for other in ps))):
                if left_p[line[i]] > 0 and left_r[line[i]] > 0:
                    left_p[line[i]] -= 1
                    left_r[line[i]] -= 1
                    overlap += 1
        np, nr = len(p), len(r)
    else:
        n = int(metric[-1])
        grams = [Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1)) for x in (p, r)]
        overlap, np, nr = (grams[0] & grams[1]).total(), grams[0].total(), grams[1].total()
    precision, recall = overlap / max(np, 1), overlap / max(nr, 1)
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return round(precision, 9), round(recall, 9), round(f1, 9)


def test_scores_against_brute_force(spark):
    rng = random.Random(2)
    words = ["the", "cat", "Sat", "on", "naïve", "mat", "v1.2", "a"]
    separators = [" ", " ", " ", "\n", ", ", "\n\n"]

    def text():
        return "".join(rng.choice(words) + rng.choice(separators) for _ in range(rng.randrange(20)))

    rows = [(i, text(), text()) for i in range(120)] + [(900, "", ""), (901, "!!!", "a b"), (902, " a b ", "a b")]
    rows += [(903, None, "a b"), (904, "long " * 3000 + "tail", "head " + "long " * 2500)]
    pairs = spark.createDataFrame(rows, "id long, prediction string, reference string").repartition(3)
    found = {
        (r.id, r.metric): (round(r.precision, 9), round(r.recall, 9), round(r.f1, 9))
        for r in rouge_scores(pairs, stemmed=False).collect()
    }
    assert len(found) == len(rows) * 4
    for i, prediction, reference in rows[:-1]:
        for metric in EXACT_METRICS:
            assert found[i, metric] == brute_scores(prediction or "", reference, metric), (prediction, reference, metric)
    assert found[904, "rougeL"][:2] == (round(2500 / 3001, 9), round(2500 / 2501, 9))
    assert found[902, "rougeLsum"] == (1.0, 1.0, 1.0)


def test_f1_is_symmetric(spark):
    pairs = spark.createDataFrame([(1, "a b c d", "b c x"), (2, "q", "q q q")], "id int, prediction string, reference string")
    swapped = pairs.select("id", F.col("reference").alias("prediction"), F.col("prediction").alias("reference"))
    one, two = ({(r.id, r.metric): r.f1 for r in rouge_scores(df).collect()} for df in (pairs, swapped))
    assert one == two


# Published examples of the algorithm, and of the irregular forms and extra rules scorers apply.
STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "agreed": "agre", "plastered": "plaster",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size",
    "hopping": "hop", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "relational": "relat", "conditional": "condit", "rational": "ration", "valenci": "valenc",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "vileli": "vile", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "formaliti": "formal", "sensibiliti": "sensibl",
    "triplicate": "triplic", "formative": "form", "electrical": "electr", "goodness": "good", "revival": "reviv",
    "gyroscopic": "gyroscop", "defensible": "defens", "replacement": "replac", "adjustment": "adjust",
    "adoption": "adopt", "communism": "commun", "effective": "effect", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll", "dying": "die", "skies": "sky", "news": "news",
    "flies": "fli", "dies": "die", "tied": "tie", "spied": "spi", "enjoy": "enjoy", "geologi": "geolog",
    "sayings": "say", "2000s": "2000", "yes": "yes", "was": "was", "toy": "toy", "boys": "boy", "apologies": "apolog",
}


def test_stems(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "w string")
    assert {r.w: r.s for r in df.select("w", stem(F.col("w")).alias("s")).collect()} == STEMS
    nested = df.agg(F.collect_list("w").alias("ws")).select("ws", F.transform("ws", stem).alias("ss")).first()
    assert dict(zip(nested.ws, nested.ss)) == STEMS


def test_corpus_scores(spark):
    predictions = spark.createDataFrame([(1, "models failing"), (2, "x y"), (3, "unpaired")], "id int, prediction string")
    references = spark.createDataFrame([(1, "model fails"), (2, "x z q"), (4, "unpaired")], "id int, reference string")
    found = {r.metric: r.value for r in evaluate_predictions(predictions, references).collect()}
    assert found == {"rouge1": 46.67, "rouge2": 33.33, "rougeL": 46.67, "rougeLsum": 46.67}
    custom = eval_pairs(predictions, references).select(
        F.lit("exact").alias("metric"), (F.col("prediction") == F.col("reference")).cast("double").alias("f1")
    )
    assert corpus_scores(custom).first().value == 0.0


def test_reference_without_prediction_scores_zero(spark):
    predictions = spark.createDataFrame([(1, "a b")], "id int, prediction string")
    references = spark.createDataFrame([(1, "a b"), (2, "c d")], "id int, reference string")
    found = {r.metric: r.value for r in evaluate_predictions(predictions, references).collect()}
    assert set(found.values()) == {50.0}


@pytest.mark.parametrize("rows", [[(1, "a b", "a"), (1, "c", "c d")], [(None, "a", "a")], [(2, "", ""), (2, "", "")]])
def test_repeated_and_null_keys_are_refused(spark, rows):
    pairs = spark.createDataFrame([*rows, (7, "x", "x")], "id int, prediction string, reference string")
    for metrics in (("rouge1",), ("rouge2", "rougeL")):
        with pytest.raises(Exception, match="null or repeated"):
            rouge_scores(pairs, metrics).collect()


def test_ngrams_never_become_rows(spark):
    # The first text shares more n-grams than are looked up one by one.
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, *[" ".join(rng.choices(words, k=n)) for _ in range(2)]) for i, n in enumerate((2000, 600, 40, 3, 1, 0))]
    rows += [(10, "a " * 700, "a " * 300 + "b"), (11, " ".join(words * 3), " ".join(words[::-1] * 2 + words))]
    pairs = spark.createDataFrame(rows, "id long, prediction string, reference string")
    scores = rouge_scores(pairs, ("rouge1", "rouge2"), stemmed=False)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert not any("metric" in line for line in plan.split("\n") if "Aggregate" in line)
    found = {(r.id, r.metric): (round(r.precision, 9), round(r.recall, 9), round(r.f1, 9)) for r in scores.collect()}
    assert found == {(i, m): brute_scores(p, r, m) for i, p, r in rows for m in ("rouge1", "rouge2")}


def test_each_word_is_stemmed_once_for_all_texts(spark, monkeypatch):
    # Made words with all endings, in both forms of the stemmer.
    rng = random.Random(11)
    ends = ["", "e", "s", "y", "ies", "ied", "eed", "ed", "ing", "ll", "logi", *stemming.ALL_SUFFIXES]
    words = ["".join(rng.choices("aeiouybcdlnrstxz0", k=rng.randrange(6))) + rng.choice(ends) + rng.choice(ends[:9]) for _ in range(8000)]
    words = sorted({w for w in [*words, *STEMS, *stemming.IRREGULAR] if w})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    native = {r.w: r.s for r in df.select("w", stem(F.col("w")).alias("s")).collect()}
    assert dict(zip(words, stemming.stemmer()(words))) == native
    stemmed = []
    monkeypatch.setattr(stemming, "stem_word", lambda w: stemmed.append(w) or w)
    stemming.stemmer()(["relational", "b" * 99] * 1000)
    assert stemmed.count("relational") == 1 and stemmed.count("b" * 99) == 1000


def test_all_metrics_go_to_python_at_once_as_texts(spark):
    pairs = spark.createDataFrame([(1, "A b\n\nÇa C\u212a", "b a")], "id long, prediction string, reference string")
    plan = rouge_scores(pairs)._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and plan.count("ArrowEvalPython") == 1
    found = {r.metric: (r.precision, r.recall) for r in rouge_scores(pairs).collect()}
    assert found == {"rouge1": (0.5, 1.0), "rouge2": (1 / 3, 1.0), "rougeL": (0.5, 1.0), "rougeLsum": (0.5, 1.0)}


def test_lcs_positions_of_lines_with_other_tokens():
    rng = random.Random(12)
    for _ in range(2000):
        a, b = [[rng.choice("abcd") for _ in range(rng.randrange(9))] for _ in range(2)]
        b = [t if rng.random() < 0.6 else rng.choice("wxyz") for t in b]
        assert lcs_positions(a, b) == traced(a, b)
