"""The pipeline's stages against plain versions of their decisions, and what it catches and keeps."""

import random

import corpus_pipeline
from quillset.llm import toxicity
from tests.llm.test_decontaminate import brute as covered_words
from tests.llm.test_simhash import slow_components, slow_print
from tests.llm.test_suffix_dedup import brute as kept_bytes

STAGES = dict(corpus_pipeline.STAGES)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_stages_and_run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.collect()
    scores = model.scorer()([r.text for r in rows])
    clean = [r for r, s in zip(rows, scores, strict=True) if s < 0.5]
    got = STAGES["toxicity"](spark, docs, sf_dir)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in clean)

    prints = [slow_print(r.text) for r in clean]
    roots = slow_components([r.doc_id for r in clean], prints, 4)
    single = [r for r, root in zip(clean, roots, strict=True) if r.doc_id == root]
    got = STAGES["simhash_near_dedup"](spark, spark.createDataFrame(clean, docs.schema), sf_dir)
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in single)

    frame = spark.createDataFrame(single, docs.schema)
    got = {r.doc_id: r for r in STAGES["suffix_array_dedup"](spark, frame, sf_dir).collect()}
    for r, (kept, _) in zip(single, kept_bytes([r.text for r in single], 200), strict=True):
        assert got[r.doc_id].text == kept.decode("utf-8", "ignore")
        assert got[r.doc_id].n_chars == (len(got[r.doc_id].text) if got[r.doc_id].text != r.text else r.n_chars)

    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    cut = STAGES["benchmark_decontamination"](spark, frame, sf_dir)
    assert cut.columns == docs.columns
    got = {r.doc_id: r.text for r in cut.collect()}
    for r in single:
        n, hit, _ = covered_words(r.text, items, 10)
        assert (r.doc_id in got) == (hit <= 0.5 * n)
        assert hit > 0 or got[r.doc_id] == r.text

    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} <= {r.doc_id for r in single}
    assert "sequence_id" in packed.columns


def test_passages_of_fifty_words_go_and_the_rest_stays(spark, sf_dir):
    rng = random.Random(3)

    def words(n):
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))

    passages = [words(n) for n in range(50, 71, 2)]
    own = [words(rng.randint(20, 150)) for _ in range(40)]
    rows = [(i, f"{own[i]}\n{passages[i % len(passages)]}\n{own[39 - i]}"[: 10**6]) for i in range(2 * len(passages))]
    rows += [(100 + i, t) for i, t in enumerate(own[30:36])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in rows], schema)
    got = {r.doc_id: r.text for r in STAGES["suffix_array_dedup"](spark, docs, sf_dir).collect()}
    for i, text in rows[: 2 * len(passages)]:
        assert passages[i % len(passages)][20:-20] not in got[i]
    lone = spark.createDataFrame([(i, own[i], None, None, 1) for i in range(40)], schema)
    same = STAGES["suffix_array_dedup"](spark, lone, sf_dir).collect()
    assert sorted((r.doc_id, r.text) for r in same) == list(enumerate(own))


def test_edges(spark, sf_dir):
    rng = random.Random(1)
    passage = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(90))
    other = [" ".join("".join(rng.choices("ijklmnop", k=5)) for _ in range(60)) for _ in range(4)]
    rows = [(1, None), (2, ""), (None, other[0]), (3, other[1] + " " + passage), (4, passage + " " + other[2])]
    rows += [(5, other[3]), (5, other[3])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, hits string"
    docs = spark.createDataFrame([(i, t, None, None, None, "k", "h") for i, t in rows], schema)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            got = apply(spark, frame, sf_dir)
            assert got.columns == docs.columns, name
            got.collect()
    cut = {r.doc_id: r.text for r in STAGES["suffix_array_dedup"](spark, docs.filter("doc_id in (3, 4)"), sf_dir).collect()}
    assert cut[3].strip() == other[1] and cut[4].strip() == other[2]
    kept = STAGES["simhash_near_dedup"](spark, docs, sf_dir).collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, 1, 3, 4, 5]
