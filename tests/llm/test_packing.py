"""Packing: exact pieces, gapless sequences, and as few of them as a search over small cases finds."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillset.llm import packing
from quillset.llm.queries import op8_best_fit_packing


def check(rows, texts, encode, capacity=1024):
    lists = {}
    for doc_id, text in texts:
        ids = [*encode(text or ""), 2]
        lists.setdefault(doc_id, []).append(ids)
    place = {}
    for r in rows:
        place.setdefault(r.sequence_id, []).append((r.offset, r.length))
        whole = lists[r.doc_id][0]
        part = np.array(whole[r.start : r.start + r.length], "<u4")
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    for parts in place.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r.length for r in rows) == sum(len(x) for xs in lists.values() for x in xs)
    return len(place)


def test_query_on_whole_table(spark, sf_dir):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = op8_best_fit_packing(spark, sf_dir).collect()
    used = check(rows, [(d.doc_id, d.text) for d in docs], lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    assert used - -(-sum(r.length for r in rows) // 1024) <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_ids_equal_the_other_library(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = packing.byte_bpe()([*texts, "a<|endoftext|> b", "x " * 50, "\n\n\t  é"])
    other = tokenizer.encode_batch([*texts, "a<|endoftext|> b", "x " * 50, "\n\n\t  é"], add_special_tokens=False)
    assert own == [x.ids for x in other]


def fewest(lengths, capacity):
    best = len(lengths)

    def search(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k, room in enumerate(dict.fromkeys(bins)):
            if room >= lengths[i]:
                rest = list(bins)
                rest.remove(room)
                search(i + 1, [*rest, room - lengths[i]])
        search(i + 1, [*bins, capacity - lengths[i]])

    search(0, [])
    return best


def test_plans_are_valid_and_near_the_optimum():
    rng = random.Random(5)
    over = 0
    for _ in range(60):
        lengths = sorted((rng.randint(1, 19) for _ in range(rng.randint(1, 11))), reverse=True)
        counts = {n: lengths.count(n) for n in lengths}
        plan = packing.plan_bins(counts, 20)
        packed = sorted(itertools.chain.from_iterable(f.lengths * f.times for f in plan), reverse=True)
        assert packed == lengths
        assert all(sum(f.lengths) <= 20 for f in plan)
        over += sum(f.times for f in plan) - fewest(lengths, 20)
    assert over <= 1


def test_few_lengths_with_large_counts():
    counts = {600: 1000, 400: 1000, 212: 1000}
    plan, bound = packing.bounded_plan(counts)
    used = {n: sum(f.lengths.count(n) * f.times for f in plan) for n in counts}
    assert used == counts and all(sum(f.lengths) <= 1024 for f in plan)
    assert packing.size(plan) == bound == 1200  # one filling at a time, as often as the counts allow: 1250
    plan, bound = packing.bounded_plan({n: c * 1000 for n, c in counts.items()})
    assert packing.size(plan) == bound == 1_200_000


def test_dominance():
    left = {5: 1, 4: 1, 3: 2, 2: 2}
    bits = sum(1 << n for n in left)
    assert packing.dominated((3, 2), 0, left, bits)  # by 5
    assert packing.dominated((4,), 1, left, bits)  # by 5
    assert packing.dominated((3,), 2, left, bits)  # has room for 2
    assert not packing.dominated((5,), 1, left, bits)
    assert not packing.dominated((5, 3), 0, left, bits)


def test_edges(spark):
    texts = [(1, None), (1, ""), (None, "x"), (2, "word " * 5000), (3, "a" * 3000)]
    docs = spark.createDataFrame([(*t, 5) for t in texts], "doc_id long, text string, length int")
    rows = packing.pack(docs).collect()
    assert sorted(r.length for r in rows if r.doc_id == 1) == [1, 1]
    assert all(r.length == 1024 for r in rows if r.piece > 0)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert packing.pack(docs.limit(0)).count() == 0


def test_long_white_space_has_the_ids_of_the_other_library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [" " * 1_200_000 + "a", "a" + "\n" * 1_100_000 + "b", "word " * 30_000, " " * 100_000 + "x", "\t \u00a0" * 50_000]
    own = packing.byte_bpe()(texts)
    assert own == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
