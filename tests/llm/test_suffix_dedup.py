"""Suffix-array dedup against a count of all windows."""

import collections
import hashlib
import random

import numpy as np
import pytest

from quillset.llm import suffix_dedup
from quillset.llm.queries import op1_suffix_dedup


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    kept = []
    for r in raw:
        cut = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                cut[i : i + length] = b"\1" * length
        kept.append((bytes(b for b, m in zip(r, cut) if not m), sum(cut)))
    return kept


def sample(seed=1, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(300)]

    def text(k):
        return " ".join(rng.choice(words) for _ in range(k))

    shared = [text(rng.randint(20, 200)) for _ in range(12)]
    rows = []
    for i in range(n):
        t = text(rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            t += " " + p[rng.randint(0, len(p) // 3) : len(p) - rng.randint(0, len(p) // 3)] + " " + text(rng.randint(0, 60))
        rows.append((i, t))
    return rows + [
        (900, None),
        (901, ""),
        (902, "a" * 3000),
        (903, "ab" * 1000),
        (904, rows[5][1]),
        (904, rows[5][1]),
        (904, "another text with this id"),
        (None, rows[7][1]),
        (905, text(3000) + shared[1]),
    ]


@pytest.mark.parametrize(("length", "owned", "cap"), [(400, 256, 128), (100, 64, 2), (65, 2, 128)])
def test_equals_window_counts(spark, monkeypatch, length, owned, cap):
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", cap)
    rows = sample()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, kept string, start int")
    found = suffix_dedup.remove_repeats(docs.repartition(4), length=length, owned=owned).collect()
    got = collections.Counter((r.doc_id, r.text, bytes(r.kept), sum(s.end - s.start for s in r.repeats)) for r in found)
    want = collections.Counter((*r, *k) for r, k in zip(rows, brute([t for _, t in rows], length), strict=True))
    assert got == want
    assert all(a.end < b.start for r in found for a, b in zip(r.repeats, r.repeats[1:]))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(docs).count() == 0


def test_sort_orders_suffixes():
    data = np.frombuffer(b"banana-bandana-banana-ban" + b"\0" * 8, np.uint8)
    at = np.arange(17)
    order = suffix_dedup.SuffixSort(data, 8).order(at, np.zeros(len(at), int))
    raw = data.tobytes()
    assert [raw[i : i + 8] for i in order] == sorted(raw[i : i + 8] for i in at)


def test_hash_collision_is_settled_by_bytes(monkeypatch):
    data = np.frombuffer(b"abcdabce" + b"abcd" * 3, np.uint8)
    sort = suffix_dedup.SuffixSort(data, 4)
    monkeypatch.setattr(sort, "common", lambda a, b: np.full(len(a), 4))
    found = sort.repeated(np.array([0, 4, 8, 12]), np.zeros(4, int))
    assert found.tolist() == [True, False, True, True]


def test_query_on_whole_table(spark, sf_dir):
    got = {r.doc_id: r for r in op1_suffix_dedup(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    for row, (kept, removed) in zip(rows, brute([r.text for r in rows], 400), strict=True):
        assert got[row.doc_id].kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert got[row.doc_id].n_removed == removed


def test_rows_without_id_that_share_nothing_keep_their_bytes(spark):
    """Texts are told apart by 128 bits: many rows without id, some of them equal, and none loses a byte of its own."""
    rng = random.Random(8)

    def text(n):
        return "".join(rng.choices("abcdefghij", k=n))

    own = [text(rng.randint(400, 700)) for _ in range(300)]
    same = text(900)
    rows = [(None, t) for t in own] + [(None, same)] * 200
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(bytes(r.kept).decode() for r in found if r.kept) == sorted(own)
    whole = [r for r in found if not r.kept]
    assert len(whole) == 200 and all([tuple(s) for s in r.repeats] == [(0, 900)] for r in whole)


def test_hot_classes_are_dealt_apart(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", -1.0)
    rng = random.Random(9)
    same = "".join(rng.choices("abcdefghij", k=1500))
    rows = [(i, f"{i:06d}{same}") for i in range(1200)] + [(9999, "x" * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(docs).collect()
    got = {r.doc_id: (bytes(r.kept), sum(s.end - s.start for s in r.repeats)) for r in found}
    assert got == dict(zip([i for i, _ in rows], brute([t for _, t in rows], 400), strict=True))
