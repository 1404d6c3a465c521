"""Token files: exact round trips of blocks, files and documents, equal ids, and damage that is noticed."""

import itertools
import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillset.llm import token_files
from quillset.llm.queries import op12_token_files


def plain_rows(rows, encode):
    """What the query returns, from the texts themselves."""
    found, start = [], 0
    order = sorted(((d is not None, d or 0), len(x), zlib.crc32(x), d) for d, x in [(d, encode(t)) for d, t in rows])
    for _, size, crc, doc_id in order:
        found.append((doc_id, start, size // 4, crc))
        start += size // 4
    return found


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda t: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


def test_query_on_whole_table(spark, sf_dir, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op12_token_files(spark, sf_dir)
    assert got.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_rows(rows, library))


def test_edges_and_documents_over_blocks_and_files(spark, monkeypatch, tmp_path, library):
    monkeypatch.setattr(token_files, "BLOCK", 1000)
    monkeypatch.setattr(token_files, "FRAMES_PER_FILE", 3)
    monkeypatch.setattr(token_files, "PART_IDS", 5000)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["one", "two", "Über", "ß", "x1", "日本語", "\n"], k=rng.randint(0, 400))) for _ in range(60)]
    rows = [(i - 5, t) for i, t in enumerate(texts)]
    rows += [(None, "no id"), (None, None), (None, "no id"), (7, "again"), (7, "again"), (7, ""), (100, "word " * 20_000)]
    docs = spark.createDataFrame([(t, d, "x", 1) for d, t in rows], "text string, doc_id int, ids string, n int")
    write, read = str(tmp_path / "files"), token_files.read_documents
    token_files.write_ids(docs.repartition(3), write)
    assert sorted(map(tuple, read(spark, write).collect()), key=repr) == sorted(plain_rows(rows, library), key=repr)
    pieces = token_files.read_pieces(spark, write, with_ids=True).collect()
    whole = {}
    for p in sorted(pieces, key=lambda p: (p.part, p.document, p.begin)):
        assert p.n == len(p.ids) and p.begin == len(whole.setdefault((p.part, p.document), []))
        whole[p.part, p.document] += p.ids
    assert sorted(np.array(x, "<u4").tobytes() for x in whole.values()) == sorted(library(t) for _, t in rows)
    assert max(p.n for p in pieces) <= 1000 and len({p.part for p in pieces}) > 1


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.roundtrip(docs, str(tmp_path / "none")).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_ids_of_words_are_ids_of_the_text(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [*texts, "".join(texts), "it's <|endoftext|> x<|startoftext|>y ΑΣ Σ", "a ̈b\ńc　d\x1ce"]
    assert lists_of(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_every_code_point_and_a_small_store(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 50)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a ".join(points[i : i + 5000]) for i in range(0, len(points), 5000)]
    texts += ["".join(points[i : i + 3000]) for i in range(0, 30_000, 3000)]
    texts += ["a%s b%s. %sc,, x%sy" % (c, c, c, c) for c in points[:0x3000]]
    words = re.findall(r"[^\W\d_]+", open(token_files.__file__).read())
    texts += [f"{a}{b}. {b}{a.upper()}, {a}é{b} É{a}.,." for a, b in itertools.pairwise(words)]
    assert lists_of(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def lists_of(texts):
    ids, sizes = token_files.WordIds()(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def coded(ids, counts=None):
    numbers, times = np.unique(ids, return_counts=True)
    table = token_files.Table.of_counts(counts or dict(zip(numbers.tolist(), times.tolist(), strict=True)))
    writer = token_files.PartWriter(table, 3)
    frames = [*writer.add(5, np.asarray(ids, np.uint32)), *writer.end()]
    return token_files.Table.from_bytes(table.to_bytes()), frames


@pytest.mark.parametrize("n", [1, 31, 32, 33, 8192, 8193, 70_000])
def test_blocks_round_trip_near_the_entropy(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.uint32)
    table, frames = coded(ids)
    assert int(table.freq.sum()) == 1 << table.bits and int(table.freq.min()) >= 1
    got = [x for _, _, x in token_files.decoded(table, table.lookup(), frames)]
    assert np.array_equal(np.concatenate(got), ids)
    if n > 50_000:
        share = np.unique(ids, return_counts=True)[1] / n
        words = sum(struct.unpack_from(token_files.FRAME, f, token_files.HEAD_SIZE)[4] for f in frames) * 32
        assert words <= 1.02 * n * float(-(share * np.log2(share)).sum())


def test_one_symbol_and_a_full_vocabulary():
    for ids in (np.zeros(5000, np.uint32), np.arange(300_000, dtype=np.uint32)):
        table, frames = coded(ids)
        got = np.concatenate([x for _, _, x in token_files.decoded(table, table.lookup(), frames)])
        assert np.array_equal(got, ids)


def test_damage_is_noticed():
    _, frames = coded(np.arange(40_000, dtype=np.uint32) % 77)
    content = b"".join(f + b"\n" for f in frames)
    assert list(token_files.frames_of(content)) == frames
    for at in (20, len(frames[0]) // 2, len(content) - 2):
        broken = content[:at] + bytes([content[at] ^ 1]) + content[at + 1 :]
        with pytest.raises(ValueError, match=r"damaged|inside a frame"):
            list(token_files.frames_of(broken))
    with pytest.raises(ValueError, match="inside a frame"):
        list(token_files.frames_of(content[:-9]))


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_joined_checksums(a, b):
    assert token_files.JoinedCrc()(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
