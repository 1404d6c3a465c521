"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import duckdb
import pytest

from quillset.llm import prefix_trie
from quillset.llm.queries import ORACLES, op13_prefix_trie

SCHEMA = "text string, conv_id int, role string, turn long, depth int, name string"


def brute(rows):
    """The contract's rows for (conv_id, turn, role, text)."""

    def digest(role, text):
        return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()

    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest(role, text), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v, key=lambda x: x[:3])] for c, v in convs.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - int(c % 5 if c >= 0 else -(-c % 5)), [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            nodes.setdefault(whole[:d], []).append((c, len(whole)))
    children, saved, leaves = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for key in nodes:
        if key:
            children[key[:-1]] += 1
    for key, members in nodes.items():
        own_saved = (len(members) - 1) * len(key[-1][1].encode()) if key else 0
        for d in range(len(key) + 1):
            saved[key[:d]] += own_saved
            leaves[key[:d]] += not children[key]
    found = []
    for key, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, n in members if n == len(key)))
        parent = min(nodes[key[:-1]])[0] if key else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(members)[0], len(key), parent, len(members), children[key], leaves[key], saved[key], sha))
    return sorted(found, key=repr)


def made(spark, rows):
    frame = spark.createDataFrame([(text, c, role, turn, 1, "x") for c, turn, role, text in rows], SCHEMA)
    return sorted(map(tuple, prefix_trie.prefix_trie(frame.repartition(3)).collect()), key=repr)


def test_query_and_sql_on_whole_table(spark, sf_dir):
    table = f"{sf_dir}/conversations.parquet"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(table).collect()]
    got = sorted(map(tuple, op13_prefix_trie(spark, sf_dir).collect()), key=repr)
    assert got == brute(rows)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{table}'")
    assert sorted(db.execute(ORACLES["op13_prefix_trie"]).fetchall(), key=repr) == got


@pytest.mark.parametrize(("leaf", "seed"), [(2, 1), (4, 2), (16, 3)])
def test_random_conversations_of_all_depths(spark, monkeypatch, leaf, seed):
    monkeypatch.setattr(prefix_trie, "LEAF", leaf)
    monkeypatch.setattr(prefix_trie, "IDS_OF_BLOCK", 3)
    rng = random.Random(seed)
    said = [("user", "a"), ("user", "bé"), ("assistant", "a"), (None, "a"), ("user", None), (None, None), ("usera", "")]
    stems = [[rng.choice(said) for _ in range(n)] for n in (3, 9, 17, 40)]
    rows = []
    for c in range(-7, 60):
        if c % 10 == 5:
            continue  # others ask for turns of an absent conversation
        turns = rng.choice(stems)[: rng.randint(0, 40)] + [rng.choice(said) for _ in range(rng.choice([0, 0, 1, 3, 12]))]
        rows += [(c, None if t == 2 else t // 2, role, text) for t, (role, text) in enumerate(turns)]
    rows += rows[40:60] + [(None, 1, "user", "no conversation"), (200, 0, "user", "alone"), (1000, 1, None, None)]
    rng.shuffle(rows)
    assert made(spark, rows) == brute(rows)


def test_one_conversation_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LEAF", 4)
    rows = [(3, t, "user", f"t{t % 50}") for t in range(700)] + [(c, 0, "user", "t0") for c in range(100, 130)]
    rows += [(8, t, "user", f"t{t % 50}") for t in range(700)]
    assert made(spark, rows) == brute(rows)


def test_equal_conversations_and_equal_turns(spark):
    rows = [(c, t, "user", f"x{t}") for c in range(300) for t in range(2)] + [(999, 1, "user", "same")] * 40
    assert made(spark, rows) == brute(rows)


def test_empty_and_turnless(spark):
    assert made(spark, []) == []
    assert made(spark, [(None, 1, "user", "x")]) == []
    rows = [(c, 0, "user", "x") for c in (6, 7, 8, 9, 11, 12)]  # 5 and 10 are absent
    assert made(spark, rows) == brute(rows)
