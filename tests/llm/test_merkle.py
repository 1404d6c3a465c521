"""The audit against a plain comparison of all records."""

import random

from quillset.llm import merkle

SCHEMA = "file string, offset long, length long, record_id long, payload binary, digest string"


def plain(a, b):
    def by_place(rows):
        found = {}
        for r in rows:
            found.setdefault((r[0], r[1]), []).append((r[2], bytes(r[4] or b"")))
        return {k: sorted(v) for k, v in found.items()}

    left, right = by_place(a), by_place(b)
    out = {}
    for place in left.keys() | right.keys():
        if left.get(place) != right.get(place):
            out[place] = "missing" if place not in right else "extra" if place not in left else "corrupt"
    return out


def test_equals_plain_comparison(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 256)
    rng = random.Random(4)
    rows = []
    for file in ("hot", "b", None):
        at = 0
        for i in range(400 if file == "hot" else 30):
            size = rng.randint(0, 120)
            rows.append((file, at, size, i, rng.randbytes(size) if size else None, "x"))
            at += size + 1
    rows += [rows[3], ("b", None, 5, 1, b"abc", "x")]
    other = [r for r in rows if rng.random() > 0.02]
    other = [(*r[:4], (r[4] or b"") + b"!", r[5]) if rng.random() < 0.02 else r for r in other]
    other += [("new", 0, 1, 7, b"n", "x"), rows[10]]
    a, b = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA)
    got = {(r.file, r.offset): r.damage for r in merkle.audit(a, b).collect()}
    assert got == plain(rows, other)
    assert merkle.audit(a, a).count() == 0
    assert merkle.audit(a.limit(0), b.limit(0)).count() == 0
    assert {r.damage for r in merkle.audit(a, b.limit(0)).collect()} == {"missing"}
