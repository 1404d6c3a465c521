import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quillset.functions.dates import naive_iso, parse_published, parse_range

CASES = [
    ("2024-01-01", datetime(2024, 1, 1)),
    ("2024-01-01T10:00:00", datetime(2024, 1, 1, 10)),
    ("2024-01-01 10:00:00", datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00Z", datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00+05:00", datetime(2024, 1, 1, 5)),
    ("2024-01-01T22:00:00-0500", datetime(2024, 1, 2, 3)),
    ("2024-01-01T10:00:00.250", datetime(2024, 1, 1, 10, 0, 0, 250000)),
    ("2024-01-01T10:30", datetime(2024, 1, 1, 10, 30)),
    ("2024-01-01 junk", datetime(2024, 1, 1)),
    ("2024-01-01 10:00:00 UTC", datetime(2024, 1, 1)),
    ("2024-1-5", datetime(2024, 1, 5)),
    ("20240101", datetime(2024, 1, 1)),
    ("20240101T103000", datetime(2024, 1, 1, 10, 30)),
    ("2024-01-01T10", datetime(2024, 1, 1, 10)),
    ("2024-01-01_1030", datetime(2024, 1, 1, 10, 30)),
    ("2024-01-01T10:00:00,1234567+05:30:15", datetime(2024, 1, 1, 4, 29, 45, 123456)),
    ("2024-01-01T10:00+24:00", None),
    ("2024-0101", None),
    ("2024-01-01\n", None),
    ("0000-01-01", None),
    ("2024", None),
    ("2024-01", None),
    ("2024-02-30", None),
    ("bad", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_parse_published_in_any_session_zone(spark, zone):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, x string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = df.select("i", parse_published(F.col("x")).alias("y")).orderBy("i").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.y for r in found] == [c[1] for c in CASES]


def test_naive_iso_keeps_the_clock(spark):
    df = spark.createDataFrame(
        [("2024-01-01T10:00:00+05:00",), ("2024-01-01T10:00:00Z",), ("2024-01-01",)], "x string"
    )
    assert [r.y for r in df.select(naive_iso(F.col("x")).alias("y")).collect()] == [
        "2024-01-01T10:00:00",
        "2024-01-01T10:00:00",
        "2024-01-01",
    ]


def test_parse_range():
    assert parse_range("2024-01-01") is None
    assert parse_range("") is None
    assert parse_range(None) is None
    assert parse_range("..") == (None, None)
    assert parse_range(" 2024-01-01 .. ") == (datetime(2024, 1, 1), None)
    with pytest.raises(ValueError):
        parse_range("2024-01-01..soon")


def test_date_range_in_any_session_zone(spark):
    from quillset.operators.papers import filter_date_range

    rows = [("a", "2024-01-01"), ("b", "2023-12-31T20:00:00"), ("c", "2024-01-31"), ("d", "2024-01-30T22:00:00")]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            papers = spark.createDataFrame(rows, "id string, published string")
            found = filter_date_range(papers, "2024-01-01..2024-01-31").collect()
            assert sorted(r.id for r in found) == ["a", "c", "d"], name
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def iso(text):
    """What the standard library reads, in UTC; week dates aside."""
    try:
        moment = datetime.fromisoformat(text)
    except ValueError:
        try:
            return datetime.strptime(text.split(" ")[0], "%Y-%m-%d")
        except ValueError:
            return None
    return moment.astimezone(timezone.utc).replace(tzinfo=None) if moment.tzinfo else moment


def test_spellings_as_the_standard_library_reads_them(spark):
    rng = random.Random(6)
    texts = []
    for _ in range(1500):
        date = rng.choice(["2024-03-07", "20240307", "2024-3-7", "2023-02-29", "2024-0307", "1999-12-31"])
        clock = rng.choice(["", "10", "10:5", "1005", "10:05", "10:05:59", "100559", "10:0559", "25:00", "23:59:60"])
        clock += rng.choice(["", "", ".5", ",25", ".1234567"]) if clock else ""
        zone = rng.choice(["", "", "Z", "+05:30", "-0500", "+05", "+05:30:15", "+5", "+23:59", "-24:00", "+0530:15"])
        texts.append(date + (rng.choice(["T", " ", "x", "_", "TT"]) + clock + zone if clock else rng.choice(["", " (v2)", "T"])))
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    found = {r.i: r.y for r in rows.select("i", parse_published(F.col("x")).alias("y")).collect()}
    assert {(t, found[i]) for i, t in enumerate(texts)} == {(t, iso(t)) for t in texts}
