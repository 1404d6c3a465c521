from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillset import session
from quillset.schemas import RAW_PAPER
from quillset.sources import atom, jsonl, splits

LINE = '{"arxiv_id": "2401.00010", "title": "%s", "abstract": "a", "authors": ["A"], "categories": ["c"], "published": null}'


def test_read_skips_blank_lines_and_keeps_id_text(spark, tmp_path):
    path = tmp_path / "arxiv_1.jsonl"
    path.write_text("\n" + LINE % "é" + "\n   \n\n" + LINE % "b" + "\n")
    rows = jsonl.read_jsonl(spark, str(path)).collect()
    assert [(r.arxiv_id, r.title, r.authors, r.pdf_url) for r in rows] == [
        ("2401.00010", "é", ["A"], None),
        ("2401.00010", "b", ["A"], None),
    ]


def test_malformed_line_fails(spark, tmp_path):
    path = tmp_path / "arxiv_1.jsonl"
    path.write_text(LINE % "a" + "\n{broken\n")
    with pytest.raises(Exception, match="MALFORMED"):
        jsonl.read_jsonl(spark, str(path)).collect()


def test_write_counts_rows_and_keeps_nulls_and_unicode(spark, tmp_path):
    df = spark.createDataFrame([("1", "é", None, None, None, None, None)] * 5, RAW_PAPER).repartition(3)
    assert jsonl.write_jsonl(df, str(tmp_path / "out")) == 5
    line = next((tmp_path / "out").glob("part*")).read_text().splitlines()[0]
    assert '"title":"é"' in line and '"abstract":null' in line


def test_latest_snapshot(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        jsonl.latest_snapshot(spark, str(tmp_path))
    (tmp_path / "_smoke_1.jsonl").write_text(LINE % "hidden")
    with pytest.raises(ValueError):
        jsonl.read_jsonl(spark, jsonl.latest_snapshot(spark, str(tmp_path)))
    (tmp_path / "smoke_1.jsonl").write_text(LINE % "smoke")
    assert jsonl.latest_snapshot(spark, str(tmp_path)).endswith("/smoke_1.jsonl")
    for day in ("20240102", "20240101"):
        (tmp_path / f"arxiv_{day}_000000.jsonl").write_text(LINE % day)
    assert jsonl.latest_snapshot(spark, str(tmp_path)).endswith("/arxiv_20240102_000000.jsonl")


def test_snapshot_is_never_overwritten(spark, tmp_path):
    df = spark.createDataFrame([("1", "t", None, None, None, None, None)], RAW_PAPER)
    now = datetime(2024, 5, 6, 7, 8, 9)
    path, rows = jsonl.write_snapshot(df, str(tmp_path), now)
    assert path.endswith("/arxiv_20240506_070809.jsonl") and rows == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        jsonl.write_snapshot(df, str(tmp_path), now)


FEED = """<?xml version="1.0" encoding="UTF-8"?>
<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
  <title>query</title>
  <entry>
    <id>http://arxiv.org/abs/2401.00001v2</id>
    <published>2024-01-01T10:00:00Z</published>
    <title> A long
title </title>
    <summary>
 First.
Second. </summary>
    <author><name>Ann</name><arxiv:affiliation>X</arxiv:affiliation></author>
    <author><name>Bo</name></author>
    <arxiv:comment>12 pages</arxiv:comment>
    <link href="http://arxiv.org/abs/2401.00001v2" rel="alternate"/>
    <link title="pdf" href="http://arxiv.org/pdf/2401.00001v2"/>
    <link title="pdf" href="http://arxiv.org/pdf/other"/>
    <category term="cs.CL" scheme="s"/><category term="cs.LG"/>
  </entry>
  <entry>
    <id>http://arxiv.org/abs/2401.00002v1</id>
    <published>2024-01-02T10:00:00Z</published>
    <title>B</title>
    <summary>Text</summary>
    <author><name>Cy</name></author>
    <link href="http://arxiv.org/abs/2401.00002v1" rel="alternate"/>
    <category term="stat.ML"/>
  </entry>
</feed>
"""


def test_atom_feed(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(FEED)
    one, two = atom.read_atom(spark, str(tmp_path / "feed.xml")).orderBy("arxiv_id").collect()
    assert one.asDict() == {
        "arxiv_id": "2401.00001v2", "title": "A long title", "abstract": "First. Second.", "authors": ["Ann", "Bo"],
        "categories": ["cs.CL", "cs.LG"], "published": "2024-01-01T10:00:00Z", "pdf_url": "http://arxiv.org/pdf/2401.00001v2",
    }
    assert (two.authors, two.categories, two.pdf_url) == (["Cy"], ["stat.ML"], None)


def split_rows(spark, *names):
    rows = [(str(i), s) for i, s in enumerate(names)]
    return spark.createDataFrame(rows, "id string, split string").withColumn("summary", F.lit("s"))


def test_splits_on_disk_and_stage_order(spark, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        splits.training_stage(spark, out)
    splits.save_splits(split_rows(spark, "train", "train", "val"), out)
    assert sorted(p.name for p in (tmp_path / "out/papers.parquet").glob("split=*")) == ["split=train", "split=val"]
    assert splits.training_stage(spark, out) == ""
    with pytest.raises(FileNotFoundError):
        splits.load_split(spark, out, "test")
    assert splits.load_split(spark, out, "train").count() == 2
    loaded = splits.load_training_splits(spark, out)
    assert {r.split: r["count"] for r in loaded.groupBy("split").count().collect()} == {"train": 2, "val": 1}
    splits.save_splits(split_rows(spark, "train", "val", "test"), out, "_with_summaries")
    assert splits.training_stage(spark, out) == "_with_summaries"
    splits.save_splits(split_rows(spark, "train", "val"), out, "_filtered")
    assert splits.training_stage(spark, out) == "_filtered"
    splits.save_splits(split_rows(spark, "train"), out, "_small")
    with pytest.raises(FileNotFoundError):
        splits.training_stage(spark, out)


def test_shared_dir_comes_from_the_session(spark, tmp_path):
    assert session.shared_dir(spark).startswith("/tmp/")

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        def __init__(self, **conf):
            self.conf = Conf({k.replace("__", "."): v for k, v in conf.items()})

    cluster = Session(spark__master="yarn", spark__checkpoint__dir="hdfs://n/ckpt/")
    assert session.shared_dir(cluster) == "hdfs://n/ckpt"
    with pytest.raises(RuntimeError):
        session.shared_dir(Session(spark__master="yarn"))


def numbered_rows(spark, ids, split):
    return spark.createDataFrame([(i, f"t{i}", split) for i in ids], "id long, abstract string, split string")


def test_targets_are_looked_at_before_the_work(spark, tmp_path):
    out, seen = str(tmp_path / "data"), spark.sparkContext.accumulator(0)
    splits.save_splits(numbered_rows(spark, [1], "train"), out)
    watched = F.udf(lambda x: seen.add(1) or x, "string")
    more = numbered_rows(spark, [2], "val").withColumn("abstract", watched("abstract"))
    with pytest.raises(FileExistsError, match="overwrite"):
        splits.save_splits(more, out)
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "papers.jsonl").mkdir()
    with pytest.raises(FileExistsError, match="jsonl"):
        splits.save_splits(more, str(tmp_path / "lines"))
    assert seen.value == 0
    splits.save_splits(more, out, mode="overwrite")
    for kind in ("parquet", "json"):
        stored = spark.read.format(kind).load(f"{out}/papers.{'jsonl' if kind == 'json' else kind}")
        assert [(r.id, r.split) for r in stored.collect()] == [(2, "val")]
    assert seen.value == 1  # both formats come from one computation
    with pytest.raises(ValueError, match="append"):
        splits.save_splits(more, out, mode="append")


def test_training_splits_come_from_parquet(spark, tmp_path):
    out = str(tmp_path / "data")
    both = numbered_rows(spark, [1], "train").union(numbered_rows(spark, [2], "val")).union(numbered_rows(spark, [3], "other"))
    splits.save_splits(both, out)
    found = splits.load_training_splits(spark, out)
    assert sorted((r.id, r.abstract, r.summary, r.split) for r in found.collect()) == [
        ("1", "t1", None, "train"),
        ("2", "t2", None, "val"),
    ]
    plan = found.filter("split = 'val'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ReadSchema: struct<id:bigint>" in plan
    lines = splits.load_splits(spark, {s: splits.split_path(out, s) for s in ("train", "val")})
    assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, found.collect()))
