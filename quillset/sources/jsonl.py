"""JSON Lines files and the timestamped raw snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.schemas import RAW_PAPER

# File name patterns, best first, and the stamp of a snapshot.
SNAPSHOT_PATTERNS = ["arxiv_*.jsonl", "smoke_*.jsonl", "_smoke_*.jsonl"]
SNAPSHOT_NAME = "arxiv_%Y%m%d_%H%M%S.jsonl"


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths on any file system Spark can read; metadata only."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    return bool(matching_paths(spark, path))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = RAW_PAPER) -> DataFrame:
    """Blank lines are skipped and a malformed line fails the job. Types are never inferred."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if name.startswith("_"):
        raise ValueError(f"Spark hides files whose name starts with an underscore: {path}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, **options: str) -> int:
    """Write one JSON object per line, nulls included, and return the number of rows.

    The count is observed in the stage that writes, so it costs no second pass.
    """
    counter = Observation()
    counted = df.observe(counter, F.count(F.lit(1)).alias("rows"))
    counted.write.option("ignoreNullFields", "false").options(**options).json(path)
    return counter.get["rows"]


def latest_snapshot(spark: SparkSession, raw_dir: str) -> str:
    """The greatest snapshot name; smoke files only when there is no snapshot."""
    for pattern in SNAPSHOT_PATTERNS:
        found = matching_paths(spark, f"{raw_dir}/{pattern}")
        if found:
            return found[-1]
    raise FileNotFoundError(f"no raw JSONL snapshot in {raw_dir}")


def write_snapshot(df: DataFrame, raw_dir: str, now: datetime | None = None) -> tuple[str, int]:
    path = f"{raw_dir}/{(now or datetime.now()).strftime(SNAPSHOT_NAME)}"
    return path, write_jsonl(df, path)
