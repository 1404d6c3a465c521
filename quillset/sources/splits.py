"""Split tables on disk: one folder per stage and format, one partition per split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillset.schemas import LABELLED_PAPER
from quillset.sources.jsonl import path_exists, read_jsonl

# The suffixes a training job looks for, best first.
STAGES = ["_small", "_filtered", "_with_summaries", ""]


def save_splits(df: DataFrame, out_dir: str, stage: str = "", mode: str = "errorifexists") -> None:
    """Write Parquet and JSON Lines, partitioned by split. An empty split leaves no folder.

    Both targets are looked at before any work; ``overwrite`` replaces both. The rows are computed once: the JSON Lines
    are written from the stored Parquet.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode}: errorifexists or overwrite")
    stored, lines = f"{out_dir}/papers{stage}.parquet", f"{out_dir}/papers{stage}.jsonl"
    there = [path for path in (stored, lines) if path_exists(df.sparkSession, path)]
    if there and mode == "errorifexists":
        raise FileExistsError(f"{there} would be replaced; pass mode='overwrite'")
    df.write.mode(mode).partitionBy("split").parquet(stored)
    again = df.sparkSession.read.schema(df.schema).parquet(stored)
    again.write.mode(mode).partitionBy("split").option("ignoreNullFields", "false").json(lines)


def split_path(out_dir: str, split: str, stage: str = "") -> str:
    return f"{out_dir}/papers{stage}.jsonl/split={split}"


def load_split(
    spark: SparkSession, out_dir: str, split: str, stage: str = "", schema: T.StructType = LABELLED_PAPER
) -> DataFrame:
    path = split_path(out_dir, split, stage)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no split at {path}; prepare the dataset first")
    return read_jsonl(spark, path, schema).withColumn("split", F.lit(split))


def load_splits(
    spark: SparkSession, paths: dict[str, str], schema: T.StructType = LABELLED_PAPER
) -> DataFrame:
    """Union of the JSON Lines files that exist, each tagged with its split name."""
    parts = [
        read_jsonl(spark, path, schema).withColumn("split", F.lit(name))
        for name, path in paths.items()
        if path_exists(spark, path)
    ]
    if not parts:
        raise FileNotFoundError(f"none of the splits exists: {paths}")
    loaded = parts[0]
    for part in parts[1:]:
        loaded = loaded.unionByName(part)
    return loaded


def training_stage(spark: SparkSession, out_dir: str) -> str:
    """The most refined stage whose train split exists; it must also have a validation split."""
    for stage in STAGES:
        if path_exists(spark, split_path(out_dir, "train", stage)):
            if not path_exists(spark, split_path(out_dir, "val", stage)):
                raise FileNotFoundError(f"stage '{stage}' in {out_dir} has no val split")
            return stage
    raise FileNotFoundError(f"no train split in {out_dir}; prepare the dataset first")


def load_training_splits(spark: SparkSession, out_dir: str, schema: T.StructType = LABELLED_PAPER) -> DataFrame:
    """The train, validation and test splits of the most refined stage, in the columns and types of ``schema``.

    Read from Parquet where it is stored, so that only the wanted columns and splits are read; else from JSON Lines.
    """
    stage, names = training_stage(spark, out_dir), ["train", "val", "test"]
    path = f"{out_dir}/papers{stage}.parquet"
    if not path_exists(spark, path):
        return load_splits(spark, {s: split_path(out_dir, s, stage) for s in names}, schema)
    stored = spark.read.option("basePath", path).parquet(path).filter(F.col("split").isin(names))
    columns = [F.col(f.name) if f.name in stored.columns else F.lit(None) for f in schema.fields]
    typed = [c.cast(f.dataType).alias(f.name) for c, f in zip(columns, schema.fields)]
    return stored.select(*typed, F.col("split").cast("string").alias("split"))
