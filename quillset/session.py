"""Where intermediate tables live, and how they are written."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="quillset-")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in only in local mode, where one machine is the whole cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quillset-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage so that later passes neither repeat the work upstream nor depend on the
    executors that did it, and lets those passes read only the columns they need.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row.

    Catalyst pushes a filter below a projection by copying the projected expression into it, so a
    chain of regular expressions would run once per filter and once more for the output. It does
    not push filters through a generator, hence the one-element ``inline``.
    """
    kept = [F.col(c) for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input to all cores.

    A file with few row groups would keep most cores idle during the work on its texts. An input of
    many partitions is left alone, so no large table is shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
