"""Where intermediate tables go, and how the input tables are read."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where that is unset, as in tests, a new local one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="llm-"))


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write a table into the shared folder, in folders ``by`` columns, and read it again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{os.getpid()}-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
