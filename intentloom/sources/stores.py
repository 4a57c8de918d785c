"""Tables kept as files: appends with their rejects, written bundles, objects by day, the narrow catalog."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from intentloom.operators.models import materialize
from intentloom.sources.readers import item_catalog
from intentloom.sources.sinks import bucket_of, validated

_MARKS = T.StructType([T.StructField(n, T.StringType()) for n in ("reject_reason", "given", "run", "outcome")])


def append_with_rejects(rows: DataFrame, schema: T.StructType, required: tuple[str, ...], path: str, run: str) -> None:
    """Append what can be read and keep the rest beside it, in one pass over ``rows``.

    One write job makes ``run=<run>/outcome=accepted`` and ``outcome=rejected``, and its commit publishes both, so
    no reader sees one without the other. Rejected rows have their reasons and the row as it came. The same run
    written again replaces itself and no other run.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"run {run!r}: only letters, digits, dots, dashes and underscores")
    clash = {f.name.lower() for f in schema.fields} & set(_MARKS.names)
    if clash:
        raise ValueError(f"columns {', '.join(sorted(clash))} are taken by the table itself")
    checked = validated(rows, schema, required, given="given")
    outcome = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    checked.withColumn("outcome", outcome).write.mode("overwrite").partitionBy("outcome").parquet(f"{path}/run={run}")


def _appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, *_MARKS.fields])).parquet(path)


def read_accepted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Accepted rows of all runs; files of rejected ones are not opened."""
    return _appended(spark, path, schema).where("outcome = 'accepted'").select(*schema.names)


def read_rejected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(run, reject_reason, given) of the rejected rows of all runs."""
    return _appended(spark, path, schema).where("outcome = 'rejected'").select("run", "reject_reason", "given")


def read_bundles(spark: SparkSession, path: str, schema: T.StructType, buckets: int = 256, asked: DataFrame | None = None) -> DataFrame:
    """Bundles as ``write_bundles`` wrote them, with ``corrupt``: the line itself where it can't be read, else null.

    ``schema`` is that of the bundles. With ``asked`` (user_id) only these users come back, and only their
    buckets are opened: no more than ``buckets`` numbers reach the driver. A corrupt line belongs to the user
    whose id can still be read from it; without ``asked``, those of nobody come back with a null id.
    """
    extra = [T.StructField("corrupt", T.StringType()), T.StructField("bucket", T.IntegerType())]
    lines = spark.read.schema(T.StructType([*schema.fields, *extra])).option("columnNameOfCorruptRecord", "corrupt").json(path)
    if asked is not None:
        wanted = asked.select("user_id").where("user_id is not null").distinct()
        here = [r[0] for r in wanted.select(bucket_of("user_id", buckets)).distinct().collect()]
        lines = lines.where(F.col("bucket").isin(here))
    left = F.nullif(F.regexp_extract("corrupt", r'"user_id":"((?:[^"\\]|\\.)*)"', 1), F.lit(""))
    left = F.from_json(F.concat(F.lit('{"u":"'), left, F.lit('"}')), "u string")["u"]
    rows = lines.withColumn("user_id", F.coalesce("user_id", left)).drop("bucket")
    return rows if asked is None else rows.join(wanted, "user_id", "left_semi")


def write_by_day(objects: DataFrame, path: str, created: str = "created") -> None:
    """Objects in folders by day of creation; those of unknown age have a folder of their own.

    Rows are dealt by ranges of (day, hash), so that a day with a large share of all rows is written by many tasks.
    """
    dated = objects.withColumn("day", F.date_format(created, "yyyy-MM-dd"))
    placed = dated.repartitionByRange("day", F.xxhash64(*objects.columns))
    placed.write.mode("overwrite").partitionBy("day").parquet(path)


def expire(spark: SparkSession, path: str, now: datetime, ttl_s: int, created: str = "created") -> tuple[list[str], str | None]:
    """Retention of a table of :func:`write_by_day`: (days removed, day rewritten or None).

    Days before the cutoff's are removed without being read. Of the cutoff's own day what is not yet too old is
    stored aside and takes the day's place by dynamic partition overwrite, unless nothing there has expired. Later days
    and objects of unknown age keep their files. Every step can be repeated: a run after a killed one does what is
    left, and a second run changes nothing.
    """
    cutoff = now - timedelta(seconds=ttl_s)
    last = cutoff.strftime("%Y-%m-%d")
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = (status.getPath().getName() for status in files.listStatus(root))
    days = sorted(n.removeprefix("day=") for n in names if re.fullmatch(r"day=\d{4}-\d\d-\d\d", n))
    gone = [day for day in days if day < last]
    for day in gone:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/day={day}"), True)
    if last not in days:
        return gone, None
    at = F.lit(cutoff.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    rows = spark.read.parquet(f"{path}/day={last}")
    if rows.where(F.col(created) < at).isEmpty():
        return gone, None
    kept = materialize(rows.where(F.col(created) >= at))
    if kept.isEmpty():
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/day={last}"), True)
        return [*gone, last], None
    kept.withColumn("day", F.lit(last)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
    return gone, last


def write_catalog(items: DataFrame, name: str, path: str, buckets: int = 256) -> DataFrame:
    """The catalog without bodies as table ``name``, in buckets by item id: joins on it move the other side only.

    Rows are dealt as the buckets are, so a bucket is one file. Choose ``buckets`` by the catalog's size.
    """
    narrow = item_catalog(items, body=False).repartition(buckets, "item_id")
    narrow.write.mode("overwrite").bucketBy(buckets, "item_id").sortBy("item_id").option("path", path).saveAsTable(name)
    return items.sparkSession.table(name)
