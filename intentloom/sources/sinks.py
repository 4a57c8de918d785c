"""Appends, bundle and report sinks, retention. Files are written by the tasks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from intentloom.operators.ledger import run_report
from intentloom.operators.models import materialize
from intentloom.sources import schemas


def validated(rows: DataFrame, schema: T.StructType, required: tuple[str, ...], given: str | None = None) -> DataFrame:
    """Typed columns plus ``reject_reason``: null for a row that may be appended.

    ``rows`` holds text columns; a value its column's type cannot read, or a
    missing required one, rejects the row. ``given`` names a further column that
    holds the whole row as it came, as JSON, where it is rejected.
    """
    missing = [f.name for f in schema.fields if f.name not in rows.columns]
    if missing:
        raise ValueError(f"rows to append lack {', '.join(missing)}")

    def reason(f: T.StructField) -> Column:
        value = F.col(f.name)
        bad = F.when(
            value.isNotNull() & value.try_cast(f.dataType).isNull(), F.concat(F.lit(f.name), F.lit(" unreadable"))
        )
        if f.name in required:
            bad = F.when(value.isNull() | (value == ""), F.lit(f"{f.name} missing")).otherwise(bad)
        return bad

    reasons = F.concat_ws("; ", *[reason(f) for f in schema.fields])
    as_given = [] if given is None else [
        F.when(reasons != "", F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).alias(given)
    ]
    return rows.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields],
        F.nullif(reasons, F.lit("")).alias("reject_reason"),
        *as_given,
    )


def append_validated(
    rows: DataFrame, schema: T.StructType, required: tuple[str, ...], path: str
) -> None:
    """Append all rows or none: any rejected row raises, naming a few of them. ``rows`` is evaluated once."""
    checked = materialize(validated(rows, schema, required))
    rejected = checked.where("reject_reason is not null")
    counts = rejected.agg(F.count("*").alias("n"), F.max("reject_reason").alias("example")).first()
    if counts.n:
        raise ValueError(f"{counts.n} rows rejected, for example: {counts.example}")
    checked.drop("reject_reason").write.mode("append").parquet(path)


def append_ledger(records: DataFrame, path: str, logged_at: datetime | None = None) -> None:
    """Adds files only; earlier records are not read or rewritten. All records of a call have one time, ``logged_at``."""
    ledger_records(records, logged_at).write.mode("append").parquet(path)


def ledger_records(records: DataFrame, logged_at: datetime | None) -> DataFrame:
    """Records in the ledger's columns and types; what a record lacks is null."""
    moment = None if logged_at is None else logged_at.strftime("%Y-%m-%d %H:%M:%S.%f")
    dated = records if moment is None else records.withColumn("logged_at", F.lit(moment).cast("timestamp_ntz"))
    return dated.select(
        *[(F.col(f.name) if f.name in dated.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.LEDGER.fields]
    )


def write_bundles(
    bundles: DataFrame, path: str, buckets: int = 256, files_per_bucket: int = 1, fmt: str = "json"
) -> None:
    """One row per user under hash buckets, so that a read for one user opens one
    bucket. User ids are unique, so the ``buckets * files_per_bucket`` write tasks
    are even; raise either with the data."""
    spread = F.pmod(F.xxhash64("user_id", F.lit("file")), F.lit(files_per_bucket))
    placed = bundles.withColumn("bucket", bucket_of("user_id", buckets)).repartition(
        buckets * files_per_bucket, "bucket", spread
    )
    options = {"ignoreNullFields": "false"} if fmt == "json" else {}
    placed.write.mode("overwrite").partitionBy("bucket").options(**options).format(fmt).save(path)


def write_interactions(interactions: DataFrame, path: str, buckets: int = 256, tasks: int | None = None) -> None:
    """One JSON line for each interaction (user_id, record), under the buckets of :func:`write_bundles`.

    Rows are dealt to tasks by ranges of (bucket, user, time) and streamed to files in that order, so no
    user is gathered, and one with a large share of all interactions has several files one after the other.
    Within a bucket, files in name order hold each user's records together, oldest first.
    """
    by = ["bucket", "user_id", "ts", "tie"]
    rows = interactions.select(
        "user_id", "record", bucket_of("user_id", buckets).alias("bucket"), F.col("record.ts").alias("ts"), F.xxhash64("record").alias("tie")
    )
    dealt = rows.repartitionByRange(*by) if tasks is None else rows.repartitionByRange(tasks, *by)
    sorted_rows = dealt.sortWithinPartitions(*by).select("user_id", "record", "bucket")
    sorted_rows.write.mode("overwrite").partitionBy("bucket").option("ignoreNullFields", "false").json(path)


def read_interactions(spark: SparkSession, path: str, record: T.DataType, buckets: int = 256, user_id: str | None = None) -> DataFrame:
    """(user_id, record) as written; for one user only that user's bucket is read."""
    schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("record", record), T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(schema).json(path)
    if user_id is not None:
        here = spark.range(1).select(bucket_of(F.lit(user_id), buckets)).first()[0]
        rows = rows.where((F.col("bucket") == here) & (F.col("user_id") == user_id))
    return rows.select("user_id", "record")


def write_refreshed(done, path: str, logged_at: datetime, buckets: int = 256) -> None:
    """All tables of a refresh: bundles, every user's interactions, statuses, and the ledger, which is added to."""
    write_bundles(done.bundles, f"{path}/bundles", buckets)
    write_interactions(done.interactions, f"{path}/interactions", buckets)
    done.statuses.write.mode("overwrite").parquet(f"{path}/statuses")
    append_ledger(done.ledger, f"{path}/ledger", logged_at)


def bucket_of(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_report(statuses: DataFrame, path: str, generated_at, total_time_sec: float) -> None:
    """Counters as one JSON row beside the per-user, failed and slow tables."""
    run_report(statuses, generated_at, total_time_sec).coalesce(1).write.mode("overwrite").json(
        f"{path}/run_metadata"
    )
    for name, part in (
        ("users", statuses),
        ("failed", statuses.where("status <> 'Complete'")),
        ("slow", statuses.where("slow")),
    ):
        part.write.mode("overwrite").json(f"{path}/{name}")
