"""Scans. Filters and projections are left to Catalyst, which pushes them down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from intentloom.functions.text import iso_z
from intentloom.sources import schemas


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """A path with a slash is read as files, anything else as a catalog table."""
    if "/" in source:
        return spark.read.format(fmt).load(source)
    return spark.table(source)


def scan_users(users: DataFrame, user_id: str | None = None) -> DataFrame:
    """All profiles, or one; a repeated id keeps a single row."""
    chosen = users if user_id is None else users.where(F.col("user_id") == user_id)
    return first_per_key(chosen, "user_id")


def scan_events(events: DataFrame, user_id: str | None = None) -> DataFrame:
    return events if user_id is None else events.where(F.col("user_id") == user_id)


def first_per_key(df: DataFrame, key: str, *order: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """One row per key. The limit runs per task before the shuffle, so a key with
    very many rows sends one row per task. Ties end on the hash of the columns
    ``ties``, then on that of all others."""
    by = [F.col(c).desc_nulls_last() for c in order]
    others = [c for c in df.columns if c not in ties]
    w = W.partitionBy(key).orderBy(*by, *[F.xxhash64(*cols) for cols in (ties, others) if cols])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def item_catalog(items: DataFrame, body: bool = True) -> DataFrame:
    """Feed posts under their working names; of repeated ids the newest stays.

    Without ``body`` there is no feed_text, and the scan leaves the bodies out; all else is the same, as ties
    end on the short columns first.
    """
    counts = {
        "views": "num_click",
        "like": "num_like",
        "comment": "num_comment",
        "share": "num_share",
        "bookmark": "num_bookmark",
    }
    short = [f.name for f in schemas.ITEMS.fields if f.name != "post_content_body"]
    newest = first_per_key(items if body else items.select(short), "post_id", "post_created_at", ties=tuple(short))
    return newest.select(
        F.col("post_id").alias("item_id"),
        "post_status",
        "is_valid",
        iso_z("post_created_at").alias("created_at"),
        F.col("post_topic").alias("title"),
        *([F.col("post_content_body").alias("feed_text")] if body else []),
        F.col("post_tags").alias("tags"),
        "post_target_group",
        "post_category",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(name) for name, c in counts.items()],
    )


def items_semi_join(items: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Items whose id is listed. No list at all, or an empty one, means every item."""
    if ids is None:
        return items
    wanted = distinct_items(ids)
    if ids.where("item_id is not null").isEmpty():
        return items
    return items.join(wanted, "item_id", "left_semi")


def events_as_text(events: DataFrame) -> DataFrame:
    return events.select([F.col(c).cast("string").alias(c) for c in events.columns])


def distinct_items(events: DataFrame) -> DataFrame:
    return events.select("item_id").where("item_id is not null").distinct()


def missing_users(wanted: DataFrame, users: DataFrame) -> DataFrame:
    """Asked-for users without a profile, as failed rows."""
    return (
        wanted.select("user_id")
        .distinct()
        .join(users.select("user_id"), "user_id", "left_anti")
        .select(
            "user_id",
            F.lit("Fail").alias("status"),
            F.concat("user_id", F.lit(" not found")).alias("error"),
        )
    )
