"""Interaction features: counts, windows, latest distinct items, seen items.

Heavy users: rankings fold (user, item) with a map-side partial aggregate where
they can, and keep row_number <= K. Spark applies such a limit per task before
the shuffle (WindowGroupLimit), so one user with a third of all rows sends at
most K rows per task to the final ranking. Where whole groups are gathered,
:func:`hot_keys` takes the largest ones out first.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from intentloom.functions.text import clean_text, iso_z, strip, truncate_text
from intentloom.params import LAST_N, RECENT_BLOCK_HEADER


def _ntz(moment: datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def hot_keys(
    counts: DataFrame, key: str, n: str, most: int = 100_000, above: int = 0
) -> DataFrame:
    """Keys that hold more than one row in ``most`` of all rows, and more than ``above``.

    No more than ``most`` such keys can exist, so the result may be broadcast
    whatever the size of the data. ``counts`` has one row per key.
    """
    total = counts.agg(F.sum(n)).scalar()
    return counts.where((F.col(n) > above) & (F.col(n) * most > total)).select(key)


def counts_per_user(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.count("*").alias("n_events"))


def event_counts(users: DataFrame, events: DataFrame) -> DataFrame:
    return users.join(counts_per_user(events), "user_id", "left").select(
        "user_id", F.coalesce("n_events", F.lit(0)).alias("n_events")
    )


def events_in_window(events: DataFrame, now: datetime, days: int | None) -> DataFrame:
    """The last ``days`` days up to ``now``; no positive number means no filter."""
    if days is None or days <= 0 or "ts" not in events.columns:
        return events
    return events.where(F.col("ts") >= _ntz(now) - F.expr(f"interval {int(days)} days"))


def _ranked(df: DataFrame, key: str, k: int, *order: Column) -> DataFrame:
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)


def recent_items(events: DataFrame, k: int) -> DataFrame:
    """Latest ``k`` distinct items of each user; unreadable times come last."""
    last = (
        events.where("item_id is not null")
        .groupBy("user_id", "item_id")
        .agg(F.max("ts").alias("last_ts"))
    )
    return _ranked(last, "user_id", k, F.desc_nulls_last("last_ts"), F.asc("item_id"))


def join_list(value: str, order: str = "rk", sep: str = ", ") -> Column:
    """Values of a group in rank order as one text; for groups of at most K rows."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(value).alias("v"))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), sep)


def recent_titles(events: DataFrame, catalog: DataFrame, k: int) -> DataFrame:
    """One text per user: the titles of the latest items, the id where none is known."""
    named = (
        recent_items(events, k)
        .join(catalog.select("item_id", "title"), "item_id", "left")
        .withColumn("title", F.coalesce("title", "item_id"))
    )
    return named.groupBy("user_id").agg(
        join_list("title").alias("recent_titles"), F.count("*").alias("n_recent")
    )


def recent_block(
    events: DataFrame, catalog: DataFrame, languages: DataFrame, k: int, max_chars: int
) -> DataFrame:
    """Text block of the latest ``k`` items that have metadata, with snippets.

    ``catalog`` may have ``summary`` and ``content``; ``feed_text`` is the content
    of the live catalog. ``languages`` holds one row per user.
    """
    seen = (
        events.where("ts is not null")
        .select("user_id", strip("item_id").alias("item_id"), "ts")
        .where("item_id <> ''")
        .groupBy("user_id", "item_id")
        .agg(F.max("ts").alias("last_ts"))
        .join(catalog.select("item_id"), "item_id", "left_semi")
    )
    chosen = _ranked(seen, "user_id", k, F.desc("last_ts"), F.asc("item_id"))

    def text(name: str) -> Column:
        return clean_text(name) if name in catalog.columns else F.lit("")

    content = "content" if "content" in catalog.columns else "feed_text"
    title = clean_text("title")
    body = F.coalesce(F.nullif(text("summary"), F.lit("")), F.nullif(text(content), F.lit("")), title)
    # Only ids travel through the ranking; texts join the K survivors.
    details = catalog.select(
        "item_id",
        F.concat_ws(" | ", F.col("item_id"), title, truncate_text(body, max_chars)).alias("detail"),
    )
    lines = chosen.join(details, "item_id").withColumn(
        "line", F.concat(F.lit("- ("), F.col("rk").cast("string"), F.lit(") "), "detail")
    )
    blocks = lines.groupBy("user_id").agg(join_list("line", sep="\n").alias("lines"))
    header = F.when(F.col("language") == "en", RECENT_BLOCK_HEADER["en"]).otherwise(
        RECENT_BLOCK_HEADER["th"]
    )
    return languages.join(blocks, "user_id").select(
        "user_id", F.concat(header, F.lit("\n"), "lines").alias("recent_block")
    )


def seen_items(
    events: DataFrame,
    *,
    event_types: Iterable[str] | None = None,
    now: datetime | None = None,
    window_days: int | None = None,
    max_unique: int | None = None,
) -> DataFrame:
    """(user, item) pairs already interacted with, optionally the latest only."""
    df = events.withColumn("item_id", strip("item_id")).where("item_id <> ''")
    if event_types is not None and "event_type" in df.columns:
        allowed = sorted({t.lower().strip() for t in event_types if t.strip()})
        # an allow-list without entries keeps nothing
        df = df.where(F.lower(strip("event_type")).isin(allowed) if allowed else F.lit(False))
    if window_days is not None and window_days > 0:
        if now is None:
            raise ValueError("a window needs the job's reference time")
        df = events_in_window(df, now, window_days)
    if max_unique is not None and max_unique > 0 and "ts" in df.columns:
        latest = recent_items(df.where("ts is not null"), max_unique)
        return latest.select("user_id", "item_id")
    return df.select("user_id", "item_id").distinct()


def exclude_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    return candidates.join(seen, ["user_id", "item_id"], "left_anti")


def event_records(events: DataFrame) -> DataFrame:
    """One JSON record per interaction with an ISO time, never gathered per user."""
    fields = [F.col(c) for c in events.columns if c != "ts"]
    record = F.to_json(F.struct(*fields, iso_z("ts").alias("ts")), {"ignoreNullFields": "false"})
    return events.select(*events.columns, record.alias("record"))


def last20_profile(events: DataFrame, catalog: DataFrame, n: int = LAST_N) -> DataFrame:
    """What the latest ``n`` interactions touched: titles, tags, categories, search words.

    Titles and words keep recency order, tags and categories are sorted; all are
    distinct. The lists are JSON text, a form :func:`parse_list_column` reads.
    Search words come from a ``keyword`` column where the events have one.
    """
    keyword = F.lower("keyword") if "keyword" in events.columns else F.lit(None).cast("string")
    latest = _ranked(
        events.select("user_id", "item_id", "ts", "event_type", keyword.alias("word")),
        "user_id",
        n,
        F.desc_nulls_last("ts"),
        F.asc("item_id"),
        F.asc("event_type"),
    )
    single_quotes = {"allowSingleQuotes": "true"}
    facts = catalog.select(
        "item_id",
        F.lower("title").alias("title"),
        F.from_json("tags", "array<string>", single_quotes).alias("tags"),
        F.from_json("post_category", "array<string>", single_quotes).alias("categories"),
    )

    def ranked_list(value: str) -> Column:
        rows = F.collect_list(F.when(F.col(value).isNotNull(), F.struct("rk", value)))
        return F.array_distinct(F.transform(F.array_sort(rows), lambda r: r[value]))

    def sorted_set(value: str) -> Column:
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(value))))

    # at most n rows per user reach this aggregate
    lists = (
        latest.join(facts, "item_id", "left")
        .groupBy("user_id")
        .agg(
            ranked_list("title").alias("recent_post_interaction"),
            sorted_set("tags").alias("recent_tag_interaction"),
            sorted_set("categories").alias("recent_category_interaction"),
            ranked_list("word").alias("recent_keyword_search"),
        )
    )
    return lists.select(
        "user_id", *[F.to_json(c).alias(c) for c in lists.columns if c != "user_id"]
    )
