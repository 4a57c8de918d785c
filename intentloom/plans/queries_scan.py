"""Scans, sources and plain projections."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from intentloom.functions import text as X
from intentloom.operators import events as E
from intentloom.operators.bundle import retention_filter as keep_recent
from intentloom.plans.registry import query
from intentloom.sources import readers as R, schemas, sinks, standins as V

NOW = datetime(2024, 1, 31)
PROFILE = (
    "preferred_language", "current_status", "student_year", "faculty_name", "curriculum_name",
    "university_name", "target_roles", "skill", "interests", "onboard_grp",
    "onboard_grp_description",
)


@query(
    V.with_views("users")
    + f"select user_id, {', '.join(f'''coalesce({c}, '') as {c}''' for c in PROFILE)} from users"
)
def scan_users(spark: SparkSession, sf: str) -> DataFrame:
    users = R.scan_users(V.users(spark, sf))
    return users.select("user_id", *[F.coalesce(c, F.lit("")).alias(c) for c in PROFILE])


@query(
    V.with_views("ev")
    + "select user_id, item_id, event_type, dwell_ms, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ts from ev"
)
def user_events(spark: SparkSession, sf: str) -> DataFrame:
    return R.scan_events(V.events(spark, sf)).withColumn("ts", X.iso_z("ts"))


@query(
    V.with_views("ev", "items")
    + "select post_id, post_status, post_target_group from items "
    "where exists (select 1 from ev where ev.item_id = items.post_id)"
)
def items_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    posts = V.items(spark, sf).withColumnRenamed("post_id", "item_id")
    found = R.items_semi_join(posts, V.events(spark, sf))
    return found.select(F.col("item_id").alias("post_id"), "post_status", "post_target_group")


@query(
    V.with_views("items", "catalog")
    + "select item_id, post_status, is_valid, created_at, coalesce(title, '') as title, "
    "feed_text, tags, post_target_group, post_category, views, like_ as \"like\", "
    "comment_ as \"comment\", share_ as \"share\", bookmark_ as bookmark from catalog"
)
def item_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return V.catalog(spark, sf).withColumn("title", F.coalesce("title", F.lit("")))


@query(V.with_views("ev") + "select distinct item_id from ev where item_id is not null")
def distinct_items(spark: SparkSession, sf: str) -> DataFrame:
    return R.distinct_items(V.events(spark, sf))


@query(
    V.with_views("ev")
    + "select user_id, item_id, cast(ts as string) as ts, event_type, "
    "cast(dwell_ms as string) as dwell_ms from ev"
)
def events_as_text(spark: SparkSession, sf: str) -> DataFrame:
    return R.events_as_text(V.events(spark, sf))


@query(
    V.with_views("users")
    + ", asked as (select distinct cast(c_custkey * 2 as string) as user_id from customer) "
    "select user_id, 'Fail' as status, user_id || ' not found' as error from asked "
    "where not exists (select 1 from users where users.user_id = asked.user_id)"
)
def missing_users(spark: SparkSession, sf: str) -> DataFrame:
    asked = V.table(spark, sf, "customer").selectExpr("cast(c_custkey * 2 as string) as user_id")
    return R.missing_users(asked, V.users(spark, sf))


_RAW_ROWS = {
    "user_id": "case when event_id % 11 = 0 then '' else cast(user_id as string) end",
    "item_id": "case when event_id % 13 > 0 then cast(event_id % 100 as string) end",
    "ts": (
        "case when event_id % 17 = 0 then 'yesterday' "
        "else concat('2024-01-0', cast(1 + event_id % 9 as string), ' 10:00:00') end"
    ),
    "event_type": "event_type",
    "dwell_ms": "case when event_id % 19 = 0 then '12x' else cast(event_id as string) end",
}
_RAW = ", ".join(f"{e} as {c}" for c, e in _RAW_ROWS.items())


@query(
    f"with raw as (select {_RAW} from events) "
    "select user_id, coalesce(item_id, '') as item_id, "
    "coalesce(strftime(try_cast(ts as timestamp), '%Y-%m-%dT%H:%M:%SZ'), '') as ts, event_type, "
    "coalesce(try_cast(dwell_ms as bigint), -1) as dwell_ms, "
    "concat_ws('; ', case when user_id = '' then 'user_id missing' end, "
    "case when item_id is null then 'item_id missing' end, "
    "case when try_cast(ts as timestamp) is null then 'ts unreadable' end, "
    "case when try_cast(dwell_ms as bigint) is null then 'dwell_ms unreadable' end) "
    "as reject_reason from raw"
)
def append_validated(spark: SparkSession, sf: str) -> DataFrame:
    raw = V.table(spark, sf, "events").selectExpr(*[f"{e} as {c}" for c, e in _RAW_ROWS.items()])
    checked = sinks.validated(raw, schemas.EVENTS, ("user_id", "item_id"))
    return checked.select(
        "user_id",
        F.coalesce("item_id", F.lit("")).alias("item_id"),
        F.coalesce(X.iso_z("ts"), F.lit("")).alias("ts"),
        "event_type",
        F.coalesce("dwell_ms", F.lit(-1)).alias("dwell_ms"),
        F.coalesce("reject_reason", F.lit("")).alias("reject_reason"),
    )


@query(
    "select event_id from events where event_type = 'error' "
    "or ts >= timestamp '2024-01-31' - interval 864000 seconds"
)
def retention_filter(spark: SparkSession, sf: str) -> DataFrame:
    stored = V.table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("created")
    )
    return keep_recent(stored, NOW, 864000).select("event_id")


@query(
    V.with_views("ev")
    + "select user_id, item_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ts from ev "
    "where ts >= timestamp '2024-01-31' - interval 7 days"
)
def events_in_window(spark: SparkSession, sf: str) -> DataFrame:
    recent = E.events_in_window(V.events(spark, sf), NOW, 7)
    return recent.select("user_id", "item_id", "event_type", X.iso_z("ts").alias("ts"))


_CLEANED = (
    "regexp_replace(trim(regexp_replace(text, '[\\r\\n]', ' ', 'g'), "
    "' ' || chr(9) || chr(11) || chr(12) || chr(160)), ' {2,}', ' ', 'g')"
)


@query(
    f"select doc_id, md5({_CLEANED}) as digest, cast(length({_CLEANED}) as bigint) as n_chars "
    "from documents"
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = V.table(spark, sf, "documents").select("doc_id", X.clean_text("text").alias("c"))
    return cleaned.select(
        "doc_id", F.md5("c").alias("digest"), F.length("c").cast("bigint").alias("n_chars")
    )


@query(
    "select doc_id, case when length(text) <= 60 then text "
    "else regexp_replace(substr(text, 1, 59), '[\\s\\p{Z}]+$', '') || '…' end as short "
    "from documents"
)
def truncate_text(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "documents").select("doc_id", X.truncate_text("text", 60).alias("short"))


_LISTS = (
    "case p_partkey % 6 when 0 then concat('[''', p_brand, ''', \"', p_type, '\"]') "
    "when 1 then concat(' (''', p_brand, ''', ''', p_type, ''') ') "
    "when 2 then concat('[\"', p_name, '\"]') when 3 then concat('[''', p_name, ''', None]') "
    "when 4 then concat('[''', p_name) end"
)


@query(
    "select p_partkey, case p_partkey % 6 when 0 then p_brand || ', ' || p_type "
    "when 1 then p_brand || ', ' || p_type when 2 then p_name when 3 then p_name else '' end as joined, "
    "cast(case p_partkey % 6 when 0 then 2 when 1 then 2 when 2 then 1 when 3 then 1 else 0 end as bigint) "
    "as n from part"
)
def parse_list_column(spark: SparkSession, sf: str) -> DataFrame:
    raw = V.table(spark, sf, "part").selectExpr("p_partkey", f"{_LISTS} as raw")
    parsed = raw.withColumn("a", X.parse_list_column("raw"))
    return parsed.select(
        "p_partkey", F.array_join("a", ", ").alias("joined"), F.size("a").cast("bigint").alias("n")
    )


_TIMES = (
    "case event_id % 5 when 0 then concat(substr(cast(ts as string), 1, 10), 'T', "
    "substr(cast(ts as string), 12, 8), 'Z') "
    "when 1 then concat(' ', substr(cast(ts as string), 1, 19)) "
    "when 2 then concat(substr(cast(ts as string), 1, 10), 'T', "
    "substr(cast(ts as string), 12, 8), '+07:00') "
    "when 3 then 'soon' end"
)


@query(
    "select event_id, coalesce(case event_id % 5 "
    "when 0 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%SZ') "
    "when 2 then strftime(ts - interval 7 hours, '%Y-%m-%dT%H:%M:%SZ') end, '') as iso from events"
)
def parse_ts(spark: SparkSession, sf: str) -> DataFrame:
    raw = V.table(spark, sf, "events").selectExpr("event_id", f"{_TIMES} as raw")
    return raw.select("event_id", F.coalesce(X.iso_z(X.parse_ts("raw")), F.lit("")).alias("iso"))
