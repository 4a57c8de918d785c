"""Appends with rejects, audits of written bundles, retention by day, the narrow catalog: through files and back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from intentloom.functions import text as X
from intentloom.operators import bundle as B, events as E, models
from intentloom.params import SLOTS
from intentloom.plans.queries_bundle import _N_QUERIES, _bundles, _unit
from intentloom.plans.queries_history import PARAMS, RECENT, TITLES
from intentloom.plans.queries_scan import _RAW, _RAW_ROWS
from intentloom.plans.registry import query
from intentloom.sources import schemas, sinks, standins as V, stores as S

_REASON = (
    "nullif(concat_ws('; ', case when user_id = '' then 'user_id missing' end, "
    "case when item_id is null then 'item_id missing' end, "
    "case when try_cast(ts as timestamp) is null then 'ts unreadable' end, "
    "case when try_cast(dwell_ms as bigint) is null then 'dwell_ms unreadable' end), '')"
)
_GIVEN = (
    "'{\"user_id\":\"' || user_id || '\",\"item_id\":' || coalesce('\"' || item_id || '\"', 'null') || ',\"ts\":\"' || ts "
    "|| '\",\"event_type\":\"' || event_type || '\",\"dwell_ms\":\"' || dwell_ms || '\"}'"
)


@query(
    f"with raw as (select {_RAW} from events), r as (select *, {_REASON} as reason from raw) "
    "select 'accepted' as outcome, user_id, item_id, strftime(cast(ts as timestamp), '%Y-%m-%dT%H:%M:%SZ') as ts, "
    "event_type, cast(dwell_ms as bigint) as dwell_ms, '' as reject_reason, '' as given from r where reason is null "
    f"union all select 'rejected', '', '', '', '', -1, reason, {_GIVEN} from r where reason is not null"
)
def append_with_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs into one table, the second written twice: each row is there once, accepted or rejected."""
    raw = V.table(spark, sf, "events").selectExpr("event_id", *[f"{e} as {c}" for c, e in _RAW_ROWS.items()])
    path = models.new_folder(spark)
    for run, half in (("one", 0), ("two", 1), ("two", 1)):
        rows = raw.where(F.col("event_id") % 2 == half).drop("event_id")
        S.append_with_rejects(rows, schemas.EVENTS, ("user_id", "item_id"), path, run)
    good = S.read_accepted(spark, path, schemas.EVENTS).select(
        F.lit("accepted").alias("outcome"), "user_id", "item_id", X.iso_z("ts").alias("ts"), "event_type", "dwell_ms",
        F.lit("").alias("reject_reason"), F.lit("").alias("given"),
    )
    none = [F.lit("").alias(c) for c in ("user_id", "item_id", "ts", "event_type")]
    bad = S.read_rejected(spark, path, schemas.EVENTS)
    return good.unionAll(bad.select(F.lit("rejected"), *none, F.lit(-1).cast("bigint"), "reject_reason", "given"))


# of the customers, those with too few queries fail, some lines are cut off, and some were never written
_CUT, _UNWRITTEN, _BUCKETS = "c_custkey % 16 = 3", "c_custkey % 16 = 7", 16
_QUERIES_JSON = (
    "'[' || array_to_string(['{\"query_id\":\"Q' || i || '\",\"query_text\":\"' || c_mktsegment || ' ' || i || "
    f"'\",\"weight\":1.0,\"intent_label\":\"profile_based\"}}' for i in range(1, {_N_QUERIES} + 1)], ',') || ']'"
)
_FALLBACK = (
    "'{\"user_id\":\"' || a.user_id || '\"' || coalesce(',\"current_status\":\"' || current_status || '\"', '') "
    "|| coalesce(',\"education_level\":\"' || student_year || '\"', '') || ',\"education_major\":\"' "
    "|| concat_ws(' ', faculty_name, curriculum_name, university_name) || '\",\"target_roles\":\"' || coalesce(target_roles, '') "
    "|| '\",\"timezone\":\"UTC\",\"max_output_tokens\":1024,\"feed_text_max_chars\":872,\"temperature\":0.1,\"model_name\":\"m1\"}'"
)


@query(
    V.with_views("users")
    + f", line as (select cast(c_custkey as string) as user_id, case when {_CUT} then 'corrupt' when {_N_QUERIES} < 5 then 'failed' "
    f"else 'stored' end as state, {_N_QUERIES} as n, '{{\"name\":\"' || c_name || '\",\"nation\":' || c_nationkey || '}}' as metadata, "
    f"{_QUERIES_JSON} as queries, {', '.join(f'round({_unit(i, p)}, 5) as {p}{i}' for i in range(1, SLOTS + 1) for p in 'xy')} "
    f"from customer where not ({_UNWRITTEN})), "
    "asked as (select cast(c_custkey as string) as user_id from customer union select cast(c_custkey * 2 as string) from customer), "
    "j as (select a.user_id, coalesce(state, 'absent') as state, state = 'stored' as ok, n, line.metadata, queries, "
    f"users.user_id is not null as known, {_FALLBACK} as fallback, "
    + ", ".join(f"{p}{i}" for i in range(1, SLOTS + 1) for p in "xy")
    + " from asked a left join line on line.user_id = a.user_id left join users on users.user_id = a.user_id) "
    "select user_id, state, case when ok then 'stored' when known then 'profile' else 'none' end as metadata_source, "
    "case when ok then metadata when known then fallback else '{}' end as metadata, case when ok then queries else '' end as queries, "
    "case state when 'failed' then 'bad_query_count: ' || n when 'corrupt' then '{\"user_id\":\"' || user_id || '\"' else '' end as note, "
    "case when state = 'absent' then '|- ' || user_id || ' x' else '|- ' || user_id || ' /' end as first_line, "
    "case when ok then '  |- embedding folder /' else '  |- embedding folder x' end as embedding_line, "
    + ", ".join(f"case when ok then {p}{i} else 0 end as {p}{i}" for i in range(1, SLOTS + 1) for p in "xy")
    + " from j"
)
def stored_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Bundles written, some lines broken, and read back for asked-for users: whole texts and vectors."""
    bundles, path = _bundles(spark, sf).withColumn("c_custkey", F.col("user_id").cast("bigint")), models.new_folder(spark)
    written = bundles.where(f"not ({_UNWRITTEN})")
    sinks.write_bundles(written.where(f"not ({_CUT})").drop("c_custkey"), path, _BUCKETS)
    line = F.to_json(F.struct(*[c for c in bundles.columns if c != "c_custkey"]))
    cut = written.where(_CUT).select(line.alias("line"), sinks.bucket_of("user_id", _BUCKETS).alias("bucket"))
    cut.selectExpr("substring(line, 1, length(line) - 9) as value", "bucket").write.mode("append").partitionBy("bucket").text(path)
    customer = V.table(spark, sf, "customer")
    asked = customer.selectExpr("cast(c_custkey as string) as user_id").union(customer.selectExpr("cast(c_custkey * 2 as string)")).distinct()
    back = S.read_bundles(spark, path, bundles.drop("c_custkey").schema, _BUCKETS, asked)
    audit = B.stored_audit(asked, back, V.users(spark, sf), model_name="m1")
    lines = F.split("report", "\n")
    vectors = [
        F.coalesce(F.round(F.get(f"embeddings.{n}", F.lit(k)).cast("double"), 5), F.lit(0.0)).alias(f"{p}{i}")
        for i, n in enumerate(B.EMBEDDING_NAMES, 1) for k, p in enumerate("xy")
    ]
    return audit.select(
        "user_id", "state", "metadata_source", "metadata", "queries",
        F.when(F.col("state") == "corrupt", F.substring_index("note", ",", 1)).otherwise(F.col("note")).alias("note"),
        lines[0].alias("first_line"), lines[5].alias("embedding_line"), *vectors,
    )


@query(
    "select event_id, coalesce(strftime(case when event_type <> 'error' then ts end, '%Y-%m-%d'), '') as day from events "
    "where event_type = 'error' or ts >= timestamp '2024-01-31 07:30:00' - interval 864000 seconds"
)
def retention_rewrite(spark: SparkSession, sf: str) -> DataFrame:
    """Objects by day, expired twice: the second time nothing is left to do."""
    path = models.new_folder(spark)
    S.write_by_day(V.table(spark, sf, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("created")), path)
    now = datetime(2024, 1, 31, 7, 30)
    S.expire(spark, path, now, 864000)
    S.expire(spark, path, now, 864000)
    return spark.read.parquet(path).select("event_id", F.coalesce(F.date_format("created", "yyyy-MM-dd"), F.lit("")).alias("day"))


@query(V.with_views("ev", "items", "catalog") + f", {RECENT}, {TITLES} select user_id, recent_titles, n_recent from titles")
def titles_from_store(spark: SparkSession, sf: str) -> DataFrame:
    """Latest titles with the catalog kept in buckets, so that only the few rows of each user move."""
    catalog = S.write_catalog(V.items(spark, sf), f"catalog_{uuid.uuid4().hex}", models.new_folder(spark), buckets=16)
    return E.recent_titles(V.events(spark, sf), catalog, PARAMS.recent_k)
