"""Test tables in the canonical shapes, for the registered queries.

Each view exists twice: as a DataFrame and, under ``SQL``, as a DuckDB common table
expression over the same parquet tables. Only this data preparation is shared
text; the operators and their expected results are written independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from intentloom.sources.readers import item_catalog, read_table

# column -> expression both engines read the same way
_USERS = {
    "user_id": "cast(c_custkey as string)",
    "preferred_language": (
        "case c_mktsegment when 'BUILDING' then 'en' when 'MACHINERY' then ' en ' "
        "when 'AUTOMOBILE' then 'fr' when 'HOUSEHOLD' then 'th' end"
    ),
    "current_status": (
        "case when c_acctbal < 0 then '' when c_acctbal < 5000 then 'student' end"
    ),
    "student_year": (
        "case when c_custkey % 5 > 0 then concat('year', cast(c_custkey % 5 as string)) end"
    ),
    "faculty_name": "c_mktsegment",
    "curriculum_name": "n_name",
    "university_name": (
        "case when n_regionkey > 0 then concat('University ', cast(n_regionkey as string)) end"
    ),
    "target_roles": (
        "case when c_custkey % 6 = 0 then null when c_custkey % 6 = 1 then ' | ' "
        "else concat(' ', lower(c_mktsegment), ' Lead | |Data ', n_name, '|') end"
    ),
    "skill": (
        "case c_custkey % 4 when 0 then "
        "concat('Python:L', cast(c_nationkey % 3 as string), ';Excel; :L3;', n_name, ' : L2 :x') "
        "when 1 then concat('[{\"skill_id\":\"', cast(c_nationkey as string), "
        "'\",\"skill_name\":\"', n_name, '\",\"skill_level\":\"L1\"},"
        "{\"skill_id\":\"9\",\"skill_name\":\"SQL\",\"skill_level\":\"L2\"}]') "
        "when 2 then '' end"
    ),
    "interests": (
        "case when c_custkey % 3 = 0 then concat(c_mktsegment, '; ;', n_name, ' ') end"
    ),
    "onboard_grp": (
        "case when c_custkey % 7 = 0 then '' when c_custkey % 7 > 1 "
        "then concat('group ', cast(c_nationkey % 4 as string)) end"
    ),
    "onboard_grp_description": (
        "case when c_custkey % 2 = 0 "
        "then concat('balance ', cast(cast(floor(c_acctbal) as bigint) as string)) end"
    ),
}

_ITEMS = {
    "post_id": "cast(10 + cast(floor(p_partkey / 2) as bigint) as string)",
    "post_status": "case when p_size % 2 = 0 then 'PUBLISHED' else 'DRAFT' end",
    "is_valid": "p_size % 3 > 0",
    "post_topic": "case when p_size % 10 > 0 then p_name end",
    "post_content_body": "concat(' ', p_name, '  made by', chr(10), p_brand, ' for a ', p_type, ' order ')",
    "post_tags": "concat('[\"', p_brand, '\",', chr(10), '\"', lower(p_type), '\"]')",
    "post_target_group": "concat('year', cast(p_size % 4 as string))",
    "post_category": "concat('[\"', p_type, '\"]')",
    "num_click": "case when p_size % 4 > 0 then cast(p_size * 100 as bigint) end",
    "num_like": "case when p_size % 5 > 0 then cast(p_size * 10 as bigint) end",
    "num_comment": "cast(p_size as bigint)",
    "num_share": "cast(p_size % 7 as bigint)",
    "num_bookmark": "cast(null as bigint)",
}

_SLOTS = {
    "user_id": "cast(conv_id as string)",
    "query_id": "concat('Q', cast(turn + 1 as string))",
    "query_text": "text",
    "weight": "cast(case when turn < 2 then 1.0 when turn = 2 then 0.8 else 0.6 end as double)",
    "intent_label": (
        "case when turn > 2 then 'ai_exploration' when role = 'user' then 'profile_based' "
        "else 'interaction_secondary' end"
    ),
    "template": "case when conv_id % 2 = 0 then 'profile' else 'interaction' end",
    "language": "case when conv_id % 3 = 0 then 'th' else 'en' end",
    "output_language": "case role when 'user' then 'en' when 'assistant' then 'th' else 'fr' end",
}

_CALLS = {
    "user_id": "cast(user_id as string)",
    "model_name": "event_type",
    "input_tokens": "case when event_id % 10 > 0 then event_id % 1000 end",
    "output_tokens": "case when event_id % 7 > 0 then event_id % 300 end",
    "latency_s": "value / 10",
}


def _columns(parts: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in parts.items()]


def _view(name: str, parts: dict[str, str], source: str) -> str:
    return f"{name} as (select {', '.join(_columns(parts))} from {source})"


SQL = {
    "users": _view("users", _USERS, "customer join nation on c_nationkey = n_nationkey"),
    "ev": (
        "ev as (select cast(user_id as string) as user_id, props->>'k' as item_id, ts, event_type, "
        "cast(floor(value * 1000) as bigint) as dwell_ms from events)"
    ),
    "items": _view(
        "items",
        _ITEMS | {"post_created_at": "timestamp '2024-01-01' + to_minutes(p_partkey)"},
        "part",
    ),
    "catalog": (
        "catalog as (select post_id as item_id, post_status, is_valid, "
        "strftime(post_created_at, '%Y-%m-%dT%H:%M:%SZ') as created_at, post_topic as title, "
        "post_content_body as feed_text, post_tags as tags, post_target_group, post_category, "
        "coalesce(num_click, 0) as views, coalesce(num_like, 0) as like_, "
        "coalesce(num_comment, 0) as comment_, coalesce(num_share, 0) as share_, "
        "coalesce(num_bookmark, 0) as bookmark_ from "
        "(select *, row_number() over (partition by post_id order by post_created_at desc) as rn "
        "from items) where rn = 1)"
    ),
    "slots": _view("slots", _SLOTS, "conversations"),
    "calls": _view("calls", _CALLS, "events"),
}


def with_views(*names: str) -> str:
    """``with ...`` over the named views, in the given order."""
    return "with " + ",\n".join(SQL[n] for n in names) + "\n"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def users(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.selectExpr(*_columns(_USERS))


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("item_id"),
        "ts",
        "event_type",
        F.floor(F.col("value") * 1000).cast("bigint").alias("dwell_ms"),
    )


def items(spark: SparkSession, sf: str) -> DataFrame:
    created = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        mins=F.col("p_partkey").cast("int")
    )
    part = table(spark, sf, "part")
    return part.select(*[F.expr(c) for c in _columns(_ITEMS)], created.alias("post_created_at"))


def catalog(spark: SparkSession, sf: str, body: bool = True) -> DataFrame:
    return item_catalog(items(spark, sf), body)


def slots(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").selectExpr(*_columns(_SLOTS))


def calls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(*_columns(_CALLS))


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("item_id"), F.col("embedding").alias("vector")
    )
