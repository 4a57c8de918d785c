"""Bundles, audits, ledgers and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


from intentloom.operators import bundle as B, context as C, events as E, ledger as L
from intentloom.params import SLOW_CALL_S_BATCH, JobParams
from intentloom.plans.queries_history import COUNTS, LAST20
from intentloom.plans.registry import query
from intentloom.sources import standins as V

PARAMS = JobParams()

_RECORD = (
    "'{\"user_id\":\"' || user_id || '\",\"item_id\":\"' || item_id || '\",\"event_type\":\"' || event_type "
    "|| '\",\"dwell_ms\":' || dwell_ms || ',\"ts\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '\"}'"
)


@query(V.with_views("ev") + f"select user_id, {_RECORD} as record from ev")
def events_json(spark: SparkSession, sf: str) -> DataFrame:
    return E.event_records(V.events(spark, sf)).select("user_id", "record")


@query(
    V.with_views("users", "ev", "items", "catalog")
    + f", {COUNTS}, {LAST20}, records as (select user_id, to_json(list({_RECORD} order by ts)) as v "
    "from ev group by user_id) "
    "select users.user_id, curriculum_name as current_status, coalesce(student_year, '') as education_level, "
    "faculty_name as education_major, coalesce(onboard_grp, '') as target_roles, 'UTC' as timezone, "
    "2048 as max_output_tokens, 240 as feed_text_max_chars, 0.2::double as temperature, "
    "case when n_events < 20 then 'profile' else 'interaction' end as template, "
    "coalesce(recent_tag_interaction, '') as tag_interaction, "
    "coalesce(recent_category_interaction, '') as category_interaction, n_events, "
    "n_events <= 500 as interactions_inline, case when n_events > 500 then '-' "
    "else md5(cast(coalesce(records.v, '[]') as string)) end as interactions "
    "from users join counts on counts.user_id = users.user_id "
    "left join last20 on last20.user_id = users.user_id left join records on records.user_id = users.user_id"
)
def bundle_metadata(spark: SparkSession, sf: str) -> DataFrame:
    events, catalog = V.events(spark, sf), V.catalog(spark, sf, body=False)
    last20 = E.last20_profile(events, catalog)
    features = C.user_features(V.users(spark, sf), events, catalog, last20, PARAMS)
    routed = features.withColumn("template", C.route("n_events", PARAMS.history_threshold))
    made = B.bundle_metadata(routed, events, PARAMS).select("metadata.*")
    texts = ("education_level", "target_roles", "tag_interaction", "category_interaction")
    digest = F.coalesce(F.md5(F.to_json("interactions")), F.lit("-"))
    return (
        made.drop("model_name")
        .withColumns({c: F.coalesce(c, F.lit("")) for c in texts})
        .withColumn("interactions", digest)
    )


# --- bundles: three to six queries per user, vectors from text and place -----

_N_QUERIES = "3 + c_custkey % 4"


def _bundles(spark: SparkSession, sf: str) -> DataFrame:
    queries = F.expr(
        "transform(sequence(1, cast(" + _N_QUERIES + " as int)), i -> named_struct("
        "'query_id', concat('Q', i), 'query_text', concat(c_mktsegment, ' ', i), "
        "'weight', cast(1 as double), 'intent_label', 'profile_based'))"
    )
    parsed = V.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("metadata"),
        queries.alias("queries"),
        F.lit(None).cast("string").alias("error"),
    )
    def direction(q: Column, i: Column) -> Column:
        x, y = F.length(q["query_text"]), i + 1
        size = F.sqrt(x * x + y * y)
        return F.array((x / size).cast("float"), (y / size).cast("float"))

    vectors = F.transform("queries", direction)
    return B.build_bundle(parsed.withColumn("vectors", vectors))


_TEXT_LEN = "(length(c_mktsegment) + 2)"


def _unit(place: int, part: str) -> str:
    top = _TEXT_LEN if part == "x" else str(place)
    return f"{top} / sqrt({_TEXT_LEN} * {_TEXT_LEN} + {place * place})"


@query(
    f"select cast(c_custkey as string) as user_id, case when {_N_QUERIES} < 5 then 'Fail' else 'Complete' end "
    f"as status, case when {_N_QUERIES} < 5 then 'bad_query_count: ' || ({_N_QUERIES}) else '' end as error, "
    f"({_N_QUERIES}) as n_queries, c_name as name, "
    + ", ".join(
        f"case when {_N_QUERIES} < 5 then 0 else round({_unit(i, 'y')}, 5) end as y{i}" for i in range(1, 6)
    )
    + " from customer"
)
def build_bundle(spark: SparkSession, sf: str) -> DataFrame:
    made = _bundles(spark, sf)
    second = [
        F.coalesce(F.round(F.get(f"embeddings.{n}", F.lit(1)).cast("double"), 5), F.lit(0.0)).alias(f"y{i}")
        for i, n in enumerate(B.EMBEDDING_NAMES, 1)
    ]
    return made.select(
        "user_id",
        "status",
        F.coalesce("error", F.lit("")).alias("error"),
        F.size("queries").cast("bigint").alias("n_queries"),
        F.col("metadata.name").alias("name"),
        *second,
    )


_PARTS = "(values ('metadata', 'metadata', 0), ('queries', 'queries', 0), " + ", ".join(
    f"('embedding', 'embedding0{i}', {i})" for i in range(1, 6)
) + ") p(kind, name, place)"


@query(
    "select cast(c_custkey as string) as user_id, kind, name, case kind when 'metadata' then "
    "'{\"name\":\"' || c_name || '\",\"nation\":' || c_nationkey || '}' else '' end as metadata_text, "
    f"case when kind = 'queries' then ({_N_QUERIES}) else 0 end as n_queries, "
    "cast(case when kind = 'embedding' then 2 else 0 end as int) as dim "
    f"from customer, {_PARTS} where {_N_QUERIES} >= 5"
)
def bundle_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    parts = B.bundle_artifacts(_bundles(spark, sf))
    is_metadata, is_list = F.col("kind") == "metadata", F.col("kind") == "queries"
    return parts.select(
        "user_id",
        "kind",
        "name",
        F.when(is_metadata, F.col("text")).otherwise("").alias("metadata_text"),
        F.when(is_list, F.json_array_length("text")).otherwise(0).cast("bigint").alias("n_queries"),
        F.coalesce(F.size("vector"), F.lit(0)).alias("dim"),
    )


# stored parts: some users lose their metadata, their queries, or all embeddings
_LOST = (
    "(kind = 'metadata' and c_custkey % 8 = 2) or (kind = 'queries' and c_custkey % 8 = 3) "
    "or (kind = 'embedding' and c_custkey % 16 = 6) or (name = 'embedding04' and c_custkey % 16 = 7)"
)


def _mark(flag: str) -> str:
    return f"case when coalesce({flag}, false) then '/' else 'x' end"


def _line(depth: int, label: str, flag: str) -> str:
    return f"'{'  ' * depth}|- ' || {label} || ' ' || {_mark(flag)}"


_REPORT = "concat_ws(chr(10), " + ", ".join(
    [
        _line(0, "a.user_id", "n > 0"),
        _line(1, "'metadata folder'", "m"),
        _line(2, "'metadata'", "m"),
        _line(1, "'queries folder'", "q"),
        _line(2, "'queries'", "q"),
        _line(1, "'embedding folder'", "e > 0"),
        *[_line(2, f"'embedding0{i}'", f"e{i}") for i in range(1, 6)],
    ]
) + ")"


@query(
    V.with_views("users")
    + f", stored as (select cast(c_custkey as string) as user_id, kind, name from customer, {_PARTS} "
    f"where {_N_QUERIES} >= 5 and not ({_LOST})), "
    "have as (select user_id, count(*) as n, bool_or(kind = 'metadata') as m, bool_or(kind = 'queries') as q, "
    "count(*) filter (kind = 'embedding') as e, "
    + ", ".join(f"bool_or(name = 'embedding0{i}') as e{i}" for i in range(1, 6))
    + " from stored group by user_id), "
    "asked as (select cast(c_custkey as string) as user_id from customer union "
    "select cast(c_custkey * 2 as string) from customer) "
    "select a.user_id, case when m then 'stored' when users.user_id is not null then 'profile' "
    "else 'none' end as metadata_source, coalesce(q, false) as has_queries, coalesce(e, 0) as n_vectors, "
    f"{_REPORT} as report from asked a left join have on have.user_id = a.user_id "
    "left join users on users.user_id = a.user_id"
)
def bundle_audit(spark: SparkSession, sf: str) -> DataFrame:
    parts = B.bundle_artifacts(_bundles(spark, sf)).withColumn("c_custkey", F.col("user_id").cast("bigint"))
    stored = parts.where(~F.expr(_LOST)).drop("c_custkey")
    customer = V.table(spark, sf, "customer")
    asked = (
        customer.selectExpr("cast(c_custkey as string) as user_id")
        .union(customer.selectExpr("cast(c_custkey * 2 as string)"))
        .distinct()
    )
    audit = B.bundle_audit(asked, stored, V.users(spark, sf))
    filled = sum(
        (F.when(F.size(f"embeddings.{n}") > 0, 1).otherwise(0) for n in B.EMBEDDING_NAMES), F.lit(0)
    )
    return audit.select(
        "user_id",
        "metadata_source",
        (F.col("queries") != "").alias("has_queries"),
        filled.cast("bigint").alias("n_vectors"),
        "report",
    )


# --- ledgers and reports -----------------------------------------------------

_RATES = {"click": (0.0003, 0.0006)}


@query(
    V.with_views("calls")
    + ", t as (select model_name, count(*) as n_calls, "
    "cast(sum(coalesce(input_tokens, 0)) as bigint) as input_tokens, "
    "cast(sum(coalesce(output_tokens, 0)) as bigint) as output_tokens from calls group by model_name) "
    "select *, round(input_tokens / 1000 * case when model_name = 'click' then 0.0003 else 0.0001 end::double "
    "+ output_tokens / 1000 * case when model_name = 'click' then 0.0006 else 0.0002 end::double, 6) "
    "as estimated_cost_usd from t"
)
def llm_cost(spark: SparkSession, sf: str) -> DataFrame:
    costs = L.llm_cost(V.calls(spark, sf), _RATES)
    return costs.withColumn("estimated_cost_usd", F.round("estimated_cost_usd", 6))


@query(
    "with t as (select source, lang as model_name, count(*) as num_texts, "
    "cast(sum(length(text)) as bigint) as total_chars from documents group by source, lang) "
    "select *, round(total_chars / 1000 * case when model_name = 'fr' then 0.0002 else 0.00005 end::double, 6) "
    "as estimated_cost_usd from t"
)
def embedding_cost(spark: SparkSession, sf: str) -> DataFrame:
    texts = V.table(spark, sf, "documents").withColumnRenamed("lang", "model_name")
    costs = L.embedding_cost(texts, "source", {"fr": 0.0002})
    return costs.withColumn("estimated_cost_usd", F.round("estimated_cost_usd", 6))


@query(
    V.with_views("calls")
    + "select 'llm' as event_type, user_id, model_name, coalesce(input_tokens, 0) as input_tokens, "
    "0 as total_chars, round(latency_s, 4) as latency_s from calls union all "
    "select 'embedding', '', lang, 0, length(text), 0.0 from documents"
)
def ledger_union(spark: SparkSession, sf: str) -> DataFrame:
    calls = V.calls(spark, sf).select(
        F.lit("llm").alias("event_type"), "user_id", "model_name", "input_tokens", "latency_s"
    )
    embedded = V.table(spark, sf, "documents").select(
        F.lit("embedding").alias("event_type"),
        F.col("lang").alias("model_name"),
        F.length("text").cast("bigint").alias("total_chars"),
    )
    return L.ledger_union(calls, embedded).select(
        "event_type",
        F.coalesce("user_id", F.lit("")).alias("user_id"),
        "model_name",
        F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"),
        F.coalesce("total_chars", F.lit(0)).alias("total_chars"),
        F.coalesce(F.round("latency_s", 4), F.lit(0.0)).alias("latency_s"),
    )


@query(
    V.with_views("calls")
    + "select user_id, model_name, round(latency_s, 4) as latency_s from calls where latency_s > 20"
)
def slow_calls(spark: SparkSession, sf: str) -> DataFrame:
    slow = L.slow_calls(V.calls(spark, sf), SLOW_CALL_S_BATCH)
    return slow.select("user_id", "model_name", F.round("latency_s", 4).alias("latency_s"))


@query(
    V.with_views("users", "ev", "calls")
    + f", {COUNTS}, worst as (select user_id, max(latency_s) as s from calls group by user_id), "
    "st as (select n_events = 0 as failed, coalesce(s > 20, false) as slow from counts left join worst "
    "on worst.user_id = counts.user_id) "
    "select 'report_240131_0700' as run_name, '2024-01-31T07:00:00+07:00' as generated_at, "
    "count(*) as total_users, count(*) filter (not failed) as updated_count, "
    "count(*) filter (failed) as failed_count, count(*) filter (slow) as slow_count, "
    "12.35::double as total_time_sec from st"
)
def run_report(spark: SparkSession, sf: str) -> DataFrame:
    counts = E.event_counts(V.users(spark, sf), V.events(spark, sf))
    worst = V.calls(spark, sf).groupBy("user_id").agg(F.max("latency_s").alias("s"))
    statuses = counts.join(worst, "user_id", "left").select(
        "user_id",
        F.when(F.col("n_events") == 0, "Fail").otherwise("Complete").alias("status"),
        F.coalesce(F.col("s") > 20, F.lit(False)).alias("slow"),
    )
    return L.run_report(statuses, datetime(2024, 1, 31), 12.345678)
