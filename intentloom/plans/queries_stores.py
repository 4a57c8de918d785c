"""Tables that jobs keep: interactions, answers, ledgers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from intentloom.functions.offline_models import LEADS, template_generator
from intentloom.operators import answer_store as S, ledger as L, models
from intentloom.params import JobParams
from intentloom.plans import refresh
from intentloom.plans.registry import query
from intentloom.sources import sinks, standins as V

PARAMS = JobParams()
NOW = datetime(2024, 1, 31)

# every third event is one user's
_HOT = "case when event_id % 3 = 0 then '0' else cast(user_id as string) end"


@query(
    f"select user_id, item_id, event_type, dwell_ms, strftime(ts, '%Y-%m-%dT%H:%M:%S') as ts from (select {_HOT} as user_id, "
    "props->>'k' as item_id, ts, event_type, cast(floor(value * 1000) as bigint) as dwell_ms from events) "
    "where user_id in (select cast(c_custkey as string) from customer)"
)
def refresh_interactions(spark: SparkSession, sf: str) -> DataFrame:
    """Interactions of every user through the sink, read back from the files."""
    events = V.table(spark, sf, "events").selectExpr(
        f"{_HOT} as user_id", "get_json_object(props, '$.k') as item_id", "ts", "event_type", "cast(floor(value * 1000) as bigint) as dwell_ms"
    )
    rows = refresh.interactions(V.users(spark, sf), events)
    path = models.new_folder(spark)
    sinks.write_interactions(rows, path, buckets=16)
    back = sinks.read_interactions(spark, path, rows.schema["record"].dataType, 16)
    return back.select("user_id", "record.*").withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))


# the prompts of customers, then those of customers and suppliers: the second run pays for what is new
_MAJOR = {"customer": "concat(c_mktsegment, ' ', n_name)", "supplier": "concat('SUPPLIER ', n_name)"}
_LEAD = LEADS["en"]["Q1"]


def _asked(spark: SparkSession, sf: str, table: str) -> DataFrame:
    nation = V.table(spark, sf, "nation")
    prefix = table[0]
    joined = V.table(spark, sf, table).join(nation, F.col(f"{prefix}_nationkey") == F.col("n_nationkey"))
    prompt = f"concat('Answer language: en', chr(10), 'Profile:', chr(10), 'Major: ', {_MAJOR[table]}, chr(10), 'Q1 | profile_based | 1.0')"
    return joined.selectExpr(f"concat('{prefix}', {prefix}_{'cust' if prefix == 'c' else 'supp'}key) as user_id", f"{prompt} as prompt")


def _answer_sql(major: str) -> str:
    major = f"replace({major}, '_', ' ')"  # the generator keeps letters and digits
    return (
        f"'{{\"output_language\": \"en\", \"queries\": [{{\"query_id\": \"Q1\", \"query_text\": \"{_LEAD} ' || {major} || "
        "'\", \"weight\": 1.0, \"intent_label\": \"profile_based\"}]}'"
    )


@query(
    f"with c as (select 'c' || c_custkey as user_id, {_MAJOR['customer']} as m from customer join nation on c_nationkey = n_nationkey), "
    f"s as (select 's' || s_suppkey as user_id, {_MAJOR['supplier']} as m from supplier join nation on s_nationkey = n_nationkey), "
    "paid as (select m, min(user_id) as payer from c group by m), later as (select m, min(user_id) as payer from s group by m) "
    f"select c.user_id, 'first' as run, false as reused, {_answer_sql('m')} as raw, (c.user_id = payer)::int as calls from c join paid using (m) "
    f"union all select user_id, 'second', true, {_answer_sql('m')}, 0 from c "
    f"union all select s.user_id, 'second', false, {_answer_sql('m')}, (s.user_id = payer)::int from s join later using (m)"
)
def answer_store(spark: SparkSession, sf: str) -> DataFrame:
    path = models.new_folder(spark)
    customers, suppliers = _asked(spark, sf, "customer"), _asked(spark, sf, "supplier")

    def run(name: str, prompts: DataFrame) -> DataFrame:
        store = S.AnswerStore(path, name, NOW, wave_rows=50)
        told = models.materialize(S.stored_answers(prompts, template_generator, PARAMS, store))
        return told.select("user_id", F.lit(name).alias("run"), "reused", "raw", F.size("calls").alias("calls"))

    first = run("first", customers)
    return first.unionByName(run("second", customers.unionByName(suppliers)))


_STAGES = ("view", "click", "signup", "purchase", "error")
_SECONDS = "value / 10"
_FAILED = "event_id % 19 = 3"


def _stage_sql(stage: str) -> str:
    here = f"event_type = '{stage}'"
    bad = f"count(*) filter ({here} and {_FAILED}) > 0 or count(*) filter ({here}) = 0"
    return f"case when {bad} then null else sum(case when {here} then {_SECONDS} * 1000 end) end as {stage}"


@query(
    f"with t as (select cast(user_id as string) as user_id, {', '.join(map(_stage_sql, _STAGES))} from events group by user_id) select user_id, "
    + ", ".join(f"coalesce(cast(cast(round({s}) as bigint) as varchar), '-') as {s}" for s in _STAGES)
    + f", cast(round({' + '.join(f'coalesce({s}, 0)' for s in _STAGES)}) as bigint) as total_ms, '2024-01-31 00:00:00' as logged_at from t"
)
def stage_times(spark: SparkSession, sf: str) -> DataFrame:
    records = V.table(spark, sf, "events").selectExpr(
        "cast(user_id as string) as user_id", "event_type as stage", f"{_SECONDS} as seconds", f"case when {_FAILED} then 'failed' end as error"
    )
    return L.stage_times(records, _STAGES, NOW).withColumn("logged_at", F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss"))


_USAGE = "case event_id % 7 when 0 then null when 1 then replace(props, ': ', ': \"x') when 2 then concat('{', props) else props end"


@query(
    "select event_id, coalesce(case when event_id % 7 in (0, 1, 2) then null else (props->>'k')::bigint end, -1) as tokens, "
    "-1::bigint as missing from events"
)
def token_usage(spark: SparkSession, sf: str) -> DataFrame:
    usage = V.table(spark, sf, "events").selectExpr("event_id", f"{_USAGE} as usage")
    return usage.select(
        "event_id", F.coalesce(L.token_usage("usage", "k"), F.lit(-1)).alias("tokens"), F.coalesce(L.token_usage("usage", "absent"), F.lit(-1)).alias("missing")
    )


@query(
    "select 'llm' as event_type, cast(user_id as string) as user_id, event_type as model_name, "
    "coalesce(case when event_id % 10 > 0 then event_id % 1000 end, -1) as input_tokens, -1::bigint as num_texts, "
    "round(value / 10, 4) as latency_s, '2024-01-31 00:00:00' as logged_at from events "
    "union all select 'embedding', '', lang, -1, count(*), -1, '2024-02-01 00:00:00' from documents group by lang"
)
def ledger_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends at different times to one ledger table, read back whole."""
    path = models.new_folder(spark)
    calls = V.calls(spark, sf).withColumn("event_type", F.lit("llm"))
    sinks.append_ledger(calls, path, NOW)
    embedded = V.table(spark, sf, "documents").groupBy(F.col("lang").alias("model_name")).agg(F.count("*").alias("num_texts"))
    sinks.append_ledger(embedded.withColumn("event_type", F.lit("embedding")), path, datetime(2024, 2, 1))
    rows = spark.read.parquet(path)
    return rows.select(
        "event_type", F.coalesce("user_id", F.lit("")).alias("user_id"), "model_name", F.coalesce("input_tokens", F.lit(-1)).alias("input_tokens"),
        F.coalesce("num_texts", F.lit(-1)).alias("num_texts"), F.coalesce(F.round("latency_s", 4), F.lit(-1.0)).alias("latency_s"),
        F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss").alias("logged_at"),
    )
