"""Finding, repairing and checking model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from intentloom.functions import answers_json as J
from intentloom.operators import answers as A
from intentloom.plans.registry import query
from intentloom.sources import standins as V

# raw text by event, and what must be found in it, known from how it is built
_EXTRACT_RAW = (
    "case event_id % 5 when 0 then concat('note ', props, ' end {\"z\":1}') "
    "when 1 then concat('{\"a\":', props, ',\"s\":\"}{\"} rest}') "
    "when 2 then concat('x {\"q\":\"say \\\\\"}\\\\\" \",\"p\":[', props, ']} {') "
    "when 3 then concat('open {\"a\":', props) else event_type end"
)
# DuckDB keeps backslashes in literals as they are
_EXTRACT_SQL = (
    "case event_id % 5 when 0 then props when 1 then '{\"a\":' || props || ',\"s\":\"}{\"}' "
    "when 2 then '{\"q\":\"say \\\"}\\\" \",\"p\":[' || props || ']}' else '' end"
)


@query(f"select event_id, {_EXTRACT_SQL} as found from events")
def extract_json(spark: SparkSession, sf: str) -> DataFrame:
    raw = V.table(spark, sf, "events").selectExpr("event_id", f"{_EXTRACT_RAW} as raw")
    return raw.select("event_id", F.coalesce(J.extract_json("raw"), F.lit("")).alias("found"))


_CUT = "substr(props, 1, length(props) - 1)"


@query(
    "select event_id, case event_id % 5 when 0 then props when 1 then props "
    "when 2 then '{\"a\":[' || props || ']}' else '' end as closed from events"
)
def autoclose_json(spark: SparkSession, sf: str) -> DataFrame:
    raw = V.table(spark, sf, "events").selectExpr(
        "event_id",
        f"case event_id % 5 when 0 then concat(' ', props) when 1 then {_CUT} "
        f"when 2 then concat('{{\"a\":[', {_CUT}) when 3 then '{{\"a\":\"open' else concat('[', props) end as raw",
    )
    return raw.select("event_id", F.coalesce(J.autoclose_json("raw"), F.lit("")).alias("closed"))


@query(
    "select event_id, case event_id % 7 when 0 then props when 1 then props "
    "when 2 then '{\"a\":' || props || '}' when 3 then props when 6 then props else '' end as answer, "
    "case event_id % 7 when 0 then 'direct' when 1 then 'first_object' when 2 then 'auto_close' "
    "when 3 then 'text_first_object' when 6 then 'parsed' else 'failed' end as resolution from events"
)
def resolve_answers(spark: SparkSession, sf: str) -> DataFrame:
    raw = V.table(spark, sf, "events").selectExpr(
        "event_id",
        f"case event_id % 7 when 0 then concat(props, ' ') when 1 then concat('Sure: ', props, ' bye') "
        f"when 2 then concat('{{\"a\":', {_CUT}) when 3 then concat('[', props, ']') "
        "when 4 then 'no json' end as raw",
        "case when event_id % 7 = 6 then props end as parsed",
    )
    found = A.resolve_answers(raw, parsed="parsed", text="raw")
    return found.select("event_id", F.coalesce("answer", F.lit("")).alias("answer"), "resolution")


_ANSWERS = (
    "case c_custkey % 6 when 0 then concat('{\"queries\":[{\"query_id\":\"Q1\",\"query_text\":\"  ', c_name, "
    "' \",\"weight\":1.0,\"intent_label\":\"profile_based\"},{\"query_id\":\"Q2\",\"query_text\":null}]}') "
    "when 1 then '{\"queries\":[]}' when 2 then concat('{\"queries\":\"', c_name, '\"}') "
    "when 3 then '{\"queries\":[1]}' when 4 then '{\"other\":1}' end"
)


@query(
    "select cast(c_custkey as string) as user_id, s as slot, "
    "case when s > 0 then 'Q' || s else '' end as query_id, "
    "case when s = 1 then c_name else '' end as query_text, "
    "case when s = 1 then 1.0::double else 0.0 end as weight, "
    "case c_custkey % 6 when 2 then 'queries must be a list' "
    "when 3 then 'queries entries must be objects' when 5 then 'no JSON object' else '' end as error "
    "from (select *, unnest(case when c_custkey % 6 = 0 then [1, 2]::int[] else [0]::int[] end) as s from customer)"
)
def explode_queries(spark: SparkSession, sf: str) -> DataFrame:
    answers = V.table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) as user_id", f"{_ANSWERS} as answer"
    )
    rows = A.explode_queries(answers, "queries")
    return rows.select(
        "user_id",
        F.coalesce("slot", F.lit(0)).alias("slot"),
        F.coalesce("query_id", F.lit("")).alias("query_id"),
        F.coalesce("query_text", F.lit("")).alias("query_text"),
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


_SLOT_COUNTS = ", ".join(f"count(*) filter (query_id = 'Q{i}') as q{i}" for i in range(1, 6))


@query(
    V.with_views("slots")
    + f", c as (select user_id, count(query_id) as n_queries, {_SLOT_COUNTS} from slots group by user_id) "
    "select user_id, n_queries, concat_ws(',', "
    + ", ".join(f"case when q{i} = 0 then 'Q{i}' end" for i in range(1, 6))
    + ") as missing_slots, n_queries = 5 and "
    + " and ".join(f"q{i} = 1" for i in range(1, 6))
    + " as ok from c"
)
def check_slots(spark: SparkSession, sf: str) -> DataFrame:
    return A.check_slots(V.slots(spark, sf))


_TRIMMED = "regexp_replace(query_text, '^\\s+|\\s+$', '', 'g')"
_WORDS = f"cast(case when {_TRIMMED} = '' then 0 else len(regexp_split_to_array({_TRIMMED}, '\\s+')) end as bigint)"


@query(
    V.with_views("slots")
    + f", n as (select *, {_WORDS} as n_words, length({_TRIMMED}) as n_chars from slots) "
    "select user_id, query_id, n_words, n_chars, case when language = 'en' "
    "then n_words between 6 and 12 else n_chars between 25 and 70 end as ok from n"
)
def check_length(spark: SparkSession, sf: str) -> DataFrame:
    return A.check_length(V.slots(spark, sf))


_SAME = "lower(regexp_replace(trim(regexp_replace(query_text, '[\\r\\n]', ' ', 'g')), ' {2,}', ' ', 'g'))"


@query(
    V.with_views("slots")
    + ", w as (select user_id, "
    + ", ".join(f"max({_SAME}) filter (query_id = 'Q{i}') as q{i}" for i in (1, 2, 4, 5))
    + " from slots group by user_id) select user_id, coalesce(q1 <> q2, true) as q1_q2_differ, "
    "coalesce(q4 <> q5, true) as q4_q5_differ from w"
)
def check_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return A.check_distinct(V.slots(spark, sf))


@query(
    V.with_views("slots")
    + "select user_id, query_id, template, query_id <= 'Q5' as slot_known, "
    "query_id <= 'Q5' and weight = case query_id when 'Q1' then 1.0 when 'Q2' then 1.0 "
    "when 'Q3' then case template when 'profile' then 1.0 else 0.8 end else 0.6 end as weight_ok, "
    "query_id <= 'Q5' and intent_label = case when query_id >= 'Q4' then 'ai_exploration' "
    "when template = 'profile' or query_id = 'Q3' then 'profile_based' "
    "when query_id = 'Q1' then 'interaction_primary' else 'interaction_secondary' end as label_ok "
    "from slots"
)
def check_slot_plan(spark: SparkSession, sf: str) -> DataFrame:
    return A.check_slot_plan(V.slots(spark, sf), A.slot_plan_table(spark))


@query(
    V.with_views("slots")
    + "select user_id, query_id, not regexp_matches(query_text, '[\\p{P}[:punct:]]') as ok from slots"
)
def check_style(spark: SparkSession, sf: str) -> DataFrame:
    return A.check_style(V.slots(spark, sf))


@query(
    V.with_views("slots")
    + "select user_id, query_id, output_language in ('th', 'en') as allowed, "
    "output_language in ('th', 'en') and output_language = language as ok from slots"
)
def check_language(spark: SparkSession, sf: str) -> DataFrame:
    return A.check_language(V.slots(spark, sf))
