"""User context, history text, prompts, and the refresh of all or some users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from intentloom.functions import text as X
from intentloom.functions.offline_models import (
    FOCUS_CHARS,
    FOCUS_WORDS,
    LEADS,
    hashing_embedder,
    template_generator,
)
from intentloom.operators import answers as A, context as C, events as E
from intentloom.operators.models import generate_answers as run_generator
from intentloom.params import (
    CONTEXT_FORMAT,
    HISTORY_FORMAT,
    SLOT_PLANS,
    TEMPLATES,
    JobParams,
)
from intentloom.plans import refresh
from intentloom.plans.queries_history import COUNTS, LANG, LAST20, RECENT, TITLES
from intentloom.plans.registry import query
from intentloom.sources import standins as V

PARAMS = JobParams(output_dim=64)
EMBED_DIM = 96


def _flat(fmt: str) -> str:
    return fmt.replace("%s", "{}").replace("%d", "{}")


# --- profile parsing ---------------------------------------------------------

_ROLES = (
    "roles as (select user_id, r, row_number() over (partition by user_id order by i) as priority "
    "from (select user_id, trim(r) as r, i from (select user_id, "
    "unnest(string_split(target_roles, '|')) as r, "
    "generate_subscripts(string_split(target_roles, '|'), 1) as i from users)) where r <> '')"
)
_SKILLS = (
    "skills as (select user_id, i, trim(string_split(s, ':')[1]) as name, "
    "coalesce(trim(string_split(s, ':')[2]), 'unknown') as level, "
    "replace(lower(trim(string_split(s, ':')[1])), ' ', '_') as id from "
    "(select user_id, unnest(string_split(skill, ';')) as s, "
    "generate_subscripts(string_split(skill, ';'), 1) as i from users where skill not like '[%') "
    "where trim(s) <> '' union all "
    "select user_id, i, o->>'skill_name', o->>'skill_level', o->>'skill_id' from "
    "(select user_id, unnest(cast(skill as json[])) as o, "
    "generate_subscripts(cast(skill as json[]), 1) as i from users where skill like '[%'))"
)
_INTERESTS = (
    "interests as (select user_id, trim(x) as x, i from (select user_id, "
    "unnest(string_split(interests, ';')) as x, "
    "generate_subscripts(string_split(interests, ';'), 1) as i from users) where trim(x) <> '')"
)
_MAJOR = "concat_ws(' ', faculty_name, curriculum_name, university_name)"
_CONTEXT = f"""context as (
  with role_text as (select user_id, string_agg(r, ', ' order by priority) as v from roles group by user_id)
  select users.user_id, format(case when {LANG} = 'en' then '{_flat(CONTEXT_FORMAT['en'])}'
    else '{_flat(CONTEXT_FORMAT['th'])}' end, {_MAJOR}, coalesce(role_text.v, 'ไม่ระบุ'),
    coalesce(nullif(trim(skill), ''), 'ไม่ระบุ'), coalesce(nullif(onboard_grp, ''), 'NA'),
    coalesce(onboard_grp_description, '')) as context_text
  from users left join role_text on role_text.user_id = users.user_id)"""


@query(
    V.with_views("users")
    + f", {_ROLES} select user_id, replace(lower(r), ' ', '_') as role_id, r as role_name, "
    "priority from roles"
)
def parse_roles(spark: SparkSession, sf: str) -> DataFrame:
    parsed = V.users(spark, sf).select("user_id", F.inline(X.parse_roles("target_roles")))
    return parsed.withColumn("priority", F.col("priority").cast("bigint"))


@query(
    V.with_views("users")
    + f", {_SKILLS} select user_id, id as skill_id, name as skill_name, level as proficiency from skills"
)
def parse_skills(spark: SparkSession, sf: str) -> DataFrame:
    return V.users(spark, sf).select("user_id", F.inline(X.parse_skills("skill")))


@query(
    V.with_views("users")
    + f", {_INTERESTS} select user_id, x as interest from interests"
)
def parse_interests(spark: SparkSession, sf: str) -> DataFrame:
    parsed = X.parse_interests("interests")
    return V.users(spark, sf).select("user_id", F.explode(parsed).alias("interest"))


@query(
    V.with_views("users")
    + f", {_ROLES}, {_SKILLS}, {_INTERESTS} "
    f"select user_id, {LANG} as preferred_language, "
    "coalesce(nullif(current_status, ''), 'unknown') as current_status, "
    f"coalesce(student_year, 'unknown') as level, {_MAJOR} as major, "
    "coalesce((select string_agg(r, '|' order by priority) from roles r where r.user_id = u.user_id), '') as roles, "
    "coalesce((select string_agg(id || '=' || level, '|' order by i) from skills s where s.user_id = u.user_id), '') as skills, "
    "coalesce((select string_agg(x, '|' order by i) from interests t where t.user_id = u.user_id), '') as interests, "
    "coalesce(nullif(onboard_grp, ''), 'NA') as onboard_grp, "
    "coalesce(onboard_grp_description, '') as onboard_grp_description from users u"
)
def user_context(spark: SparkSession, sf: str) -> DataFrame:
    c = C.user_context(V.users(spark, sf)).select("context.*")
    return c.select(
        "user_id",
        "preferred_language",
        "current_status",
        "education.*",
        F.array_join("target_roles.role_name", "|").alias("roles"),
        F.array_join(
            F.transform("skills", lambda s: F.concat(s["skill_id"], F.lit("="), s["proficiency"])), "|"
        ).alias("skills"),
        F.array_join("interests", "|").alias("interests"),
        "onboard_grp",
        "onboard_grp_description",
    )


@query(V.with_views("users") + f", {_ROLES}, {_CONTEXT} select user_id, context_text from context")
def user_context_text(spark: SparkSession, sf: str) -> DataFrame:
    return C.user_context(V.users(spark, sf)).select("user_id", "context_text")


# --- history and prompts -----------------------------------------------------

_FEATURE_VIEWS = (
    V.with_views("users", "ev", "items", "catalog") + f", {COUNTS}, {RECENT}, {TITLES}, {LAST20}"
)


def _listed(c: str) -> str:
    return f"coalesce(array_to_string(cast({c} as json)->>'$[*]', ', '), '')"


_HISTORY = """history as (select users.user_id, case when n_events = 0 or last20.user_id is null then ''
  when {lang} = 'en' then format('{en}', 30, {lists}) else format('{th}', {lists}) end as history_text
  from users join counts on counts.user_id = users.user_id
  left join titles on titles.user_id = users.user_id
  left join last20 on last20.user_id = users.user_id)""".format(
    lang=LANG,
    en=_flat(HISTORY_FORMAT["en"]),
    th=_flat(HISTORY_FORMAT["th"]),
    lists=", ".join(
        [
            _listed("recent_post_interaction"),
            _listed("recent_tag_interaction"),
            _listed("recent_category_interaction"),
            _listed("recent_keyword_search"),
            "coalesce(recent_titles, '')",
        ]
    ),
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PROMPTS = (
    "prompts as (select users.user_id, case when n_events < 20 then 'profile' else 'interaction' end "
    "as template, "
    f"{LANG} as language, replace(replace(replace(case when n_events < 20 "
    f"then {_quoted(TEMPLATES['profile'])} else {_quoted(TEMPLATES['interaction'])} end, "
    f"'{{{{preferred_language}}}}', {LANG}), '{{{{UserContextText}}}}', context_text), "
    "'{{HistorySummaryText}}', history_text) as prompt from users "
    "join counts on counts.user_id = users.user_id "
    "join context on context.user_id = users.user_id "
    "join history on history.user_id = users.user_id)"
)
_PROMPT_VIEWS = f"{_FEATURE_VIEWS}, {_ROLES}, {_CONTEXT}, {_HISTORY}, {_PROMPTS}"


def _inputs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    events, catalog = V.events(spark, sf), V.catalog(spark, sf, body=False)
    return {
        "users": V.users(spark, sf),
        "events": events,
        "catalog": catalog,
        "last20": E.last20_profile(events, catalog),
    }


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return C.user_features(**_inputs(spark, sf), params=PARAMS)


@query(
    _FEATURE_VIEWS
    + " select users.user_id, n_events, coalesce(recent_titles, '') as recent_titles, "
    "coalesce(recent_tag_interaction, '') as recent_tag_interaction, "
    "last20.user_id is not null as has_last20 from users "
    "join counts on counts.user_id = users.user_id left join titles on titles.user_id = users.user_id "
    "left join last20 on last20.user_id = users.user_id"
)
def user_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).select(
        "user_id",
        "n_events",
        F.coalesce("recent_titles", F.lit("")).alias("recent_titles"),
        F.coalesce("recent_tag_interaction", F.lit("")).alias("recent_tag_interaction"),
        "has_last20",
    )


@query(_FEATURE_VIEWS + f", {_HISTORY} select user_id, history_text from history")
def history_summary(spark: SparkSession, sf: str) -> DataFrame:
    return C.history_summary(_features(spark, sf), PARAMS.window_days)


def _prompts(spark: SparkSession, sf: str) -> DataFrame:
    return C.render_prompts(_features(spark, sf), PARAMS)


@query(_PROMPT_VIEWS + " select user_id, template, language, prompt from prompts")
def render_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return _prompts(spark, sf).select("user_id", "template", "language", "prompt")


# --- model stages with the offline defaults ----------------------------------


def _lead_rows() -> str:
    rows = [(lang, slot, lead) for lang, leads in LEADS.items() for slot, lead in leads.items()]
    return ", ".join(f"('{lang}', '{slot}', '{lead}')" for lang, slot, lead in rows)


def _plan_rows() -> str:
    rows = [(t, *slot) for t, plan in SLOT_PLANS.items() for slot in plan]
    return ", ".join(f"('{t}', '{slot}', '{label}', {weight})" for t, slot, label, weight in rows)


_GENERATED = (
    f"leads as (select * from (values {_lead_rows()}) v(language, slot, lead)), "
    f"plans as (select * from (values {_plan_rows()}) v(template, slot, label, weight)), "
    "words as (select prompts.*, trim(regexp_replace(" + _MAJOR + ", '[^A-Za-z0-9]+', ' ', 'g')) as w "
    "from prompts join users on users.user_id = prompts.user_id), "
    "generated as (select user_id, words.template, words.language, plans.slot, label, weight, "
    "trim(lead || ' ' || case when words.language = 'en' then array_to_string("
    f"list_slice(string_split(w, ' '), 1, {FOCUS_WORDS}), ' ') else trim(substr(w, 1, {FOCUS_CHARS})) end) "
    "as query_text from words join plans on plans.template = words.template "
    "join leads on leads.language = words.language and leads.slot = plans.slot)"
)


@query(
    f"{_PROMPT_VIEWS}, {_GENERATED} select user_id, language as output_language, slot as query_id, "
    "query_text, cast(weight as double) as weight, label as intent_label, 1 as attempts "
    "from generated"
)
def generate_answers(spark: SparkSession, sf: str) -> DataFrame:
    made = run_generator(_prompts(spark, sf), template_generator, PARAMS)
    found = A.resolve_answers(made, text="raw")
    return A.parse_queries(found, PARAMS.answer_field).select(
        "user_id",
        F.get_json_object("answer", "$.output_language").alias("output_language"),
        F.size("calls").alias("attempts"),
        F.inline("queries"),
    )


def _refreshed(job, spark: SparkSession, sf: str, **more: DataFrame) -> refresh.Refreshed:
    return job(
        **more,
        **_inputs(spark, sf),
        generator=template_generator,
        embedder=hashing_embedder(EMBED_DIM),
        params=PARAMS,
    )


def _summary(done: refresh.Refreshed) -> DataFrame:
    """Bundles with nested parts flattened."""
    first = F.col("embeddings.embedding01")
    squares = F.aggregate(first, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    return done.bundles.select(
        "user_id",
        "status",
        F.coalesce("error", F.lit("")).alias("error"),
        F.coalesce("metadata.template", F.lit("")).alias("template"),
        F.coalesce("metadata.n_events", F.lit(0)).alias("n_events"),
        F.coalesce(F.size("metadata.interactions"), F.lit(0)).cast("bigint").alias("n_inline"),
        F.coalesce(F.array_join("queries.query_text", "|"), F.lit("")).alias("texts"),
        F.coalesce(F.size(first), F.lit(0)).cast("bigint").alias("dim"),
        F.coalesce(F.round(squares, 4), F.lit(0.0)).alias("norm"),
    )


# Norms are 1, or 0 where all tokens of a text fall beyond the cut.
_BUCKETS = (
    "tokens as (select user_id, unnest(string_split(lower(query_text), ' ')) as token from generated "
    "where slot = 'Q1'), sums as (select user_id, bucket, sum(sign) as v from (select user_id, "
    f"('0x' || substr(md5(token), 1, 8))::bigint % {EMBED_DIM} as bucket, "
    "case when substr(md5(token), 9, 1) < '8' then 1 else -1 end as sign from tokens) "
    "group by user_id, bucket), "
    f"norms as (select user_id, max(case when bucket < {PARAMS.output_dim} and v <> 0 then 1.0 else 0.0 end) "
    "as norm from sums group by user_id)"
)
_REFRESHED = (
    f"{_PROMPT_VIEWS}, {_GENERATED}, {_BUCKETS}, done as (select generated.user_id, "
    "any_value(template) as template, string_agg(query_text, '|' order by slot) as texts "
    "from generated group by generated.user_id), "
    "refreshed as (select done.user_id, 'Complete' as status, '' as error, template, n_events, "
    f"n_events as n_inline, texts, cast({PARAMS.output_dim} as bigint) as dim, "
    "cast(norm as double) as norm from done "
    "join counts on counts.user_id = done.user_id join norms on norms.user_id = done.user_id)"
)


@query(f"{_REFRESHED} select * from refreshed")
def refresh_all(spark: SparkSession, sf: str) -> DataFrame:
    return _summary(_refreshed(refresh.refresh_all, spark, sf))


@query(
    f"{_REFRESHED}, asked as (select distinct cast(c_custkey * 3 as string) as user_id from customer) "
    "select refreshed.* from refreshed where user_id in (select user_id from asked) union all "
    "select user_id, 'Fail', user_id || ' not found', '', 0, 0, '', 0, 0.0 from asked "
    "where user_id not in (select user_id from users)"
)
def refresh_selected(spark: SparkSession, sf: str) -> DataFrame:
    asked = V.table(spark, sf, "customer").selectExpr("cast(c_custkey * 3 as string) as user_id")
    return _summary(_refreshed(refresh.refresh_selected, spark, sf, asked=asked))
