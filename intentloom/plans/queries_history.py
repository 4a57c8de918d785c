"""Interaction history and theme features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from intentloom.functions import text as X
from intentloom.operators import context as C, events as E, themes as T
from intentloom.params import RECENT_BLOCK_HEADER, THEME_SUMMARY_FORMAT, JobParams
from intentloom.plans.queries_scan import NOW
from intentloom.plans.registry import query
from intentloom.sources import standins as V

PARAMS = JobParams()


def languages(spark: SparkSession, sf: str) -> DataFrame:
    language = X.normalize_language("preferred_language").alias("language")
    return V.users(spark, sf).select("user_id", language)


LANG = "case when trim(preferred_language) = 'en' then 'en' else 'th' end"

COUNTS = (
    "counts as (select users.user_id, count(ev.user_id) as n_events from users "
    "left join ev on ev.user_id = users.user_id group by users.user_id)"
)
RECENT = (
    "pairs as (select user_id, item_id, max(ts) as last_ts from ev where item_id is not null "
    "group by user_id, item_id), recent as (select * from (select user_id, item_id, "
    "row_number() over (partition by user_id order by last_ts desc, item_id) as rk from pairs) "
    "where rk <= 5)"
)
TITLES = (
    "titles as (select user_id, string_agg(coalesce(title, recent.item_id), ', ' order by rk) "
    "as recent_titles, count(*) as n_recent from recent left join catalog "
    "on catalog.item_id = recent.item_id group by user_id)"
)


@query(V.with_views("users", "ev") + f", {COUNTS} select user_id, n_events from counts")
def event_counts(spark: SparkSession, sf: str) -> DataFrame:
    return E.event_counts(V.users(spark, sf), V.events(spark, sf))


@query(
    V.with_views("users", "ev")
    + f", {COUNTS} select user_id, n_events, "
    "case when n_events < 20 then 'profile' else 'interaction' end as template from counts"
)
def route_template(spark: SparkSession, sf: str) -> DataFrame:
    counts = E.event_counts(V.users(spark, sf), V.events(spark, sf))
    return counts.withColumn("template", C.route("n_events", PARAMS.history_threshold))


@query(
    V.with_views("users", "ev")
    + ", n as (select users.user_id, count(ev.user_id) as n_events, "
    "count(ev.user_id) filter (where ts >= timestamp '2024-01-31' - interval 3 days) as n_recent "
    "from users left join ev on ev.user_id = users.user_id group by users.user_id) "
    "select user_id, n_events, n_recent, case when n_events >= 5 then 'history' "
    "when n_events <= 1 then 'starter' else 'mixed' end as template, case when n_recent >= 5 then 'history' "
    "when n_recent <= 1 then 'starter' else 'mixed' end as template_recent from n"
)
def route_template_3way(spark: SparkSession, sf: str) -> DataFrame:
    users, events = V.users(spark, sf), V.events(spark, sf)
    lately = E.event_counts(users, E.events_in_window(events, NOW, 3)).withColumnRenamed("n_events", "n_recent")
    return (
        E.event_counts(users, events).join(lately, "user_id")
        .withColumn("template", C.route_3way("n_events", PARAMS.legacy_history_threshold))
        .withColumn("template_recent", C.route_3way("n_recent", PARAMS.legacy_history_threshold))
    )


@query(V.with_views("ev") + f", {RECENT} select user_id, item_id, rk from recent")
def recent_items(spark: SparkSession, sf: str) -> DataFrame:
    recent = E.recent_items(V.events(spark, sf), PARAMS.recent_k)
    return recent.select("user_id", "item_id", F.col("rk").cast("bigint").alias("rk"))


@query(
    V.with_views("ev", "items", "catalog")
    + f", {RECENT}, {TITLES} select user_id, recent_titles, n_recent from titles"
)
def recent_titles(spark: SparkSession, sf: str) -> DataFrame:
    return E.recent_titles(V.events(spark, sf), V.catalog(spark, sf, body=False), PARAMS.recent_k)


@query(
    V.with_views("users", "ev", "items", "catalog")
    + """, pairs as (select user_id, item_id, max(ts) as last_ts from ev
      where exists (select 1 from catalog where catalog.item_id = ev.item_id)
      group by user_id, item_id),
    chosen as (select user_id, item_id, row_number() over
      (partition by user_id order by last_ts desc, item_id) as rk from pairs),
    texts as (select item_id, coalesce(title, '') as title,
      regexp_replace(trim(replace(feed_text, chr(10), ' ')), ' {2,}', ' ', 'g') as body from catalog),
    lines as (select user_id, string_agg('- (' || rk || ') ' || chosen.item_id || ' | ' || title
      || ' | ' || case when length(body) <= 30 then body
         else rtrim(substr(body, 1, 29)) || '…' end, chr(10) order by rk) as body
      from chosen join texts on texts.item_id = chosen.item_id where rk <= 5 group by user_id)
    """
    + f"select lines.user_id, case when {LANG} = 'en' then '{RECENT_BLOCK_HEADER['en']}' "
    f"else '{RECENT_BLOCK_HEADER['th']}' end || chr(10) || body as recent_block "
    "from lines join users on users.user_id = lines.user_id"
)
def recent_block(spark: SparkSession, sf: str) -> DataFrame:
    return E.recent_block(
        V.events(spark, sf), V.catalog(spark, sf), languages(spark, sf), PARAMS.recent_k, 30
    )


SEEN = (
    "seen as (select distinct user_id, item_id from ev where event_type in ('view', 'click') "
    "and ts >= timestamp '2024-01-31' - interval 14 days)"
)


def _seen(spark: SparkSession, sf: str) -> DataFrame:
    return E.seen_items(
        V.events(spark, sf), event_types=[" View", "click", ""], now=NOW, window_days=14
    )


@query(V.with_views("ev") + f", {SEEN} select user_id, item_id from seen")
def seen_items(spark: SparkSession, sf: str) -> DataFrame:
    return _seen(spark, sf)


@query(
    V.with_views("ev")
    + ", pairs as (select user_id, item_id, max(ts) as last_ts from ev group by user_id, item_id) "
    "select user_id, item_id from (select *, row_number() over "
    "(partition by user_id order by last_ts desc, item_id) as rk from pairs) where rk <= 10"
)
def seen_items_capped(spark: SparkSession, sf: str) -> DataFrame:
    return E.seen_items(V.events(spark, sf), max_unique=10)


@query(
    V.with_views("ev")
    + f", {SEEN}, candidates as (select distinct user_id, "
    "cast((cast(item_id as bigint) * 7) % 100 as string) as item_id from ev) "
    "select user_id, item_id from candidates where not exists (select 1 from seen "
    "where seen.user_id = candidates.user_id and seen.item_id = candidates.item_id)"
)
def exclude_seen(spark: SparkSession, sf: str) -> DataFrame:
    shifted = ((F.col("item_id").cast("bigint") * 7) % 100).cast("string")
    candidates = V.events(spark, sf).select("user_id", shifted.alias("item_id")).distinct()
    return E.exclude_seen(candidates, _seen(spark, sf))


LAST20 = """last20 as (
  with latest as (select * from (select user_id, item_id, row_number() over (partition by user_id
      order by ts desc, item_id, event_type) as rk from ev) where rk <= 20),
    facts as (select item_id, lower(title) as title, cast(tags as json)->>'$[*]' as tags,
      cast(post_category as json)->>'$[*]' as cats from catalog),
    joined as (select user_id, rk, title, tags, cats from latest left join facts
      on facts.item_id = latest.item_id),
    first_seen as (select user_id, title, min(rk) as rk from joined where title is not null
      group by user_id, title),
    t as (select user_id, to_json(list(title order by rk)) as v from first_seen group by user_id),
    g as (select user_id, to_json(list_sort(list(distinct x))) as v from
      (select user_id, unnest(tags) as x from joined) group by user_id),
    c as (select user_id, to_json(list_sort(list(distinct x))) as v from
      (select user_id, unnest(cats) as x from joined) group by user_id)
  select u.user_id, cast(coalesce(t.v, '[]') as string) as recent_post_interaction,
    cast(coalesce(g.v, '[]') as string) as recent_tag_interaction,
    cast(coalesce(c.v, '[]') as string) as recent_category_interaction,
    '[]' as recent_keyword_search
  from (select distinct user_id from latest) u left join t on t.user_id = u.user_id
    left join g on g.user_id = u.user_id left join c on c.user_id = u.user_id)"""


@query(V.with_views("ev", "items", "catalog") + f", {LAST20} select * from last20")
def last20_profile(spark: SparkSession, sf: str) -> DataFrame:
    return E.last20_profile(V.events(spark, sf), V.catalog(spark, sf, body=False))


# --- scores and themes ------------------------------------------------------

_BOOST = (
    "case when dwell_ms >= 60000 then 0.6 when dwell_ms >= 30000 then 0.4 "
    "when dwell_ms >= 10000 then 0.2 else 0.0 end"
)
_SCORE = (
    "cast(case event_type when 'click' then 1.2 when 'like' then 1.5 when 'share' then 1.6 "
    f"when 'comment' then 1.6 when 'bookmark' then 2.0 else 1.0 end + {_BOOST} as decimal(10,1))"
)
# One in four events of the test table becomes a like, share, comment or bookmark.
_KIND = (
    "case cast(item_id as bigint) % 8 when 0 then ' Like ' when 1 then 'share' "
    "else event_type end"
)
_THEME_ID = (
    "concat(case cast(item_id as bigint) % 6 when 0 then 'th_f' when 1 then 'EN_F' "
    "when 2 then 'TH_BIO' when 3 then 'th_sch' when 4 then 'TH_UNI' else 'TH' end, item_id)"
)
_THEME = (
    "case cast(item_id as bigint) % 6 when 0 then 'data_career' when 1 then 'data_career' "
    "when 2 then 'biotech' when 3 then 'scholarship' when 4 then 'university' else 'other' end"
)
_KINDS = f"kinds as (select * replace (lower(trim({_KIND})) as event_type) from ev)"
_SUMS = (
    "count(*) as total_events, sum(score) as total_score, "
    "count(*) filter (event_type = 'view') as num_views, "
    "count(*) filter (event_type = 'click') as num_clicks, "
    "count(*) filter (event_type = 'like') as num_likes, max(dwell_ms) as max_dwell"
)
_BY_TAG = (
    f"scored as (select user_id, tags->>'$[0]' as theme, event_type, dwell_ms, {_SCORE} as score "
    "from kinds left join (select item_id, cast(tags as json) as tags from catalog) c "
    f"on c.item_id = kinds.item_id), rollup_ as (select user_id, theme, {_SUMS} from scored "
    "group by user_id, theme)"
)
_RANK = (
    "row_number() over (partition by user_id order by total_score desc, total_events desc, "
    "theme asc nulls last) as rk"
)
_TOP = f"top_ as (select * from (select *, {_RANK} from rollup_) where rk <= 4)"
_WEAK = (
    f"weak as (select * from (select *, {_RANK} from rollup_ where total_events >= 2 "
    "and total_score <= 2.1 and max_dwell < 8000) where rk <= 2)"
)


def _kinds(spark: SparkSession, sf: str) -> DataFrame:
    return V.events(spark, sf).withColumn("event_type", F.expr(_KIND))


def _rollup_by_tag(spark: SparkSession, sf: str) -> DataFrame:
    """Themes from item metadata: the first tag of the item."""
    tags = V.catalog(spark, sf, body=False).select("item_id", F.get_json_object("tags", "$[0]").alias("theme"))
    tagged = _kinds(spark, sf).join(tags, "item_id", "left")
    return T.theme_rollup(tagged, F.col("theme"))


@query(
    V.with_views("ev")
    + f", {_KINDS} select user_id, item_id, event_type, dwell_ms, "
    f"cast({_SCORE} as double) as score from kinds"
)
def score_events(spark: SparkSession, sf: str) -> DataFrame:
    scored = T.score_events(_kinds(spark, sf))
    kind = F.lower(X.strip("event_type")).alias("event_type")
    return scored.select(
        "user_id", "item_id", kind, "dwell_ms", F.col("score").cast("double").alias("score")
    )


@query(
    V.with_views("ev")
    + f"select item_id, {_THEME} as theme, count(*) as n from ev group by item_id"
)
def infer_theme(spark: SparkSession, sf: str) -> DataFrame:
    themed = V.events(spark, sf).select("item_id", T.infer_theme(F.expr(_THEME_ID)).alias("theme"))
    return themed.groupBy("item_id", "theme").agg(F.count("*").alias("n"))


@query(
    V.with_views("ev")
    + f", {_KINDS}, scored as (select user_id, {_THEME} as theme, event_type, dwell_ms, "
    f"{_SCORE} as score from kinds) "
    "select * replace (cast(total_score as double) as total_score) from "
    f"(select user_id, theme, {_SUMS} from scored group by user_id, theme)"
)
def theme_rollup(spark: SparkSession, sf: str) -> DataFrame:
    themed = _kinds(spark, sf).withColumn("item_id", F.expr(_THEME_ID))
    rolled = T.theme_rollup(themed)
    return rolled.withColumn("total_score", F.col("total_score").cast("double"))


def _themes_out(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id",
        F.coalesce("theme", F.lit("-")).alias("theme"),
        F.col("rk").cast("bigint").alias("rk"),
        F.col("total_score").cast("double").alias("total_score"),
        "total_events",
    )


_THEMES_OUT = (
    "select user_id, coalesce(theme, '-') as theme, rk, "
    "cast(total_score as double) as total_score, total_events from "
)
_THEME_VIEWS = V.with_views("users", "ev", "items", "catalog") + f", {_KINDS}, {_BY_TAG}"


@query(f"{_THEME_VIEWS}, {_TOP} {_THEMES_OUT} top_")
def top_themes(spark: SparkSession, sf: str) -> DataFrame:
    return _themes_out(T.top_themes(_rollup_by_tag(spark, sf), PARAMS.top_themes))


@query(f"{_THEME_VIEWS}, {_WEAK} {_THEMES_OUT} weak")
def weak_themes(spark: SparkSession, sf: str) -> DataFrame:
    return _themes_out(T.weak_themes(_rollup_by_tag(spark, sf)))


def _summary_sql(lang: str) -> str:
    fmt = {k: v.replace("%s", "{}").replace("%d", "{}") for k, v in THEME_SUMMARY_FORMAT[lang].items()}
    return (
        f"concat_ws(chr(10), format('{fmt['head']}', 30, cast(n_events as bigint)), "
        f"'{fmt['top']}', lines_{lang}, format('{fmt['weak']}', weak_names))"
    )


def _line_sql(lang: str) -> str:
    fmt = THEME_SUMMARY_FORMAT[lang]["line"].replace("%s", "{}").replace("%d", "{}")
    return (
        f"string_agg(format('{fmt}', coalesce(theme, 'other'), cast(total_score as string), "
        f"total_events, num_likes, num_clicks, max_dwell), chr(10) order by rk) as lines_{lang}"
    )


@query(
    f"{_THEME_VIEWS}, {_TOP}, {_WEAK}, "
    f"best as (select user_id, {_line_sql('th')}, {_line_sql('en')} from top_ group by user_id), "
    "w as (select user_id, string_agg(coalesce(theme, 'other'), ', ' order by rk) as weak_names "
    "from weak group by user_id), "
    "totals as (select user_id, sum(total_events) as n_events from rollup_ group by user_id) "
    f"select users.user_id, case when {LANG} = 'en' then {_summary_sql('en')} "
    f"else {_summary_sql('th')} end as theme_summary from users "
    "join totals on totals.user_id = users.user_id left join best on best.user_id = users.user_id "
    "left join w on w.user_id = users.user_id"
)
def theme_summary(spark: SparkSession, sf: str) -> DataFrame:
    return T.theme_summary(
        _rollup_by_tag(spark, sf), languages(spark, sf), PARAMS.top_themes, PARAMS.window_days
    )
