"""User context, history text, template routing and rendering."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from intentloom.functions.text import (
    col,
    non_blank_parts,
    normalize_language,
    or_default,
    parse_interests,
    parse_list_column,
    parse_roles,
    parse_skills,
    strip,
)
from intentloom.operators.events import counts_per_user, recent_titles
from intentloom.params import (
    CONTEXT_FORMAT,
    CONTEXT_MARK,
    DEFAULT_LANGUAGE,
    HISTORY_FORMAT,
    HISTORY_MARK,
    LANGUAGE_MARK,
    NOT_SPECIFIED,
    TEMPLATES,
    JobParams,
)


def education_major() -> Column:
    """The three parts in a row; a missing part is skipped."""
    return F.concat_ws(" ", "faculty_name", "curriculum_name", "university_name")


def context_struct() -> Column:
    return F.struct(
        F.col("user_id"),
        normalize_language("preferred_language").alias("preferred_language"),
        or_default("current_status", "unknown").alias("current_status"),
        F.struct(
            or_default("student_year", "unknown").alias("level"),
            education_major().alias("major"),
        ).alias("education"),
        parse_roles("target_roles").alias("target_roles"),
        parse_skills("skill").alias("skills"),
        parse_interests("interests").alias("interests"),
        or_default("onboard_grp", "NA").alias("onboard_grp"),
        or_default("onboard_grp_description", "").alias("onboard_grp_description"),
    )


def context_text(language: Column) -> Column:
    roles = F.array_join(F.transform(non_blank_parts("target_roles", r"\|"), strip), ", ")
    values = (
        education_major(),
        or_default(roles, NOT_SPECIFIED),
        or_default(strip("skill"), NOT_SPECIFIED),
        or_default("onboard_grp", "NA"),
        or_default("onboard_grp_description", ""),
    )
    return F.when(language == "en", F.format_string(CONTEXT_FORMAT["en"], *values)).otherwise(
        F.format_string(CONTEXT_FORMAT["th"], *values)
    )


def user_context(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        context_struct().alias("context"),
        context_text(normalize_language("preferred_language")).alias("context_text"),
    )


def history_text(language: Column, window_days: int) -> Column:
    """The five lists as one text; empty without events or without a last-20 row."""
    lists = [
        F.array_join(parse_list_column(c), ", ")
        for c in (
            "recent_post_interaction",
            "recent_tag_interaction",
            "recent_category_interaction",
            "recent_keyword_search",
        )
    ]
    recent = F.coalesce("recent_titles", F.lit(""))
    text = F.when(
        language == "en",
        F.format_string(HISTORY_FORMAT["en"], F.lit(window_days), *lists, recent),
    ).otherwise(F.format_string(HISTORY_FORMAT["th"], *lists, recent))
    return F.when((F.col("n_events") > 0) & F.col("has_last20"), text).otherwise("")


def user_features(
    users: DataFrame,
    events: DataFrame,
    catalog: DataFrame,
    last20: DataFrame,
    params: JobParams,
) -> DataFrame:
    """Users with event count, recent titles and last-20 lists, one row each.

    Events are reduced to one row per user before any join. All sides are hash
    partitioned by user by then, so the joins add one shuffle: that of the users.
    """
    features = users.join(counts_per_user(events), "user_id", "left").withColumn(
        "n_events", F.coalesce("n_events", F.lit(0))
    )
    if params.include_recent and params.recent_k > 0:
        titles = recent_titles(events, catalog, params.recent_k).drop("n_recent")
        features = features.join(titles, "user_id", "left")
    else:
        features = features.withColumn("recent_titles", F.lit(None).cast("string"))
    flagged = last20.withColumn("has_last20", F.lit(True))
    return features.join(flagged, "user_id", "left").withColumn(
        "has_last20", F.coalesce("has_last20", F.lit(False))
    )


def history_summary(features: DataFrame, window_days: int) -> DataFrame:
    language = normalize_language("preferred_language")
    return features.select("user_id", history_text(language, window_days).alias("history_text"))


def route(n_events: Column | str, threshold: int) -> Column:
    return F.when(col(n_events) < threshold, "profile").otherwise("interaction")


def route_3way(n_events: Column | str, threshold: int) -> Column:
    """Older rule; the upper limit is tested first."""
    n = col(n_events)
    return F.when(n >= threshold, "history").when(n <= 1, "starter").otherwise("mixed")


def render(body: Column, language: Column, context: Column, history: Column) -> Column:
    """Literal replacement, in the order language, context, history."""
    text = F.replace(body, F.lit(LANGUAGE_MARK), or_default(language, DEFAULT_LANGUAGE))
    text = F.replace(text, F.lit(CONTEXT_MARK), F.coalesce(context, F.lit("")))
    return F.replace(text, F.lit(HISTORY_MARK), F.coalesce(history, F.lit("")))


def render_prompts(
    features: DataFrame, params: JobParams, templates: Mapping[str, str] = TEMPLATES
) -> DataFrame:
    """Prompt per user; an unknown or empty template fails that user only.

    The templates are the job's own configuration and enter as literals: a join on
    the template name would gather all users on a handful of keys.
    """
    language = normalize_language("preferred_language")
    body = F.lit(None).cast("string")
    for name, text in sorted(templates.items()):
        body = F.when(F.col("template") == name, F.lit(text)).otherwise(body)
    routed = features.withColumn("template", route("n_events", params.history_threshold)).withColumn(
        "_body", body
    )
    missing = F.coalesce(F.length("_body"), F.lit(0)) == 0
    prompt = render(
        F.col("_body"),
        language,
        context_text(language),
        history_text(language, params.window_days),
    )
    return routed.select(
        *[F.col(c) for c in features.columns],
        "template",
        language.alias("language"),
        F.when(~missing, prompt).alias("prompt"),
        F.when(missing, F.concat(F.lit("Missing prompt "), "template")).alias("error"),
    )
