"""Engagement scores and theme roll-ups. Scores are decimals: sums of tenths in
doubles depend on order, and the weak-theme limit compares exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from intentloom.functions.text import col, safe_int, strip
from intentloom.params import (
    DWELL_BOOSTS,
    EVENT_WEIGHTS,
    OTHER_EVENT_WEIGHT,
    OTHER_THEME,
    THEME_PREFIXES,
    THEME_SUMMARY_FORMAT,
    WEAK_MAX_DWELL_MS,
    WEAK_MAX_SCORE,
    WEAK_MIN_EVENTS,
    WEAK_THEMES,
)


def _tenths(value: object) -> Column:
    return F.lit(str(value)).cast("decimal(10,1)")


def _chain(branches: list[tuple[Column, Column]], default: Column) -> Column:
    out = F.when(*branches[0])
    for condition, value in branches[1:]:
        out = out.when(condition, value)
    return out.otherwise(default)


def dwell_boost(dwell: Column | str) -> Column:
    ms = safe_int(dwell)
    return _chain([(ms >= least, _tenths(boost)) for least, boost in DWELL_BOOSTS], _tenths(0))


def event_weight(event_type: Column | str) -> Column:
    name = F.lower(strip(event_type))
    return _chain(
        [(name == known, _tenths(w)) for known, w in EVENT_WEIGHTS.items()],
        _tenths(OTHER_EVENT_WEIGHT),
    )


def infer_theme(item_id: Column | str) -> Column:
    upper = F.upper(strip(F.coalesce(col(item_id), F.lit(""))))
    return _chain(
        [(upper.startswith(prefix), F.lit(theme)) for prefix, theme in THEME_PREFIXES],
        F.lit(OTHER_THEME),
    )


def score_events(events: DataFrame) -> DataFrame:
    score = (event_weight("event_type") + dwell_boost("dwell_ms")).cast("decimal(10,1)")
    return events.withColumn("score", score)


def theme_rollup(events: DataFrame, theme: Column | None = None) -> DataFrame:
    """Per user and theme; a null theme is a group of its own."""
    theme = infer_theme("item_id") if theme is None else theme
    kind = F.lower(strip("event_type"))
    dwell = F.coalesce(F.col("dwell_ms").try_cast("double"), F.lit(0.0))
    return (
        score_events(events)
        .withColumn("theme", theme)
        .groupBy("user_id", "theme")
        .agg(
            F.count("*").alias("total_events"),
            F.sum("score").alias("total_score"),
            F.count_if(kind == "view").alias("num_views"),
            F.count_if(kind == "click").alias("num_clicks"),
            F.count_if(kind == "like").alias("num_likes"),
            F.max(dwell).cast("bigint").alias("max_dwell"),
        )
    )


def _rank(*partition: str) -> Column:
    best_first = (F.desc("total_score"), F.desc("total_events"), F.asc_nulls_last("theme"))
    return F.row_number().over(W.partitionBy(*partition).orderBy(*best_first))


def _is_weak() -> Column:
    return (
        (F.col("total_events") >= WEAK_MIN_EVENTS)
        & (F.col("total_score") <= _tenths(WEAK_MAX_SCORE))
        & (F.col("max_dwell") < WEAK_MAX_DWELL_MS)
    )


def top_themes(rollup: DataFrame, k: int) -> DataFrame:
    return rollup.withColumn("rk", _rank("user_id")).where(F.col("rk") <= max(0, k))


def weak_themes(rollup: DataFrame) -> DataFrame:
    return top_themes(rollup.where(_is_weak()), WEAK_THEMES)


def theme_summary(
    rollup: DataFrame,
    languages: DataFrame,
    k: int,
    window_days: int,
    recent_blocks: DataFrame | None = None,
) -> DataFrame:
    """Summary text per user with events. ``languages``: user_id, language ('en' or 'th').

    Top and weak themes are ranked over one partitioning of the rolled-up rows,
    so the events are scanned and shuffled once.
    """
    ranked = rollup.withColumn("weak", _is_weak()).select(
        "*",
        _rank("user_id").alias("rk"),
        _rank("user_id", "weak").alias("weak_rk"),
    )
    is_top = F.col("rk") <= max(0, k)
    is_weak = F.col("weak") & (F.col("weak_rk") <= WEAK_THEMES)

    def line(lang: str) -> Column:
        return F.format_string(
            THEME_SUMMARY_FORMAT[lang]["line"],
            F.coalesce("theme", F.lit(OTHER_THEME)),
            F.col("total_score").cast("string"),
            "total_events",
            "num_likes",
            "num_clicks",
            "max_dwell",
        )

    def in_order(condition: Column, value: Column) -> Column:
        rows = F.collect_list(F.when(condition, F.struct("rk", value.alias("v"))))
        return F.transform(F.array_sort(rows), lambda r: r["v"])

    per_user = ranked.groupBy("user_id").agg(
        F.sum("total_events").alias("n_events"),
        in_order(is_top, line("th")).alias("top_th"),
        in_order(is_top, line("en")).alias("top_en"),
        in_order(is_weak, F.coalesce("theme", F.lit(OTHER_THEME))).alias("weak"),
    )
    joined = languages.join(per_user, "user_id")
    if recent_blocks is None:
        joined = joined.withColumn("recent_block", F.lit(None).cast("string"))
    else:
        joined = joined.join(recent_blocks, "user_id", "left")

    def text(lang: str) -> Column:
        fmt = THEME_SUMMARY_FORMAT[lang]
        top = f"top_{lang}"
        return F.concat_ws(
            "\n",
            F.format_string(fmt["head"], F.lit(window_days), "n_events"),
            F.when(F.size(top) > 0, F.concat_ws("\n", F.lit(fmt["top"]), F.array_join(top, "\n"))),
            F.when(F.size("weak") > 0, F.format_string(fmt["weak"], F.array_join("weak", ", "))),
            F.col("recent_block"),
        )

    summary = F.when(F.col("language") == "en", text("en")).otherwise(text("th"))
    return joined.select("user_id", summary.alias("theme_summary"))
