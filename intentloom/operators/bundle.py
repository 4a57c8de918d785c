"""Per-user bundles, their stored parts, and the completeness audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from intentloom.functions.text import or_default
from intentloom.operators.events import counts_per_user, event_records, hot_keys
from intentloom.params import FALLBACK_METADATA, SLOTS, JobParams

EMBEDDING_NAMES = tuple(f"embedding{i:02d}" for i in range(1, SLOTS + 1))
METADATA_NAME = "metadata"
QUERIES_NAME = "queries"


def inline_events(events: DataFrame, limit: int) -> DataFrame:
    """All records of the users with at most ``limit`` interactions, oldest first.

    Users above the limit are left out before anything is gathered: the largest
    through a broadcast of bounded size, the rest because no more than
    ``limit + 1`` of a user's rows leave a task.
    """
    hot = hot_keys(counts_per_user(events), "user_id", "n_events", above=limit)
    others = events.join(F.broadcast(hot), "user_id", "left_anti")
    order = [F.desc_nulls_last("ts"), *[c for c in events.columns if c not in ("user_id", "ts")]]
    w = W.partitionBy("user_id").orderBy(*order)
    some = others.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= limit + 1).drop("rk")
    rows = F.array_sort(F.collect_list(F.struct("ts", "record")))
    gathered = event_records(some).groupBy("user_id").agg(rows.alias("rows"))
    return gathered.where(F.size("rows") <= limit).select(
        "user_id", F.transform("rows", lambda r: r["record"]).alias("interactions")
    )


def spilled_events(events: DataFrame, counts: DataFrame, limit: int) -> DataFrame:
    """All records of the users who have more than ``limit``, as rows."""
    heavy = counts.where(F.col("n_events") > limit).select("user_id")
    return event_records(events).join(heavy, "user_id", "left_semi").select("user_id", "ts", "record")


def bundle_metadata(features: DataFrame, events: DataFrame, params: JobParams) -> DataFrame:
    """Add ``metadata`` to rows of profile columns, last-20 lists, n_events and template.

    ``interactions`` is whole when ``interactions_inline`` is true; otherwise it is
    null and the user's records are the rows of :func:`spilled_events`.
    """
    inline = F.col("n_events") <= params.inline_events
    none = F.array().cast("array<string>")
    metadata = F.struct(
        F.col("user_id"),
        F.col("curriculum_name").alias("current_status"),
        F.col("student_year").alias("education_level"),
        F.col("faculty_name").alias("education_major"),
        F.col("onboard_grp").alias("target_roles"),
        F.lit(params.timezone).alias("timezone"),
        F.lit(params.model_name).alias("model_name"),
        F.lit(params.max_output_tokens).alias("max_output_tokens"),
        F.lit(params.feed_text_max_chars).alias("feed_text_max_chars"),
        F.lit(params.temperature).alias("temperature"),
        F.col("template"),
        F.col("recent_tag_interaction").alias("tag_interaction"),
        F.col("recent_category_interaction").alias("category_interaction"),
        F.col("n_events"),
        inline.alias("interactions_inline"),
        F.when(inline, F.coalesce("interactions", none)).alias("interactions"),
    )
    joined = features.join(inline_events(events, params.inline_events), "user_id", "left")
    return joined.withColumn("metadata", metadata).drop("interactions")


def build_bundle(rows: DataFrame) -> DataFrame:
    """Bundle per row of user_id, metadata, queries, vectors, error.

    Five vectors are named; further ones are dropped while their query text stays.
    Fewer than five make the row a failure, and the row stays.
    """
    size = F.coalesce(F.size("vectors"), F.lit(0))
    error = F.coalesce(
        F.col("error"),
        F.when(size < SLOTS, F.concat(F.lit("bad_query_count: "), size.cast("string"))),
    )
    embeddings = F.struct(
        *[F.get("vectors", F.lit(i)).alias(name) for i, name in enumerate(EMBEDDING_NAMES)]
    )
    return rows.select(
        "user_id",
        F.when(error.isNull(), "Complete").otherwise("Fail").alias("status"),
        error.alias("error"),
        "metadata",
        "queries",
        F.when(error.isNull(), embeddings).alias("embeddings"),
    )


def bundle_artifacts(bundles: DataFrame) -> DataFrame:
    """Older layout: metadata, five vectors and one query list as separate rows."""
    done = bundles.where("status = 'Complete'")
    return done.select("user_id", F.inline(F.array(*_artifacts())))


def _part(kind: str, name: Column, text: Column | None, vector: Column | None) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"),
        name.alias("name"),
        (F.lit(None) if text is None else text).cast("string").alias("text"),
        (F.lit(None) if vector is None else vector).cast("array<float>").alias("vector"),
    )


def _artifacts() -> list[Column]:
    return [
        _part("metadata", F.lit(METADATA_NAME), F.to_json("metadata"), None),
        _part("queries", F.lit(QUERIES_NAME), F.to_json("queries"), None),
        *[_part("embedding", F.lit(n), None, F.col(f"embeddings.{n}")) for n in EMBEDDING_NAMES],
    ]


def stored_parts(bundles: DataFrame) -> DataFrame:
    """The parts of bundles as :func:`intentloom.sources.stores.read_bundles` finds them, in one pass.

    Every line has a part of kind ``state``: ``stored`` without text, ``failed`` with the bundle's error, or
    ``corrupt`` with the line itself. Only stored bundles have other parts.
    """
    whole = F.col("corrupt").isNull() & (F.col("status") == "Complete")
    state = F.when(F.col("corrupt").isNotNull(), "corrupt").when(whole, "stored").otherwise("failed")
    note = _part("state", state, F.coalesce("corrupt", "error"), None)
    parts = F.when(whole, F.array(note, *_artifacts())).otherwise(F.array(note))
    return bundles.where("user_id is not null").select("user_id", F.inline(parts))


def stored_audit(asked: DataFrame, bundles: DataFrame, users: DataFrame, model_name: str | None = None) -> DataFrame:
    """:func:`bundle_audit` of written bundles, with ``state`` (stored, failed, corrupt, absent) and ``note``.

    A user with several lines is as good as the best of them.
    """
    return bundle_audit(asked, stored_parts(bundles), users, model_name, states=True)


def bundle_audit(
    asked: DataFrame, stored: DataFrame, users: DataFrame, model_name: str | None = None, states: bool = False
) -> DataFrame:
    """What is stored for each asked-for user: one row per user, always.

    Missing texts are empty, missing vectors are empty arrays, missing metadata
    is rebuilt from the profile (with ``model_name``, if given). ``report`` lists each expected part with ``/`` or
    ``x``. Stored parts are folded to one row per user with partial aggregates.
    """

    def present(kind: str, name: str, value: str) -> Column:
        here = (F.col("kind") == kind) & (F.col("name") == name)
        return F.max_by(F.when(here, F.col(value)), F.when(here, F.xxhash64(value)))

    def any_of(kind: str) -> Column:
        return F.max(F.col("kind") == kind)

    folded = stored.groupBy("user_id").agg(
        any_of("metadata").alias("has_metadata"),
        any_of("queries").alias("has_queries"),
        any_of("embedding").alias("has_embedding"),
        present("metadata", METADATA_NAME, "text").alias("metadata_text"),
        present("queries", QUERIES_NAME, "text").alias("queries_text"),
        *[present("embedding", n, "vector").alias(n) for n in EMBEDDING_NAMES],
        # "stored" comes after "failed" and "corrupt"
        F.max(F.when(F.col("kind") == "state", F.struct("name", "text"))).alias("state"),
    )
    profile = users.select("user_id", metadata_fallback(model_name).alias("fallback"))
    joined = (
        asked.select("user_id")
        .join(folded.withColumn("has_user", F.lit(True)), "user_id", "left")
        .join(profile, "user_id", "left")
    )

    def mark(flag: Column) -> Column:
        return F.when(F.coalesce(flag, F.lit(False)), "/").otherwise("x")

    def line(depth: int, label: Column, flag: Column) -> Column:
        return F.concat(F.lit("  " * depth + "|- "), label, F.lit(" "), mark(flag))

    report = F.concat_ws(
        "\n",
        line(0, F.col("user_id"), F.col("has_user")),
        line(1, F.lit("metadata folder"), F.col("has_metadata")),
        line(2, F.lit(METADATA_NAME), F.col("metadata_text").isNotNull()),
        line(1, F.lit("queries folder"), F.col("has_queries")),
        line(2, F.lit(QUERIES_NAME), F.col("queries_text").isNotNull()),
        line(1, F.lit("embedding folder"), F.col("has_embedding")),
        *[line(2, F.lit(n), F.col(n).isNotNull()) for n in EMBEDDING_NAMES],
    )
    empty = F.array().cast("array<float>")
    source = (
        F.when(F.col("metadata_text").isNotNull(), "stored")
        .when(F.col("fallback").isNotNull(), "profile")
        .otherwise("none")
    )
    return joined.select(
        "user_id",
        F.coalesce("metadata_text", F.to_json("fallback"), F.lit("{}")).alias("metadata"),
        source.alias("metadata_source"),
        F.coalesce("queries_text", F.lit("")).alias("queries"),
        F.struct(*[F.coalesce(n, empty).alias(n) for n in EMBEDDING_NAMES]).alias("embeddings"),
        report.alias("report"),
        *([F.coalesce("state.name", F.lit("absent")).alias("state"), F.coalesce("state.text", F.lit("")).alias("note")] if states else []),
    )


def queries_audit(asked: DataFrame, stored: DataFrame) -> DataFrame:
    """The query list only, with its presence."""
    lists = stored.where((F.col("kind") == "queries") & (F.col("name") == QUERIES_NAME))
    found = lists.groupBy("user_id").agg(F.max("text").alias("text"))
    return asked.select("user_id").join(found, "user_id", "left").select(
        "user_id", F.coalesce("text", F.lit("")).alias("queries"), F.col("text").isNotNull().alias("present")
    )


def metadata_fallback(model_name: str | None = None) -> Column:
    return F.struct(
        "user_id",
        "current_status",
        F.col("student_year").alias("education_level"),
        F.concat_ws(" ", "faculty_name", "curriculum_name", "university_name").alias("education_major"),
        or_default("target_roles", "").alias("target_roles"),
        *[F.lit(v).alias(k) for k, v in FALLBACK_METADATA.items()],
        *([] if model_name is None else [F.lit(model_name).alias("model_name")]),
    )


def retention_filter(objects: DataFrame, now: datetime, ttl_s: int) -> DataFrame:
    """Objects to keep: not older than the time to live; unknown age stays."""
    cutoff = F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz") - F.expr(
        f"interval {int(ttl_s)} seconds"
    )
    return objects.where(F.col("created").isNull() | (F.col("created") >= cutoff))


