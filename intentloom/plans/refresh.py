"""The refresh job: from profiles and events to bundles, for all users at once.

Failures never stop the job. Each stage adds to an ``error`` column, later stages
skip rows that have one, and every user ends as one row with a status.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from intentloom.operators.answer_store import AnswerStore, stored_answers
from intentloom.operators.answers import parse_queries, resolve_answers
from intentloom.operators.bundle import build_bundle, bundle_metadata
from intentloom.operators.context import render_prompts, user_features
from intentloom.operators.ledger import embedding_cost_usd, ledger_union, llm_cost_usd
from intentloom.operators.models import (
    Factory,
    embed_lists,
    generate_answers,
    materialize,
)
from intentloom.params import SLOTS, TEMPLATES, JobParams
from intentloom.sources import schemas
from intentloom.sources.readers import missing_users, scan_users
from intentloom.sources.schemas import require_columns


@dataclass(frozen=True)
class Refreshed:
    """Lazy results over the one materialized model stage."""

    bundles: DataFrame  # user_id, status, error, metadata, queries, embeddings
    statuses: DataFrame  # user_id, status, error, slow, llm_s
    ledger: DataFrame  # one row per model call, of both kinds
    interactions: DataFrame  # user_id, record: every interaction of every known user


def refresh_all(
    users: DataFrame,
    events: DataFrame,
    catalog: DataFrame,
    last20: DataFrame,
    generator: Factory,
    embedder: Factory,
    params: JobParams,
    templates: Mapping[str, str] = TEMPLATES,
    answers: AnswerStore | None = None,
) -> Refreshed:
    """``catalog`` is :func:`item_catalog`'s output; ``templates`` maps names to texts. With ``answers``, the model is
    called only for prompts that the store lacks, and answers are stored before they are embedded."""
    require_columns(users, schemas.USERS, "users")
    require_columns(events, schemas.EVENTS, "events")
    require_columns(last20, schemas.LAST20, "last20")
    profiles = scan_users(users)
    features = user_features(profiles, events, catalog, last20, params)
    prompts = render_prompts(features, params, templates)
    # Metadata joins here, where all sides lie by user already. Everything after the
    # model stage is then a projection, and vectors are never shuffled.
    kept = bundle_metadata(prompts, events, params).select("user_id", "metadata", "prompt", "error")
    if answers is None:
        answered = generate_answers(kept, generator, params).drop("prompt")
    else:
        keyed = kept.withColumn("_template", F.col("metadata.template"))
        answered = stored_answers(keyed, generator, params, answers, template="_template").drop("prompt", "reused", "_template")
    resolved = resolve_answers(answered, text="raw").drop("raw")
    parsed = (
        parse_queries(resolved, params.answer_field)
        .withColumn("_error", F.coalesce("error", "call_error", "query_error"))
        .drop("error", "call_error", "query_error", "answer")
    )

    # A failed row sends no texts to the embedder.
    texts = F.when(F.col("_error").isNull(), F.transform("queries", lambda q: q["query_text"]))
    embedded = parsed.withColumn("_e", embed_lists(texts, embedder, params.output_dim))
    finished = materialize(
        embedded.select(
            *[c for c in parsed.columns if c != "_error"],
            F.col("_e.vectors").alias("vectors"),
            # statuses and costs then read no vectors; null without an embedding
            F.size("_e.vectors").alias("n_vectors"),
            F.coalesce("_error", "_e.error").alias("error"),
        )
    )
    bundles = build_bundle(finished)

    call_s = F.aggregate("calls", F.lit(0.0), lambda acc, c: acc + F.coalesce(c["latency_s"], F.lit(0.0)))
    too_few = F.coalesce("n_vectors", F.lit(0)) < SLOTS
    failure = F.coalesce("error", F.when(too_few, F.lit("bad_query_count")))
    statuses = finished.select(
        "user_id",
        F.when(failure.isNull(), "Complete").otherwise("Fail").alias("status"),
        failure.alias("error"),
        (call_s > params.slow_s).alias("slow"),
        call_s.alias("llm_s"),
        F.col("metadata.template").alias("template"),
    )
    return Refreshed(bundles, statuses, _ledger(finished, params), interactions(profiles, events))


def interactions(profiles: DataFrame, events: DataFrame) -> DataFrame:
    """One row per interaction of a known user, as a record; no size of a user changes their shape."""
    record = F.struct(*[c for c in events.columns if c != "user_id"])
    return events.select("user_id", record.alias("record")).join(profiles.select("user_id"), "user_id", "left_semi")


def _ledger(finished: DataFrame, params: JobParams) -> DataFrame:
    calls = finished.select("user_id", F.explode("calls").alias("c")).select(
        F.lit("llm").alias("event_type"),
        "user_id",
        F.lit(params.model_name).alias("model_name"),
        "c.input_tokens",
        "c.output_tokens",
        F.round("c.latency_s", 4).alias("latency_s"),
        llm_cost_usd(
            "c.input_tokens", "c.output_tokens", F.lit(params.model_name), params.llm_rates
        ).alias("estimated_cost_usd"),
    )
    chars = F.aggregate(
        "queries", F.lit(0).cast("bigint"), lambda acc, q: acc + F.length(q["query_text"])
    )
    embedded = finished.where("n_vectors is not null").select(
        F.lit("embedding").alias("event_type"),
        "user_id",
        F.lit(params.embedding_model).alias("model_name"),
        F.col("n_vectors").cast("bigint").alias("num_texts"),
        chars.alias("total_chars"),
        embedding_cost_usd(chars, F.lit(params.embedding_model), params.embedding_rates).alias(
            "estimated_cost_usd"
        ),
    )
    return ledger_union(calls, embedded)


def refresh_selected(
    asked: DataFrame,
    users: DataFrame,
    events: DataFrame,
    catalog: DataFrame,
    last20: DataFrame,
    generator: Factory,
    embedder: Factory,
    params: JobParams,
    templates: Mapping[str, str] = TEMPLATES,
    answers: AnswerStore | None = None,
) -> Refreshed:
    """The same job for the asked-for users; unknown ones end as failed rows.

    The selection reaches events and last-20 rows as a semi join before any
    aggregate, so the work follows the selection, not the tables.
    """
    ids = asked.select("user_id").distinct()

    def only(df: DataFrame) -> DataFrame:
        return df.join(ids, "user_id", "left_semi")

    done = refresh_all(
        only(users), only(events), catalog, only(last20), generator, embedder, params, templates, answers
    )
    unknown = missing_users(ids, users)
    return Refreshed(
        done.bundles.unionByName(unknown, allowMissingColumns=True),
        done.statuses.unionByName(
            unknown.withColumn("slow", F.lit(False)), allowMissingColumns=True
        ),
        done.ledger,
        done.interactions,
    )
