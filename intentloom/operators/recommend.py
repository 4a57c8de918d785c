"""Recommendation records: ranked items of each user with their data, or the reason why there are none."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from intentloom.operators.models import materialize
from intentloom.operators.retrieval import topk_weighted
from intentloom.operators.vector_index import vector_fault

SOURCE = "vector_search"


def recommend(
    users: DataFrame, slots: DataFrame, items: DataFrame, catalog: DataFrame, k: int, dim: int, *,
    seen: DataFrame | None = None, fusion: str = "max",
) -> DataFrame:
    """One row per user: (user_id, source, n_recommendations, recommendations, reason).

    ``users``: user_id; ``slots``: user_id, slot, weight, vector; ``items``: item_id, vector; ``catalog``:
    :func:`item_catalog`'s output; ``seen``: (user_id, item_id) left out. Every user of ``users`` is a row.
    ``recommendations`` are structs of rank, item_id, score and the item's ``metadata`` in rank order, at most k;
    metadata is null for an item that the catalog lacks. ``reason`` is null where there are any, else

    * ``no_queries``: the user has no slots;
    * ``bad_vectors``: none of the slots' vectors can be searched; the first fault follows;
    * ``bad_weights``: all usable slots have a null, NaN or negative weight;
    * ``all_seen``: the user has seen every item;
    * ``no_items``: no item has a vector that can be searched.
    """
    fault = vector_fault(dim)
    # zero weights are allowed; a negative one would turn similarity round
    weighed = F.coalesce((F.col("weight") >= 0) & ~F.isnan("weight"), F.lit(False))
    slots = slots.join(users.select("user_id").distinct(), "user_id", "left_semi").withColumn("fault", fault)
    good = F.col("fault").isNull()
    state = slots.groupBy("user_id").agg(
        F.bool_or(good).alias("searchable"), F.bool_or(good & weighed).alias("weighed"), F.min(F.struct("slot", "fault")).alias("first")
    )
    usable = materialize(slots.where(good & weighed).select("user_id", "slot", "weight", "vector"))
    vectors = materialize(items.where(vector_fault(dim).isNull()).select("item_id", "vector"))
    found = materialize(topk_weighted(usable, vectors, k, dim, fusion=fusion, exclude=seen))
    # wide columns join the k rows of each user, by ids that only these rows name
    metadata = F.struct(*[c for c in catalog.columns])
    chosen = catalog.join(found.select("item_id").distinct(), "item_id", "left_semi").select("item_id", metadata.alias("metadata"))
    rows = found.join(chosen, "item_id", "left").groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "item_id", "score", "metadata"))).alias("recommendations")
    )
    any_item = not vectors.isEmpty()
    out = users.select("user_id").distinct().join(state, "user_id", "left").join(rows, "user_id", "left")
    n = F.coalesce(F.size("recommendations"), F.lit(0))
    reason = (
        F.when(n > 0, None)
        .when(F.col("searchable").isNull(), "no_queries")
        .when(~F.col("searchable"), F.concat(F.lit("bad_vectors: "), F.col("first.fault")))
        .when(~F.col("weighed"), "bad_weights")
        .otherwise("all_seen" if any_item else "no_items")
    )
    none = F.array().cast(rows.schema["recommendations"].dataType)
    return out.select(
        "user_id", F.lit(SOURCE).alias("source"), n.cast("bigint").alias("n_recommendations"),
        F.coalesce("recommendations", none).alias("recommendations"), reason.cast("string").alias("reason"),
    )


def recommendation_rows(records: DataFrame) -> DataFrame:
    """One row per recommended item, and one with nulls for a user without any: what a table sink takes."""
    return records.select("user_id", "source", "reason", F.explode_outer("recommendations").alias("r")).select(
        "user_id", "source", "r.rank", "r.item_id", "r.score", "r.metadata", "reason"
    )
