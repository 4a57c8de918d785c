"""Vector post-processing and exact top-k retrieval.

Vector tables have a unique id and an ``array<float>``. Similarity is the dot
product of unit vectors, summed in double and rounded to six places; equal scores
are ordered by item id, so results do not depend on how the data is split.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from intentloom.functions import vectors as V
from intentloom.params import SIGNATURE_DECIMALS, UNIQUE_RATIO_MIN

SCORE_DECIMALS = 6
# Vector bytes of one side of a block: float64 copies of two such blocks and a
# slice of their score matrix fit a task.
BLOCK_BYTES = 48 << 20
# Scores held at once inside a task.
SCORE_CELLS = 4 << 20
# Queries whose scoring outweighs sending their task another copy of the items.
MIN_QUERIES = 2048


def truncate_vectors(df: DataFrame, dim: int | None, vector: str = "vector") -> DataFrame:
    """First ``dim`` values; rows that are too short get ``dim_error`` and no vector."""
    error = F.lit(None).cast("string")
    if dim is not None:
        size = F.coalesce(F.size(vector), F.lit(0))
        error = F.when(
            ~V.has_dim(vector, dim),
            F.concat(F.lit(f"output_dim {dim} > embedding dim "), size.cast("string")),
        )
    return df.withColumn("dim_error", error).withColumn(vector, V.cut(vector, dim))


def normalize_vectors(df: DataFrame, vector: str = "vector") -> DataFrame:
    return df.withColumn(vector, V.normalize(vector))


def vector_dim_check(df: DataFrame, dim: int, vector: str = "vector") -> DataFrame:
    return df.withColumn("dim_ok", F.coalesce(F.size(vector) == dim, F.lit(False)))


def vector_uniqueness(
    df: DataFrame,
    text: str = "text",
    vector: str = "vector",
    decimals: int = SIGNATURE_DECIMALS,
    min_ratio: float = UNIQUE_RATIO_MIN,
) -> DataFrame:
    """One row: distinct vectors per distinct text, and whether that is too few.

    A missing text or vector counts as a row, but is none of the distinct ones.
    Texts and vectors are compared through SHA-256 digests of their whole value.
    Each distinct is a partial aggregate of its own; a double count-distinct
    would expand every row twice before the shuffle.
    """
    digests = df.select(
        F.sha2(F.col(text), 256).alias("t"),
        F.when(F.col(vector).isNotNull(), V.signature(vector, decimals)).alias("v"),
    )

    def distinct(column: str, name: str) -> DataFrame:
        count = digests.select(column).where(F.col(column).isNotNull()).distinct().agg(F.count("*").alias("n"))
        return count.select(F.lit(name).alias("what"), "n")

    counts = (
        distinct("t", "n_texts")
        .unionByName(distinct("v", "n_vectors"))
        .unionByName(digests.agg(F.count("*").alias("n")).select(F.lit("n_rows").alias("what"), "n"))
    )

    def pick(name: str) -> Column:
        return F.max(F.when(F.col("what") == name, F.col("n"))).alias(name)

    one = counts.agg(pick("n_rows"), pick("n_texts"), pick("n_vectors"))
    skipped = (F.col("n_rows") <= 1) | (F.col("n_texts") <= 1)
    ratio = F.when(~skipped, F.col("n_vectors") / F.col("n_texts"))
    return one.withColumn("ratio", ratio).withColumn(
        "too_low", F.coalesce(F.col("ratio") < min_ratio, F.lit(False))
    )


def dot_scores(items: DataFrame, query: Column, vector: str = "vector") -> DataFrame:
    """Score of every item for one query vector: a map over the items.

    ``query`` is a scalar subquery (``DataFrame.scalar()``) or a literal array,
    so exactly one vector reaches the tasks.
    """
    return items.withColumn("_q", query).select(
        *[c for c in items.columns if c != vector],
        F.round(V.dot(vector, "_q"), SCORE_DECIMALS).alias("score"),
    )


# ---------------------------------------------------------------------------
# Top-k of many queries over many items
# ---------------------------------------------------------------------------


def _n_blocks(n_rows: int, dim: int, block_bytes: int) -> int:
    return max(1, math.ceil(n_rows * dim * 4 / block_bytes))


def _matrix(vectors: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim).astype(np.float64)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rounded score) of each row's k best; equal scores go by column.

    The k-th largest of the maxima of column groups is a lower bound of the k-th
    largest score, so two cheap passes leave few candidates to sort. The slack lets
    in whatever may round to the same value. Scores of -inf are not results.
    """
    n_rows, n = scores.shape
    starts = np.arange(0, n, max(1, n // max(64, 4 * k)))
    if k < len(starts):
        tops = np.fmax.reduceat(scores, starts, axis=1)  # fmax passes over NaN
        tops[np.isnan(tops)] = -np.inf
        limit = np.partition(tops, len(starts) - k, axis=1)[:, len(starts) - k, None]
        wanted = scores >= limit - 2 * 10.0**-SCORE_DECIMALS
    else:
        wanted = np.ones(scores.shape, dtype=bool)
    rows, cols = np.nonzero(wanted)
    values = np.round(scores[rows, cols], SCORE_DECIMALS)
    kept = np.isfinite(values)
    rows, cols, values = rows[kept], cols[kept], values[kept]
    order = np.lexsort((cols, -values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    first = np.searchsorted(rows, np.arange(n_rows))
    kept = np.arange(len(rows)) - first[rows] < k
    return rows[kept], cols[kept], values[kept]


def _max_per_group(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest value per column of each run of rows; faster than reduceat for short runs."""
    sizes = np.diff(first, append=len(rows))
    if sizes.max() == 1:
        return rows
    best = rows[first]
    for place in range(1, sizes.max()):
        longer = np.flatnonzero(sizes > place)
        best[longer] = np.fmax(best[longer], rows[first[longer] + place])
    return best


def _scorer(k: int, dim: int):
    """Local top-k of one block of queries in one block of items.

    The left table holds the block's queries and, with a null vector, the
    (owner, item) pairs to leave out. Of several queries of one owner an item
    gets the best weighted score.
    """
    schema = pa.schema(
        [("owner", pa.string()), ("item_id", pa.string()), ("score", pa.float64())]
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        queries = left.filter(pc.is_valid(left["query"])).sort_by("owner")
        hidden = left.filter(pc.is_null(left["query"]))
        items = right.sort_by("item_id")
        if queries.num_rows == 0 or items.num_rows == 0:
            return schema.empty_table()
        coded = queries["owner"].combine_chunks().dictionary_encode()
        owners, rows_of = coded.dictionary, coded.indices.to_numpy()
        item_ids = items["item_id"].combine_chunks()
        q, x = _matrix(queries["query"], dim), _matrix(items["vector"], dim)
        weight = queries["weight"].to_numpy()[:, None]
        first = np.flatnonzero(np.diff(rows_of, prepend=-1))  # each owner's first query
        ends = np.append(first[1:], len(rows_of))

        hide_o = pc.index_in(hidden["owner"].combine_chunks(), owners)
        hide_x = pc.index_in(hidden["item_id"].combine_chunks(), item_ids)
        both = pc.and_(pc.is_valid(hide_o), pc.is_valid(hide_x))
        hide_o = hide_o.filter(both).to_numpy(zero_copy_only=False)
        hide_x = hide_x.filter(both).to_numpy(zero_copy_only=False)
        order = np.argsort(hide_o, kind="stable")
        hide_o, hide_x = hide_o[order], hide_x[order]

        rows_at_once = max(1, SCORE_CELLS // x.shape[0])
        found = []
        lo = 0
        while lo < len(owners):
            hi = max(lo + 1, int(np.searchsorted(ends, first[lo] + rows_at_once, side="right")))
            best = None
            for at in range(first[lo], ends[hi - 1], rows_at_once):
                to = min(at + rows_at_once, ends[hi - 1])
                part = (q[at:to] * weight[at:to]) @ x.T
                if hi == lo + 1:  # one owner, perhaps in several slices
                    part = np.fmax.reduce(part, axis=0, keepdims=True)
                else:
                    part = _max_per_group(part, first[lo:hi] - at)
                best = part if best is None else np.fmax(best, part)
            a, b = np.searchsorted(hide_o, [lo, hi])
            best[hide_o[a:b] - lo, hide_x[a:b]] = -np.inf
            rows, cols, values = _best(best, k)
            found.append(
                pa.table(
                    [
                        owners.take(pa.array(rows + lo)),
                        item_ids.take(pa.array(cols)),
                        pa.array(values),
                    ],
                    schema=schema,
                )
            )
            lo = hi
        return pa.concat_tables(found)

    return score


def _candidates(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    dim: int,
    exclude: DataFrame | None,
    block_bytes: int,
    one_each: bool,
) -> DataFrame:
    """Best k items of each owner in every block: (owner, item_id, score).

    Queries are hashed by (owner, slot) and items by id into blocks of bounded
    bytes. Every (query block, item block) cell is one task-sized matrix product
    that keeps k rows per owner, so the pairs themselves never exist as rows and
    nothing is broadcast. Blocks follow unique ids, so copies of a vector, or an
    owner with very many queries, spread evenly. ``one_each`` says that every
    owner has the single slot 1.
    """
    # Row counts need no column, so a stored table answers them from file footers.
    n_queries = queries.count()
    nq = _n_blocks(n_queries, dim, block_bytes)
    nx = _n_blocks(items.count(), dim, block_bytes)
    # Few blocks would leave cores idle; more query blocks only repeat the items.
    cores = queries.sparkSession.sparkContext.defaultParallelism
    nq = max(nq, min(4 * cores // nx, n_queries // MIN_QUERIES))
    queries, items = _usable(queries, dim), _usable(items, dim)

    def block(n: int, *keys: str) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")

    placed = queries.withColumn("qb", block(nq, "owner", "slot"))
    left = placed.select(
        "owner", F.lit(None).cast("string").alias("item_id"), F.col("vector").alias("query"), "weight",
        "qb",
        F.explode(F.sequence(F.lit(0), F.lit(nx - 1))).alias("xb"),
    )
    if exclude is not None:
        if one_each or nq == 1:
            where = exclude.withColumn("slot", F.lit(1)).withColumn("qb", block(nq, "owner", "slot"))
        else:  # a pair goes to each block its owner has queries in, at most nq
            where = exclude.join(placed.select("owner", "qb").distinct(), "owner")
        hidden = where.select(
            "owner", "item_id",
            F.lit(None).cast(queries.schema["vector"].dataType).alias("query"),
            F.lit(None).cast("double").alias("weight"),
            "qb", block(nx, "item_id").alias("xb"),
        )
        left = left.unionByName(hidden)
    right = items.select(
        "item_id", "vector",
        F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("qb"),
        block(nx, "item_id").alias("xb"),
    )
    cells = left.groupBy("qb", "xb").cogroup(right.groupBy("qb", "xb"))
    return cells.applyInArrow(_scorer(k, dim), "owner string, item_id string, score double")


def _usable(df: DataFrame, dim: int) -> DataFrame:
    return df.where(F.size("vector") == dim)


def _rank(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("owner").orderBy(F.desc("score"), F.asc("item_id"))
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("owner", "rank", "item_id", "score")


def topk_items(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    dim: int,
    *,
    exclude: DataFrame | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact top-k items per query. ``queries``: query_id, vector; ``items``: item_id,
    vector; ``exclude``: (query_id, item_id) pairs that must not be returned."""
    single = queries.select(
        F.col("query_id").alias("owner"), F.lit(1).alias("slot"), "vector", F.lit(1.0).alias("weight")
    )
    hidden = None if exclude is None else exclude.withColumnRenamed("query_id", "owner")
    found = _candidates(single, items, k, dim, hidden, block_bytes, one_each=True)
    return _rank(found, k).withColumnRenamed("owner", "query_id")


def topk_weighted(
    slots: DataFrame,
    items: DataFrame,
    k: int,
    dim: int,
    *,
    fusion: str = "max",
    exclude: DataFrame | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact top-k items per user over that user's weighted query slots.

    ``slots``: user_id, slot, weight (not negative), vector; ``exclude``:
    (user_id, item_id). Both fusions are exact on local top-k lists. With
    ``max``, an item among the best k of a user is among the best k of the block
    that gives it its score. With ``sum``, the weighted sum of products is the
    product with the weighted sum of the slot vectors, so each user becomes one
    query.
    """
    queries = slots.withColumnRenamed("user_id", "owner")
    if fusion == "sum":
        queries = _fused(_usable(queries, dim), dim)
    elif fusion != "max":
        raise ValueError(f"unknown fusion {fusion!r}")
    hidden = None if exclude is None else exclude.withColumnRenamed("user_id", "owner")
    found = _candidates(queries, items, k, dim, hidden, block_bytes, one_each=fusion == "sum")
    if fusion == "max":  # an owner's queries may sit in several blocks
        found = found.groupBy("owner", "item_id").agg(F.max("score").alias("score"))
    return _rank(found, k).withColumnRenamed("owner", "user_id")


def _fused(slots: DataFrame, dim: int) -> DataFrame:
    """One vector per owner: the weighted sum over slots, summed in parts before the shuffle."""
    parts = [
        F.sum(F.col("weight") * F.get("vector", F.lit(i)).cast("double")).alias(f"v{i}")
        for i in range(dim)
    ]
    summed = slots.groupBy("owner").agg(*parts)
    vector = F.array(*[F.col(f"v{i}") for i in range(dim)])  # doubles, not rounded again
    return summed.select(
        "owner", F.lit(1).alias("slot"), vector.alias("vector"), F.lit(1.0).alias("weight")
    )
