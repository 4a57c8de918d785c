"""A stored vector index: block files with centre and radius, and exact top-k that skips blocks.

Similar vectors are put into the same cell, the nearest of a bounded number of pivots, and a cell is
cut into blocks of bounded bytes, so a hot direction only makes more blocks. A block is one folder
of the table. For a query ``q`` no vector of a block can score more than ``q . centre + |q| * radius``.

A search scores the few blocks with the best centres first. Their k-th score is a floor, and only
blocks that may hold something above it are read for that query. Results are exact: equal to a scan of
all blocks, whatever the pivots are; they decide only how much is skipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from intentloom.operators.models import materialize
from intentloom.operators.retrieval import SCORE_DECIMALS, _matrix, _n_blocks, _rank, _scorer, topk_items

DOCUMENT, QUERY = "document", "query"
BLOCK_BYTES = 32 << 20
# Bytes of the vectors that pivots are fitted on, and the most pivots; both reach the driver.
SAMPLE_BYTES = 16 << 20
MAX_PIVOTS = 1024
# Queries scored against one block by one task.
QUERIES_PER_TASK = 8192
PROBES = 3
# Scores within this of the floor may still round to it.
SLACK = 2 * 10.0**-SCORE_DECIMALS


@dataclass(frozen=True)
class VectorIndex:
    """``vectors`` (block, item_id, vector), ``blocks`` (block, n, centre, radius), ``rejected`` (item_id, reason)."""

    vectors: DataFrame
    blocks: DataFrame
    rejected: DataFrame
    dim: int


def vector_fault(dim: int, vector: str = "vector") -> Column:
    """Why a vector can't be searched, or null."""
    size = F.coalesce(F.size(vector), F.lit(0))
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return (
        F.when(F.col(vector).isNull(), "missing")
        .when(size != dim, F.concat(F.lit(f"size is not {dim}: "), size.cast("string")))
        .when(odd, "not finite")
    )


def _pivots(vectors: DataFrame, n_cells: int, dim: int) -> np.ndarray:
    """Centres of the cells, from a sample by hash of id whose bytes are bounded."""
    rows = max(n_cells, min(16 * n_cells, SAMPLE_BYTES // (8 * dim)))
    sample = vectors.orderBy(F.xxhash64("item_id"), "item_id").limit(rows).select("vector").toArrow()
    if not sample.num_rows:
        return np.zeros((1, dim))
    x = np.unique(_matrix(sample["vector"], dim), axis=0)
    x = x[np.random.default_rng(1).permutation(len(x))]
    pivots = x[:n_cells].copy()
    for _ in range(4):
        near = _nearest(x, pivots)
        for c in np.unique(near):
            pivots[c] = x[near == c].mean(axis=0)
    return pivots


def _nearest(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    half = (pivots * pivots).sum(axis=1) / 2
    out = np.empty(len(x), np.int64)
    for at in range(0, len(x), 4096):
        out[at : at + 4096] = (x[at : at + 4096] @ pivots.T - half).argmax(axis=1)
    return out


def _centre(block: pa.Table) -> pa.Table:
    """Centre and radius of one block, whose bytes are bounded."""
    x = np.stack(block["vector"].to_numpy(zero_copy_only=False)).astype(np.float64)
    centre = x.mean(axis=0)
    radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))
    return pa.table(
        {"block": block["block"][:1], "n": [len(x)], "centre": [centre.tolist()], "radius": [radius * (1 + 1e-9)]},
        schema=pa.schema([("block", pa.int64()), ("n", pa.int64()), ("centre", pa.list_(pa.float64())), ("radius", pa.float64())]),
    )


def write_index(vectors: DataFrame, path: str, dim: int, *, task: str = DOCUMENT, model_name: str = "", block_bytes: int = BLOCK_BYTES) -> VectorIndex:
    """Store vectors (item_id, vector) with their task and model, and return the index over the files.

    Every row is indexed or is a row of ``rejected`` with a reason. Ids are expected to be unique; a
    repeated id is two items of one name.
    """
    spark = vectors.sparkSession
    checked = vectors.select("item_id", "vector", vector_fault(dim).alias("reason"))
    checked.where("reason is not null").select("item_id", "reason").write.mode("overwrite").parquet(f"{path}/rejected")
    good = checked.where("reason is null").select("item_id", "vector")
    n = good.count()
    cells = min(MAX_PIVOTS, _n_blocks(n, dim, block_bytes))
    sent = spark.sparkContext.broadcast(_pivots(good, cells, dim))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = _nearest(_matrix(pa.chunked_array([batch.column(1)]), dim), sent.value)
                yield batch.append_column("cell", pa.array(cell))

    kind = good.schema["vector"].dataType.simpleString()
    celled = materialize(good.mapInArrow(near, f"item_id string, vector {kind}, cell long"))
    per_block = max(1, block_bytes // (4 * dim))
    # a row for each pivot at most
    parts = celled.groupBy("cell").count().select("cell", F.ceil(F.col("count") / per_block).cast("long").alias("parts"))
    placed = celled.join(F.broadcast(parts), "cell").select(
        (F.col("cell") * (1 << 32) + F.pmod(F.xxhash64("item_id"), F.col("parts"))).alias("block"),
        "item_id", "vector", F.lit(task).alias("task"), F.lit(model_name).alias("model_name"),
    )
    placed.repartition("block").write.mode("overwrite").partitionBy("block").parquet(f"{path}/vectors")
    stored = spark.read.schema(placed.schema).parquet(f"{path}/vectors").select("block", "item_id", "vector")
    made = stored.groupBy("block").applyInArrow(_centre, "block long, n long, centre array<double>, radius double")
    made.withColumn("dim", F.lit(dim)).write.mode("overwrite").parquet(f"{path}/blocks")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> VectorIndex:
    blocks = spark.read.parquet(f"{path}/blocks")
    first = blocks.select("dim").first()
    vectors = spark.read.parquet(f"{path}/vectors") if first else None
    empty = spark.createDataFrame([], "block long, item_id string, vector array<float>")
    return VectorIndex(
        vectors.select(F.col("block").cast("long"), "item_id", "vector") if first else empty,
        blocks.drop("dim"), spark.read.parquet(f"{path}/rejected"), first[0] if first else 0,
    )


def search(
    index: VectorIndex, queries: DataFrame, k: int, *, exclude: DataFrame | None = None,
    probes: int = PROBES, queries_per_task: int = QUERIES_PER_TASK,
) -> DataFrame:
    """(query_id, rank, item_id, score): exact top-k of queries (query_id, vector) over the index.

    ``exclude`` has (query_id, item_id) pairs not to return. Queries whose vector can't be searched have no
    rows; :func:`vector_fault` says why.
    """
    queries = materialize(queries.where(vector_fault(index.dim).isNull()).select(F.col("query_id").alias("owner"), "vector"))
    hidden = None
    if exclude is not None:
        hidden = exclude.select(F.col("query_id").alias("owner"), "item_id").distinct()
        hidden = materialize(hidden.join(queries.select("owner"), "owner", "left_semi").join(index.vectors.select("item_id", "block"), "item_id"))
    centres = index.blocks.select(F.col("block").cast("string").alias("item_id"), F.col("centre").alias("vector"))
    near = topk_items(queries.withColumnRenamed("owner", "query_id"), centres, probes, index.dim)
    first = materialize(near.select(F.col("query_id").alias("owner"), F.col("item_id").cast("long").alias("block")))
    found = materialize(_score_pairs(first, queries, index, k, hidden, queries_per_task))
    floor = _rank(found, k).where(F.col("rank") == k).select("owner", F.col("score").alias("floor"))
    known = materialize(queries.join(floor, "owner", "left"))
    rest = surviving(known, index).join(first, ["owner", "block"], "left_anti")
    more = _score_pairs(materialize(rest), known, index, k, hidden, queries_per_task)
    return _rank(found.unionByName(more), k).withColumnRenamed("owner", "query_id")


def surviving(queries: DataFrame, index: VectorIndex, cells: int | None = None) -> DataFrame:
    """(owner, block) of the blocks that may hold a score above the query's ``floor``; all if that is null.

    Queries meet centres as blocks of both, one matrix product a task; only pairs that survive become rows.
    """
    dim = index.dim
    nq = cells or max(1, _n_blocks(queries.count(), dim, BLOCK_BYTES))
    nx = cells or max(1, _n_blocks(index.blocks.count(), dim, BLOCK_BYTES))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("owner", pa.string()), ("block", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        q, c = _matrix(left["vector"], dim), _matrix(right["centre"], dim)
        radius = right["radius"].to_numpy()
        floor = pc.fill_null(left["floor"], -math.inf).to_numpy()
        size = np.sqrt((q * q).sum(axis=1))
        out = []
        for at in range(0, len(q), 1024):
            best = q[at : at + 1024] @ c.T + size[at : at + 1024, None] * radius
            rows, cols = np.nonzero(best >= floor[at : at + 1024, None] - SLACK)
            out.append(pa.table([left["owner"].take(pa.array(rows + at)), right["block"].take(pa.array(cols))], schema=schema))
        return pa.concat_tables(out)

    def cell(n: int, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.select("owner", "vector", "floor", cell(nq, "owner").alias("qb"), each(nx).alias("xb"))
    right = index.blocks.select("block", "centre", "radius", cell(nx, "block").alias("xb"), each(nq).alias("qb"))
    return left.groupBy("qb", "xb").cogroup(right.groupBy("qb", "xb")).applyInArrow(meet, "owner string, block long")


def _score_pairs(pairs: DataFrame, queries: DataFrame, index: VectorIndex, k: int, hidden: DataFrame | None, per_task: int) -> DataFrame:
    """Best k items of each owner in each of its blocks, but none below its ``floor`` if queries have one.

    The queries of a popular block are dealt to several tasks.
    """
    if "floor" not in queries.columns:
        queries = queries.withColumn("floor", F.lit(None).cast("double"))
    asked = pairs.groupBy("block").count().select("block", F.ceil(F.col("count") / per_task).cast("int").alias("parts"))
    asked = materialize(asked)
    part = F.pmod(F.xxhash64("owner"), F.col("parts")).cast("int").alias("part")
    left = pairs.join(asked, "block").join(queries, "owner").select(
        "owner", F.lit(None).cast("string").alias("item_id"), F.col("vector").alias("query"), F.lit(1.0).alias("weight"), "floor", "block", part
    )
    if hidden is not None:
        gone = hidden.join(pairs, ["owner", "block"], "left_semi").join(asked, "block")
        left = left.unionByName(gone.select(
            "owner", "item_id", F.lit(None).cast(queries.schema["vector"].dataType).alias("query"), F.lit(None).cast("double").alias("weight"), F.lit(None).cast("double").alias("floor"), "block", part,
        ))
    right = index.vectors.join(asked, "block").select(
        "item_id", "vector", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    score = _scorer(k, index.dim)

    def above(asked: pa.Table, items: pa.Table) -> pa.Table:
        best = score(asked, items)
        asked = asked.filter(pc.is_valid(asked["query"]))
        at = pc.index_in(best["owner"], asked["owner"].combine_chunks())
        least = pc.fill_null(asked["floor"], -math.inf).take(at)
        return best.filter(pc.greater_equal(best["score"], pc.subtract(least, SLACK)))

    cells = left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
    return cells.applyInArrow(above, "owner string, item_id string, score double")
