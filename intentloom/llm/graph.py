"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from intentloom.llm.runtime import stored

#: Links that a task holds at a time.
_HELD = 1_000_000


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each end of the links but the smallest of its component among them, and that smallest."""
    ids, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(ids))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    far = np.flatnonzero(root != np.arange(len(ids)))
    return ids[far], ids[root[far]]


def _star_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links (u, v) of a task, at most ``_HELD`` at a time, as stars around the smallest end of each component among them."""
    held, n = [], 0

    def done():
        u, v = _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        for s in range(0, batch.num_rows, _HELD):
            part = batch.slice(s, _HELD)
            if n and n + part.num_rows > _HELD:
                yield done()
                held, n = [], 0
            held.append((part.column(0).to_numpy(), part.column(1).to_numpy()))
            n += part.num_rows
    if n:
        yield done()


def _near(links: DataFrame) -> DataFrame:
    """Links (u, v) made stars where they lie: no row moves, and components stay."""
    return links.mapInArrow(_star_rows, "u long, v long")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every end of a link; component_id is the smallest id reachable.

    Each round makes stars of the links that a task reads, so a node has one link from a task; then each node
    hands its smallest neighbour on to the others, and links to a node move on to that node's smallest neighbour,
    so long chains halve. Rows meet by the larger end, which has one link from each task, and by a join that
    Spark can split, so hubs never gather their neighbours in one row or window. Each round is a stored
    table of at most as many rows as there are links; the rounds grow with the logarithm of the
    longest chain. Only counts and sums reach the driver, taken while a round is written.
    """
    edges = stored(
        _near(links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u <> v")), "links"
    )
    before = None
    while True:
        low = edges.select("u", "v", F.min("v").over(W.partitionBy("u")).alias("m"))
        small = low.select(F.inline(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).where("u <> v")
        up = small.groupBy("u").agg(F.min("v").alias("to")).withColumnRenamed("u", "v")
        moved = small.join(up, "v", "left").select("u", F.coalesce("to", "v").alias("v"))
        seen = Observation()
        edges = stored(
            _near(moved).observe(
                seen, F.count(F.lit(1)).alias("n"), F.sum(F.col("u").cast("decimal(38,0)")).alias("u"),
                F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            ),
            "links",
        )
        now = seen.get
        if now == before:
            break
        before = now
    out = edges.groupBy("u").agg(F.min("v").alias("component_id")).withColumnRenamed("u", "id")
    roots = out.select(F.col("component_id").alias("id"), "component_id").distinct()
    return out.union(roots)


def merged(groups: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """:func:`components` of the links behind ``groups`` and of further ``links``: only the links between groups are walked."""
    ends = links.select(F.explode(F.array(a, b)).alias("id")).distinct().join(groups, "id", "left_anti")
    known = stored(groups.select("id", "component_id").union(ends.select("id", F.col("id").alias("component_id"))), "known")
    between = links.select(F.col(a).alias("a"), F.col(b).alias("b")).join(known.toDF("a", "u"), "a").join(known.toDF("b", "v"), "b")
    roots = components(between, "u", "v").toDF("component_id", "root")
    return known.join(roots, "component_id", "left").select("id", F.coalesce("root", "component_id").alias("component_id"))
