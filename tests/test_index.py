"""The stored vector index against brute force, what it skips, and recommendation records."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from intentloom.operators import recommend as RC, retrieval as R, vector_index as VI

DIM = 8


def clustered(n: int, seed: int = 0) -> list[tuple[str, list[float]]]:
    """Vectors around a few directions; a third of all are one and the same."""
    r = np.random.default_rng(seed)
    middles = r.normal(size=(12, DIM))
    out = middles[r.integers(12, size=n)] + 0.05 * r.normal(size=(n, DIM))
    out[: n // 3] = middles[0]
    out /= np.linalg.norm(out, axis=1, keepdims=True)
    return [(f"i{i:04d}", v.astype(np.float32).tolist()) for i, v in enumerate(out)]


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(clustered(900), "item_id string, vector array<float>").repartition(4)


@pytest.fixture(scope="module")
def index(spark, vectors, tmp_path_factory):
    return VI.write_index(vectors, str(tmp_path_factory.mktemp("index") / "x"), DIM, model_name="m", block_bytes=2000)


def rows(df):
    return sorted((r.query_id, r.rank, r.item_id, round(r.score, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def queries(spark):
    some = [(f"q{i}", v) for i, (_, v) in enumerate(clustered(60, 1))]
    return spark.createDataFrame([*some, ("long", [3.0] * DIM), ("zero", [0.0] * DIM)], "query_id string, vector array<float>")


@pytest.mark.parametrize("k, per_task", [(1, 8192), (5, 8192), (400, 7)])
def test_search_equals_a_scan_of_all(vectors, index, queries, k, per_task):
    hidden = queries.select("query_id").crossJoin(vectors.select("item_id").where("item_id < 'i0020'"))
    for exclude in (None, hidden):
        got = VI.search(index, queries, k, exclude=exclude, queries_per_task=per_task)
        assert rows(got) == rows(R.topk_items(queries, vectors, k, DIM, exclude=exclude))


def test_blocks_are_bounded_and_hold_their_vectors(vectors, index):
    blocks = {b.block: b for b in index.blocks.collect()}
    assert sum(b.n for b in blocks.values()) == 900 and max(b.n for b in blocks.values()) < 2 * 2000 // (4 * DIM)
    for r in index.vectors.collect():
        b = blocks[r.block]
        assert np.linalg.norm(np.array(r.vector) - b.centre) <= b.radius + 1e-12


@pytest.mark.parametrize("cells", [1, 3])
def test_skipped_blocks_cannot_matter(vectors, index, queries, cells):
    best = R.topk_items(queries, vectors, 5, DIM)
    floor = {r.query_id: r.score for r in best.where("rank = 5").collect()}
    asked = queries.select(F.col("query_id").alias("owner"), "vector").join(
        best.where("rank = 5").select(F.col("query_id").alias("owner"), F.col("score").alias("floor")), "owner", "left"
    )
    kept = {(r.owner, r.block) for r in VI.surviving(asked, index, cells).collect()}
    in_block = {}
    for r in index.vectors.collect():
        in_block.setdefault(r.block, []).append(r.vector)
    skipped = 0
    for q in queries.collect():
        for block, xs in in_block.items():
            if (q.query_id, block) not in kept:
                skipped += 1
                assert max(np.round(np.array(xs, np.float64) @ np.array(q.vector, np.float64), 6)) < floor[q.query_id]
    assert skipped > len(kept)


def test_no_floor_keeps_every_block(index, queries):
    asked = queries.select(F.col("query_id").alias("owner"), "vector", F.lit(None).cast("double").alias("floor"))
    assert VI.surviving(asked, index).count() == queries.count() * index.blocks.count()


def test_faulty_vectors_are_rows_with_a_reason(spark, tmp_path):
    odd = [("a", [1.0, 2.0]), ("b", [1.0]), ("c", None), ("d", [float("nan"), 1.0]), ("e", [float("inf"), 1.0]), ("f", [None, 1.0]), ("g", [])]
    df = spark.createDataFrame(odd, "item_id string, vector array<float>")
    index = VI.write_index(df, str(tmp_path / "i"), 2, task=VI.QUERY)
    assert [r.item_id for r in index.vectors.collect()] == ["a"]
    assert {r.item_id: r.reason for r in index.rejected.collect()} == {
        "b": "size is not 2: 1", "c": "missing", "d": "not finite", "e": "not finite", "f": "not finite", "g": "size is not 2: 0",
    }
    assert {(r.task, r.model_name) for r in spark.read.parquet(str(tmp_path / "i/vectors")).collect()} == {("query", "")}
    again = VI.read_index(spark, str(tmp_path / "i"))
    asked = df.withColumnRenamed("item_id", "query_id")
    assert rows(VI.search(again, asked, 3)) == [("a", 1, "a", 5.0)]


def test_an_empty_index_finds_nothing(spark, tmp_path, queries):
    none = spark.createDataFrame([], "item_id string, vector array<float>")
    index = VI.write_index(none, str(tmp_path / "none"), DIM)
    assert VI.search(index, queries, 3).collect() == []
    assert VI.read_index(spark, str(tmp_path / "none")).vectors.count() == 0


CATALOG = "item_id string, title string, views long"


def people(spark):
    users = spark.createDataFrame([(u,) for u in ("new", "bad", "unweighed", "seen", "some", "some")], "user_id string")
    slots = spark.createDataFrame(
        [("bad", 1, 1.0, [1.0]), ("bad", 2, 1.0, None), ("unweighed", 1, None, [1.0, 0.0]), ("unweighed", 2, float("nan"), [1.0, 0.0]),
         ("unweighed", 3, -1.0, [1.0, 0.0]), ("seen", 1, 1.0, [1.0, 0.0]), ("some", 1, 1.0, [1.0, 0.0]), ("some", 2, 0.5, [0.0, 1.0]), ("some", 3, None, [5.0, 5.0]),
         ("stranger", 1, 1.0, [1.0, 0.0])],
        "user_id string, slot int, weight double, vector array<float>",
    )
    items = spark.createDataFrame([("x", [0.8, 0.6]), ("y", [0.0, 1.0]), ("z", [0.6, 0.8]), ("short", [1.0])], "item_id string, vector array<float>")
    catalog = spark.createDataFrame([("x", "Title X", 3), ("z", None, 0), ("other", "O", 1)], CATALOG)
    seen = spark.createDataFrame([("seen", i) for i in "xyz"] + [("some", "z")], "user_id string, item_id string")
    return users, slots, items, catalog, seen


def test_every_user_has_a_record_with_items_or_a_reason(spark):
    users, slots, items, catalog, seen = people(spark)
    got = {r.user_id: r for r in RC.recommend(users, slots, items, catalog, 5, 2, seen=seen).collect()}
    assert {u: r.reason for u, r in got.items()} == {
        "new": "no_queries", "bad": "bad_vectors: size is not 2: 1", "unweighed": "bad_weights", "seen": "all_seen", "some": None,
    }
    assert [(r.rank, r.item_id, round(r.score, 6), r.metadata and r.metadata.title) for r in got["some"].recommendations] == [
        (1, "x", 0.8, "Title X"), (2, "y", 0.5, None),
    ]
    assert got["some"].n_recommendations == 2 and got["seen"].recommendations == []


def test_records_without_items_and_as_rows(spark):
    users, slots, items, catalog, _ = people(spark)
    none = RC.recommend(users, slots, items.where("item_id = 'short'"), catalog, 5, 2)
    assert {r.user_id: r.reason for r in none.collect()}["some"] == "no_items"
    flat = RC.recommendation_rows(RC.recommend(users, slots, items, catalog, 2, 2, fusion="sum")).collect()
    assert [(r.rank, r.item_id, round(r.score, 6)) for r in flat if r.user_id == "some"] == [(1, "x", 1.1), (2, "z", 1.0)]
    assert [(r.rank, r.item_id, r.reason) for r in flat if r.user_id == "new"] == [(None, None, "no_queries")]
