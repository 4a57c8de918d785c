import numpy as np
import pytest

from intentloom.operators import retrieval as R

DIM = 8


def table(spark, ids, matrix, name):
    rows = [(str(i), [float(x) for x in v]) for i, v in zip(ids, matrix, strict=True)]
    return spark.createDataFrame(rows, f"{name} string, vector array<float>")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    items = rng.normal(size=(120, DIM)).astype(np.float32)
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    items[40:80] = items[40]  # a third of the items are copies: many equal scores
    queries = rng.normal(size=(30, DIM)).astype(np.float32)
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    queries[10:20] = items[40]
    return queries, items


def brute(scores, k, hidden=()):
    """{query: [(item, score)]} by score, then item id as text."""
    out = {}
    for q, row in scores.items():
        ranked = sorted(((-s, i) for i, s in row.items() if (q, i) not in hidden))
        if ranked:
            out[q] = [(i, -s) for s, i in ranked[:k]]
    return out


def collected(df, key):
    out = {}
    for r in df.orderBy(key, "rank").collect():
        out.setdefault(r[key], []).append((r.item_id, r.score))
    return out


def scores_of(queries, items, weights=None):
    q, x = queries.astype(np.float64), items.astype(np.float64)
    s = q @ x.T
    if weights is not None:
        s = s * weights[:, None]
    return np.round(s, 6)


# one block, or about 4 query by 15 item blocks
BLOCKS = [R.BLOCK_BYTES, 8 * 4 * DIM]


@pytest.mark.parametrize("block_bytes", BLOCKS)
@pytest.mark.parametrize("hide", [False, True])
def test_topk_equals_brute_force(spark, data, block_bytes, hide):
    queries, items = data
    s = scores_of(queries, items)
    table_of = {str(q): {str(i): s[q, i] for i in range(len(items))} for q in range(len(queries))}
    hidden = {(str(q), str(i)) for q in range(30) for i in range(120) if (q * i) % 3 == 0} if hide else set()
    exclude = spark.createDataFrame(sorted(hidden), "query_id string, item_id string") if hide else None
    found = R.topk_items(
        table(spark, range(30), queries, "query_id"), table(spark, range(120), items, "item_id"),
        7, DIM, exclude=exclude, block_bytes=block_bytes,
    )
    assert collected(found, "query_id") == brute(table_of, 7, hidden)


def user_slots(spark, queries, weights):
    rows = [
        (f"u{n // 5}", n % 5 + 1, float(weights[n]), [float(x) for x in q]) for n, q in enumerate(queries)
    ]
    return spark.createDataFrame(rows, "user_id string, slot int, weight double, vector array<float>")


@pytest.mark.parametrize("block_bytes", BLOCKS)
@pytest.mark.parametrize("fusion", ["max", "sum"])
def test_weighted_fusion_equals_brute_force(spark, data, block_bytes, fusion):
    queries, items = data
    weights = np.array([1.0, 1.0, 0.8, 0.6, 0.6] * 6)
    s = scores_of(queries, items, weights)
    if fusion == "sum":
        fused = (queries.astype(np.float64) * weights[:, None]).reshape(6, 5, DIM).sum(axis=1)
        per_user = np.round(fused @ items.astype(np.float64).T, 6)
    else:
        per_user = s.reshape(6, 5, -1).max(axis=1)
    table_of = {f"u{u}": {str(i): per_user[u, i] for i in range(120)} for u in range(6)}
    hidden = {("u1", str(i)) for i in range(0, 120, 2)}
    exclude = spark.createDataFrame(sorted(hidden), "user_id string, item_id string")
    found = R.topk_weighted(
        user_slots(spark, queries, weights), table(spark, range(120), items, "item_id"),
        5, DIM, fusion=fusion, exclude=exclude, block_bytes=block_bytes,
    )
    got, want = collected(found, "user_id"), brute(table_of, 5, hidden)
    assert {u: [i for i, _ in v] for u, v in got.items()} == {u: [i for i, _ in v] for u, v in want.items()}
    for u in want:
        assert np.allclose([x for _, x in got[u]], [x for _, x in want[u]], atol=2e-6)


def test_one_owner_may_hold_most_queries(spark, data):
    queries, items = data
    many = np.concatenate([queries] * 20)
    slots = spark.createDataFrame(
        [("hot" if n < 500 else f"u{n}", n, 1.0, [float(x) for x in q]) for n, q in enumerate(many)],
        "user_id string, slot int, weight double, vector array<float>",
    )
    found = R.topk_weighted(
        slots, table(spark, range(120), items, "item_id"), 3, DIM, block_bytes=40 * 4 * DIM
    )
    best = scores_of(queries, items).max(axis=0)
    want = brute({"hot": {str(i): best[i] for i in range(120)}}, 3)
    assert collected(found.where("user_id = 'hot'"), "user_id") == want
    assert found.select("user_id").distinct().count() == 101


def test_score_slices_of_a_block_agree(spark, data, monkeypatch):
    """Scores are worked out in slices; tiny slices give the same result."""
    import pyarrow as pa

    queries, items = data
    left = pa.table(
        {
            "owner": [f"u{n // 5}" for n in range(30)] + ["u1"],
            "item_id": [None] * 30 + ["3"],
            "query": [list(map(float, q)) for q in queries] + [None],
            "weight": [1.0] * 30 + [None],
        }
    )
    right = pa.table({"item_id": [str(i) for i in range(120)], "vector": [list(map(float, x)) for x in items]})
    whole = R._scorer(4, DIM)(left, right).sort_by([("owner", "ascending"), ("item_id", "ascending")])
    for cells in (1, 120 * 3, 120 * 7):
        monkeypatch.setattr(R, "SCORE_CELLS", cells)
        part = R._scorer(4, DIM)(left, right).sort_by([("owner", "ascending"), ("item_id", "ascending")])
        assert part.equals(whole)


def test_fewer_items_than_k(spark, data):
    queries, items = data
    found = R.topk_items(
        table(spark, range(2), queries[:2], "query_id"), table(spark, range(3), items[:3], "item_id"), 5, DIM
    )
    assert found.count() == 6


def test_wrong_sizes_are_left_out(spark):
    items = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [1.0]), ("c", None)], "item_id string, vector array<float>"
    )
    found = R.topk_items(items.withColumnRenamed("item_id", "query_id"), items, 3, 2)
    assert [(r.query_id, r.item_id) for r in found.collect()] == [("a", "a")]


def test_dot_scores(spark, data):
    queries, items = data
    one = table(spark, [0], queries[:1], "query_id").select("vector").scalar()
    got = {r.item_id: r.score for r in R.dot_scores(table(spark, range(120), items, "item_id"), one).collect()}
    want = scores_of(queries[:1], items)[0]
    assert all(abs(got[str(i)] - want[i]) < 2e-6 for i in range(120))


def test_cut_then_unit_length(spark, data):
    _, items = data
    wide = table(spark, ["zero", "short", *range(5)], [[0.0] * DIM, [1.0], *(items[:5] * 3)], "item_id")
    done = R.normalize_vectors(R.truncate_vectors(wide, 4))
    rows = {r.item_id: r for r in done.collect()}
    assert rows["zero"].vector == [0.0] * 4 and rows["zero"].dim_error is None
    assert rows["short"].vector is None
    assert rows["short"].dim_error == "output_dim 4 > embedding dim 1"
    for i in range(5):
        want = items[i, :4] / np.linalg.norm(items[i, :4])
        assert np.allclose(rows[str(i)].vector, want, atol=1e-6)
    assert R.truncate_vectors(wide, None).first().dim_error is None
    with pytest.raises(ValueError):
        R.truncate_vectors(wide, 0)
    checked = {r.item_id: r.dim_ok for r in R.vector_dim_check(wide, DIM).collect()}
    assert checked["zero"] and not checked["short"]


def test_unit_length_of_null_and_empty_vectors(spark):
    df = spark.createDataFrame([("a", None), ("b", []), ("c", [3.0, 4.0])], "id string, vector array<float>")
    got = {r.id: r.vector for r in R.normalize_vectors(df).collect()}
    assert got["a"] is None and got["b"] == [] and np.allclose(got["c"], [0.6, 0.8])


@pytest.mark.parametrize(
    "vectors, texts, ratio, too_low",
    [
        (17, 20, 0.85, False),  # exactly the limit passes
        (16, 20, 0.8, True),
        (1, 1, None, False),
        (20, 1, None, False),  # one distinct text: nothing to compare
    ],
)
def test_uniqueness_guard(spark, vectors, texts, ratio, too_low):
    n = max(vectors, texts)
    rows = [(f"t{i % texts}", [float(i % vectors), 1.0]) for i in range(n)]
    row = R.vector_uniqueness(spark.createDataFrame(rows, "text string, vector array<float>")).first()
    assert row.ratio == ratio and row.too_low is too_low


def test_uniqueness_without_text_or_vector(spark):
    rows = [("a", [1.0]), ("b", [2.0]), ("c", None), (None, [2.0]), (None, None)]
    row = R.vector_uniqueness(spark.createDataFrame(rows, "text string, vector array<float>")).first()
    assert (row.n_rows, row.n_texts, row.n_vectors) == (5, 3, 2) and row.too_low


def test_fusion_name_is_checked(spark, data):
    slots = user_slots(spark, data[0], np.ones(30))
    with pytest.raises(ValueError):
        R.topk_weighted(slots, table(spark, range(120), data[1], "item_id"), 3, DIM, fusion="mean")


def test_a_vector_with_nan_hides_only_itself(spark, data):
    queries, items = data
    broken = items.copy()
    broken[5, 0] = np.nan
    found = R.topk_items(
        table(spark, range(30), queries, "query_id"), table(spark, range(120), broken, "item_id"), 7, DIM
    )
    s = scores_of(queries, items)
    table_of = {str(q): {str(i): s[q, i] for i in range(120) if i != 5} for q in range(30)}
    assert collected(found, "query_id") == brute(table_of, 7)
