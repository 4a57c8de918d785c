from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from intentloom.functions.offline_models import hashing_embedder, template_generator
from intentloom.operators import context as C, models as M
from intentloom.params import TEMPLATES, JobParams
from intentloom.plans import refresh
from intentloom.sources import schemas

T0 = datetime(2026, 1, 1)
PARAMS = JobParams(output_dim=16, history_threshold=3)


def profile(user, language="en"):
    return (user, language, None, "year1", "Engineering", "Electrical", "KU", "Lead|Dev", "Python:L1", None, "job", "plan")


@pytest.fixture(scope="module")
def inputs(spark):
    events = [("u1", f"p{n}", T0 + timedelta(minutes=n), "view", 0) for n in range(4)]
    catalog = spark.createDataFrame(
        [("p1", "First steps", "text", '["a"]', '["b"]')],
        "item_id string, title string, feed_text string, tags string, post_category string",
    )
    return {
        "users": spark.createDataFrame([profile("u1"), profile("u2", "th"), profile("u3"), profile("u1")], schemas.USERS),
        "events": spark.createDataFrame(events, schemas.EVENTS),
        "catalog": catalog,
        "last20": spark.createDataFrame([("u1", "['x']", "['a']", "['b']", "[]")], schemas.LAST20),
        "generator": template_generator,
        "embedder": hashing_embedder(24),
        "params": PARAMS,
    }


def by_user(df):
    return {r.user_id: r for r in df.collect()}


def test_all_users(inputs):
    done = refresh.refresh_all(**inputs)
    rows = by_user(done.bundles)
    assert set(rows) == {"u1", "u2", "u3"}
    assert {r.status for r in rows.values()} == {"Complete"}
    one = rows["u1"]
    assert one.metadata.template == "interaction" and one.metadata.tag_interaction == "['a']"
    assert len(one.metadata.interactions) == 4
    assert [q.query_id for q in one.queries] == ["Q1", "Q2", "Q3", "Q4", "Q5"]
    assert [q.weight for q in one.queries] == [1.0, 1.0, 0.8, 0.6, 0.6]
    assert len(one.embeddings.embedding05) == 16
    assert rows["u2"].metadata.template == "profile" and rows["u2"].metadata.interactions == []
    assert 25 <= len(rows["u2"].queries[0].query_text) <= 70
    ledger = done.ledger.collect()
    assert sorted(r.event_type for r in ledger) == ["embedding"] * 3 + ["llm"] * 3
    assert all(r.num_texts == 5 for r in ledger if r.event_type == "embedding")


def test_selected_users(spark, inputs):
    asked = spark.createDataFrame([("u3",), ("ghost",), ("u3",)], "user_id string")
    done = refresh.refresh_selected(asked, **inputs)
    got = {u: (r.status, r.error) for u, r in by_user(done.bundles).items()}
    assert got == {"u3": ("Complete", None), "ghost": ("Fail", "ghost not found")}
    assert {u: r.status for u, r in by_user(done.statuses).items()} == {"u3": "Complete", "ghost": "Fail"}


def test_a_missing_template_fails_its_users_only(inputs):
    only = {"profile": TEMPLATES["profile"], "interaction": ""}
    done = refresh.refresh_all(**{**inputs, "templates": only})
    got = {u: (r.status, r.error) for u, r in by_user(done.statuses).items()}
    assert got["u1"] == ("Fail", "Missing prompt interaction")
    assert got["u2"][0] == got["u3"][0] == "Complete"


def bad_for_thai():
    return lambda prompts: prompts.map(lambda p: "no idea" if "Answer language: th" in p else '{"queries":[{"query_text":"a"}]}')


def test_bad_answers_fail_their_user_only(inputs):
    done = refresh.refresh_all(**{**inputs, "generator": bad_for_thai})
    got = {u: (r.status, r.error) for u, r in by_user(done.bundles).items()}
    assert got["u2"] == ("Fail", "no JSON object")
    assert got["u1"] == ("Fail", "bad_query_count: 1")
    calls = [r.user_id for r in done.ledger.where("event_type = 'llm'").collect()]
    assert sorted(calls) == ["u1"] + ["u2"] * (PARAMS.retry_limit + 1) + ["u3"]


def raising_embedder():
    def embed(texts):
        raise RuntimeError("down")

    return embed


def test_a_failing_embedder_fails_rows_not_the_job(inputs):
    done = refresh.refresh_all(**{**inputs, "embedder": raising_embedder})
    assert {r.error for r in done.statuses.collect()} == {"RuntimeError: down"}


def picky_embedder():
    good = hashing_embedder(24)()

    def embed(texts):
        if any("สายเฉพาะ" in t or "แนวทาง" in t for t in texts):
            raise RuntimeError("refused")
        return good(texts)

    return embed


def picky_generator():
    good = template_generator()

    def call(prompts):
        if any("Answer language: th" in p for p in prompts):
            raise ConnectionError("blocked")
        return good(prompts)

    return call


def test_one_refused_text_fails_its_user_only(inputs):
    """Calls raise for whole batches; halving finds the one user that cannot be served."""
    for change in ({"embedder": picky_embedder}, {"generator": picky_generator}):
        done = refresh.refresh_all(**{**inputs, **change})
        got = {u: (r.status, r.error) for u, r in by_user(done.statuses).items()}
        assert got["u2"] in (("Fail", "RuntimeError: refused"), ("Fail", "ConnectionError: blocked"))
        assert got["u1"][0] == got["u3"][0] == "Complete"


def test_short_vectors_are_reported(inputs):
    done = refresh.refresh_all(**{**inputs, "embedder": hashing_embedder(8)})
    assert {r.error for r in done.statuses.collect()} == {"embedding dim below 16"}


def slow_with_usage():
    def call(prompts):
        return pd.DataFrame(
            {"text": ["{}"] * len(prompts), "input_tokens": 1000, "output_tokens": 500, "latency_s": 31.0}
        )

    return call


def test_usage_and_slow_calls(inputs):
    done = refresh.refresh_all(**{**inputs, "generator": slow_with_usage})
    assert all(r.slow for r in done.statuses.collect())
    costs = {round(r.estimated_cost_usd, 8) for r in done.ledger.where("event_type = 'llm'").collect()}
    assert costs == {0.0002}


def test_the_generator_runs_once_per_prompt(spark, tmp_path):
    """Several columns of one call, and a filter on them, must not call again."""
    log = str(tmp_path / "calls")

    def counting():
        def call(prompts):
            with open(log, "a") as f:
                f.writelines(f"{p}\n" for p in prompts)
            return prompts.map(lambda p: '{"queries":[]}')

        return call

    df = spark.createDataFrame([("a",), ("b",), (None,)], "prompt string")
    made = M.generate_answers(df, counting, JobParams(model_tasks=2))
    out = made.where("raw is not null and call_error is null").select("raw", F.size("calls").alias("n")).collect()
    assert len(out) == 2
    assert sorted(open(log).read().split()) == ["a", "b"]


def test_embed_blank_and_null_texts(spark):
    df = spark.createDataFrame([("1", " "), ("2", None), ("3", "Word word x")], "id string, t string")
    got = {r.id: r.vector for r in M.embed_texts(df, "t", hashing_embedder(32), 32).collect()}
    assert got["1"] == got["2"] == [0.0] * 32
    assert abs(sum(x * x for x in got["3"]) - 1) < 1e-6
    short = M.embed_texts(df, "t", hashing_embedder(4), 32).collect()
    assert {(r.vector, r.embed_error) for r in short} == {(None, "embedding dim below 32")}
    failed = M.embed_texts(df, "t", raising_embedder, 32).collect()
    assert {(r.vector, r.embed_error) for r in failed} == {(None, "RuntimeError: down")}


def test_placeholders_are_filled_in_order(spark):
    """A history mark inside the profile text is filled by the later step; a language mark is not."""
    df = spark.range(1).select(
        C.render(
            F.lit("{{preferred_language}}|{{UserContextText}}|{{HistorySummaryText}}"),
            F.lit(None).cast("string"),
            F.lit("c {{HistorySummaryText}} {{preferred_language}} $1 \\d"),
            F.lit(None).cast("string"),
        ).alias("p")
    )
    assert df.first().p == "th|c  {{preferred_language}} $1 \\d|"


def test_params_are_clamped():
    p = JobParams(history_threshold=0, recent_k=99, feed_text_max_chars=-5, retry_limit=-1)
    assert (p.history_threshold, p.recent_k, p.feed_text_max_chars, p.retry_limit) == (1, 10, 0, 0)
    with pytest.raises(ValueError):
        JobParams(output_dim=0)


def test_odd_replies_and_vectors_are_errors_of_their_rows(spark):
    from intentloom.operators import models

    assert models._seconds(None) is None and models._seconds(float("nan")) is None and models._int(float("inf")) is None
    for odd in ({"text": float("nan")}, {"text": {}}, {}, "x", {"text": "\ud800"}):
        with pytest.raises(ValueError):
            models._reply_text(odd)
    _, errors = models._vectors(lambda texts: [[1.0, 2.0], None, [float("nan"), 1.0], "x"], ["a", "b", "c", "d"], 2)
    assert errors == [None, "bad_vector", "bad_vector", "bad_vector"]


def test_an_outage_stops_the_halving():
    from intentloom.operators import models

    calls = []

    def down(texts):
        calls.append(len(texts))
        raise RuntimeError("down")

    made = models._each(down, [str(i) for i in range(1000)])
    assert len(made) == 1000 and {e for _, e in made} == {"RuntimeError: down"} and len(calls) < 40


def test_a_cluster_of_bad_texts_is_no_outage():
    from intentloom.operators import models

    def filtered(texts):
        if any(t.startswith("bad") for t in texts):
            raise RuntimeError("filtered")
        return list(texts)

    texts = [*("bad" for _ in range(40)), *(f"ok {i}" for i in range(960))]
    made = models._each(filtered, texts)
    assert [e for _, e in made] == ["RuntimeError: filtered"] * 40 + [None] * 960
    assert [r for r, _ in made[40:]] == texts[40:]


def test_an_outage_marks_uncalled_rows():
    from intentloom.operators import models

    asked = set()

    def down(texts):
        asked.update(texts if len(texts) == 1 else [])
        raise RuntimeError("down")

    texts = [str(i) for i in range(1000)]
    _, errors = models._vectors(down, texts, 2)
    assert {t for t, e in zip(texts, errors, strict=True) if e == "RuntimeError: down"} == asked and len(asked) == 16
    assert errors.count("not_called: RuntimeError: down") == 984


def test_calls_stay_small_in_large_batches(spark, tmp_path):
    """However many rows an Arrow batch has, no call gets more than its share of texts or bytes."""
    from intentloom.operators import models

    log = str(tmp_path / "calls")

    def noting():
        def call(texts):
            with open(log, "a") as f:
                f.write(f"{len(texts)} {sum(map(len, texts))}\n")
            return [[float(len(t)), 1.0] for t in texts]

        return call

    def answering():
        def call(prompts):
            noting()(prompts)
            return prompts.map(lambda p: '{"queries":[]}')

        return call

    rows = spark.range(3000, numPartitions=1)
    long = F.when(F.col("id") % 1000 == 7, F.repeat(F.lit("x"), 3 << 20)).otherwise(F.col("id").cast("string"))
    one = models.embed_texts(rows.withColumn("t", long), "t", noting, 2).orderBy("id").collect()
    assert len(one) == 3000 and all(r.vector and r.embed_error is None for r in one)
    lists = F.when(F.col("id") % 100 == 0, F.lit(None)).otherwise(F.array_repeat(F.col("id").cast("string"), F.when(F.col("id") == 5, 2500).otherwise(3)))
    many = rows.select("id", F.size(models.embed_lists(lists, noting, 2)["vectors"]).alias("n")).collect()
    assert {r.id: r.n for r in many} == {i: None if i % 100 == 0 else 2500 if i == 5 else 3 for i in range(3000)}
    made = models.generate_answers(rows.select("id", F.col("id").cast("string").alias("prompt")), answering, JobParams()).collect()
    assert len(made) == 3000 and {r.raw for r in made} == {'{"queries":[]}'}
    calls = [tuple(map(int, line.split())) for line in open(log)]
    assert max(n for n, _ in calls) <= 1024 and max(b for _, b in calls) <= 4 << 20


def test_list_columns_share_a_worker(spark):
    row = {c: "['a', None]" for c in ("recent_post_interaction", "recent_tag_interaction", "recent_category_interaction", "recent_keyword_search")}
    df = spark.createDataFrame([row]).repartition(2)
    df = df.withColumns({"recent_titles": F.lit("t"), "n_events": F.lit(1), "has_last20": F.lit(True)})
    text = df.select(C.history_text(F.lit("en"), 3).alias("h"))
    assert text._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert text.first().h.count("a") >= 4
