"""The answer store, interactions of users of any size, the ledgers, and list literals."""

import ast
import glob
import json
import os
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from intentloom.functions import text as X
from intentloom.functions.offline_models import hashing_embedder, template_generator
from intentloom.operators import answer_store as S, ledger as L
from intentloom.params import JobParams
from intentloom.plans import refresh
from intentloom.sources import schemas, sinks
from tests.test_refresh import profile

NOW = datetime(2026, 1, 5, 12, 30)
PARAMS = JobParams(retry_limit=0, output_dim=16, history_threshold=3)


def counting(log: str, fail_from: int | None = None):
    """A generator that notes each prompt it is asked, and breaks down where it should."""

    def factory():
        def call(prompts):
            with open(log, "a") as f:
                f.writelines(p + "\n" for p in prompts)
            if fail_from is not None and any(int(p.split()[-1]) >= fail_from for p in prompts):
                os._exit(1)  # the worker dies: no error of a row, the job fails
            return prompts.map(lambda p: "no" if "odd" in p else json.dumps({"queries": [{"query_text": p}]}))

        return call

    return factory


def asked_of(log):
    return sorted(open(log).read().split("\n")[:-1]) if os.path.exists(log) else []


def prompts(spark, rows):
    return spark.createDataFrame(rows, "user_id string, prompt string, line int").repartition(3)


def told(df):
    return {r.user_id: (r.raw, len(r.calls), r.reused, r.line) for r in df.collect()}


def test_a_prompt_is_asked_once_and_kept(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = [("a", "p 1", 1), ("b", "p 1", 2), ("c", "p 2", 3), ("d", None, 4), ("e", "odd 3", 5), ("f", None, 6)]
    store = S.AnswerStore(str(tmp_path / "answers"), "one", NOW, wave_rows=1)
    got = told(S.stored_answers(prompts(spark, rows), counting(log), PARAMS, store))
    one, two = '{"queries": [{"query_text": "p 1"}]}', '{"queries": [{"query_text": "p 2"}]}'
    assert got == {"a": (one, 1, False, 1), "b": (one, 0, False, 2), "c": (two, 1, False, 3), "d": (None, 0, False, 4), "e": ("no", 1, False, 5), "f": (None, 0, False, 6)}
    assert asked_of(log) == ["odd 3", "p 1", "p 2"]
    again = told(S.stored_answers(prompts(spark, [*rows, ("g", "p 4", 7)]), counting(log), PARAMS, S.AnswerStore(store.path, "two", NOW)))
    assert again["a"] == (one, 0, True, 1) and again["c"] == (two, 0, True, 3) and again["g"][1:3] == (1, False)
    assert asked_of(log) == ["odd 3", "odd 3", "p 1", "p 2", "p 4"]  # only the unreadable answer and the new prompt


def test_a_killed_run_goes_on_after_its_last_wave(spark, tmp_path):
    log = str(tmp_path / "log")
    store = S.AnswerStore(str(tmp_path / "answers"), "one", NOW, wave_rows=4)
    rows = prompts(spark, [(f"u{i}", f"p {i}", i) for i in range(20)])
    with pytest.raises(Exception, match="(?i)python worker|crash|exit"):
        S.stored_answers(rows, counting(log, fail_from=15), PARAMS, store)
    kept = store.read(spark).count()
    before = set(asked_of(log))
    os.remove(log)
    got = told(S.stored_answers(rows, counting(log), PARAMS, store))
    assert len(got) == 20 and sum(r[2] for r in got.values()) == kept
    assert len(asked_of(log)) == 20 - kept and before


def test_a_key_depends_on_prompt_template_and_model(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", "bd"), (None, "bd")], "prompt string, template string")
    first = df.select(S.answer_key(PARAMS, template="template").alias("k")).collect()
    other = df.select(S.answer_key(JobParams(model_name="x"), template="template").alias("k")).collect()
    keys = {r.k for r in first[:3]} | {r.k for r in other[:3]}
    assert len(keys) == 6 and first[3].k is None


def test_two_answers_of_one_key_are_read_as_one(spark, tmp_path):
    late, soon = (S.AnswerStore(str(tmp_path / "s"), run, NOW + timedelta(hours=h)) for run, h in (("late", 2), ("soon", 1)))
    for store in (late, soon):
        store.append(spark.createDataFrame([("k", store.run)], "key string, raw string"))
    assert [tuple(r) for r in late.read(spark).collect()] == [("k", "soon")]


@pytest.fixture(scope="module")
def inputs(spark):
    t0 = datetime(2026, 1, 1)
    events = [("u1", f"p{n % 7}", t0 + timedelta(minutes=n // 2), "view", n) for n in range(3000)]
    events += [(f"u{2 + n % 2}", "p1", t0 + timedelta(minutes=n), None, None) for n in range(9)] + [("ghost", "p1", t0, "view", 0)]
    return {
        "users": spark.createDataFrame([profile("u1"), profile("u2", "th"), profile("u3"), profile("u4")], schemas.USERS),
        "events": spark.createDataFrame(events, schemas.EVENTS),
        "catalog": spark.createDataFrame([("p1", "T", "t", '["a"]', '["b"]')], "item_id string, title string, feed_text string, tags string, post_category string"),
        "last20": spark.createDataFrame([("u1", "['x']", "['a']", "['b']", "[]")], schemas.LAST20),
        "embedder": hashing_embedder(24),
        "params": PARAMS,
    }


def silent():
    raise AssertionError("the model must not be called")


def test_a_refresh_with_stored_answers_equals_one_without(inputs, tmp_path):
    store = S.AnswerStore(str(tmp_path / "answers"), "r", NOW)

    def whole(done):
        return {r.user_id: (r.status, r.queries, r.embeddings, r.metadata) for r in done.bundles.collect()}

    plain = whole(refresh.refresh_all(**inputs, generator=template_generator))
    assert whole(refresh.refresh_all(**inputs, generator=template_generator, answers=store)) == plain
    second = refresh.refresh_all(**inputs, generator=silent, answers=store)
    assert whole(second) == plain
    assert {r.event_type for r in second.ledger.collect()} == {"embedding"}


def test_all_interactions_are_written_in_order_over_several_files(spark, inputs, tmp_path):
    done = refresh.refresh_all(**inputs, generator=template_generator)
    path = str(tmp_path / "i")
    sinks.write_interactions(done.interactions, path, buckets=4, tasks=9)
    (number,) = spark.range(1).select(sinks.bucket_of(F.lit("u1"), 4)).first()
    files = sorted(glob.glob(f"{path}/bucket={number}/*.json"))
    lines = [json.loads(line) for f in files for line in open(f)]
    mine = [x["record"] for x in lines if x["user_id"] == "u1"]
    assert len([f for f in files if '"u1"' in open(f).read()]) > 2  # one user, a third and more of all rows
    assert [r["ts"] for r in mine] == sorted(r["ts"] for r in mine) and sorted(r["dwell_ms"] for r in mine) == list(range(3000))
    kind = done.interactions.schema["record"].dataType
    back = sinks.read_interactions(spark, path, kind, 4)
    key = lambda df: sorted(map(repr, df.select("user_id", "record.*").collect()))
    assert key(back) == key(done.interactions) and back.count() == 3009
    one = sinks.read_interactions(spark, path, kind, 4, "u3")
    assert one.count() == 4 and "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_a_whole_refresh_is_written(spark, inputs, tmp_path):
    done = refresh.refresh_all(**inputs, generator=template_generator)
    for day in (NOW, NOW + timedelta(days=1)):
        sinks.write_refreshed(done, str(tmp_path), day, 4)
    assert spark.read.json(f"{tmp_path}/bundles").count() == 4
    assert spark.read.parquet(f"{tmp_path}/statuses").count() == 4
    ledger = spark.read.parquet(f"{tmp_path}/ledger")
    assert ledger.schema == schemas.LEDGER and ledger.groupBy("logged_at").count().orderBy("logged_at").collect() == [(NOW, 8), (NOW + timedelta(days=1), 8)]


def test_stage_times(spark):
    nan = float("nan")
    rows = [("a", "load", 0.5, None), ("a", "load", 0.25, None), ("a", "llm", 2.0, None), ("b", "load", 1.0, None), ("b", "llm", 3.0, "refused"),
            ("c", "llm", nan, None), (None, "load", 1.0, None), ("a", "other", 9.0, None)]
    df = spark.createDataFrame(rows, "user_id string, stage string, seconds double, error string")
    got = {r.user_id: (r.load, r.llm, r.total_ms, r.logged_at) for r in L.stage_times(df, ["load", "llm"], NOW).collect()}
    assert got == {"a": ("750", "2000", 2750, NOW), "b": ("1000", "-", 1000, NOW), "c": ("-", "-", 0, NOW), None: ("1000", "-", 1000, NOW)}


@pytest.mark.parametrize(
    "raw, want",
    [
        (r"['C:\\x41']", [r"C:\x41"]), ("['a, None, b', None]", ["a, None, b"]), ("[1.5, True]", ["1.5", "True"]),
        ('["a", null, true]', ["a", "True"]), ("[['a', 'b'], ('c',)]", ["['a', 'b']", "('c',)"]), ("['a' 'b']", ["ab"]),
        ("['''x''', r'\\d', u'é']", ["x", "\\d", "é"]), ("{'a': 1}", []), ("('a')", []), ("[" * 5000, []), ("['\\ud800']", ["\ufffd"]),
        ("['\\d']", ["\\d"]), ("[__import__('os')]", []), ("['a'] # note", ["a"]), ("\u3000['a']\n", ["a"]),
    ],
)
def test_list_literals(spark, raw, want):
    (row,) = spark.createDataFrame([(raw,)], "raw string").select(X.parse_list_column("raw").alias("a")).collect()
    assert row.a == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.characters(codec="utf-8"))), max_size=6), st.booleans())
def test_generated_literals_are_read_as_they_are(entries, square):
    literal = repr(entries if square else tuple(entries))
    assert X._entries(literal) == [x for x in ast.literal_eval(literal) if x is not None]
    assert X._entries(json.dumps(entries)) == [x for x in entries if x is not None]
