import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from intentloom.operators import bundle as B, events as E, ledger as L
from intentloom.params import JobParams
from intentloom.sources import schemas, sinks

T0 = datetime(2026, 1, 1)
PROFILE = (
    "user_id string, current_status string, student_year string, faculty_name string, "
    "curriculum_name string, university_name string, target_roles string, onboard_grp string"
)
STORED = "user_id string, kind string, name string, text string, vector array<float>"


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([("u1", "active", "year2", "Eng", "CS", None, "DS", "job")], PROFILE)


def asked(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "user_id string")


def audit(spark, users, rows, *ids):
    stored = spark.createDataFrame(rows, STORED)
    return {r.user_id: r for r in B.bundle_audit(asked(spark, *ids), stored, users).collect()}


def test_audit_all_present(spark, users):
    rows = [
        ("u1", "metadata", "metadata", '{"user_id":"u1"}', None),
        ("u1", "queries", "queries", "[]", None),
        ("u1", "embedding", "embedding01", None, [1.0, 2.0, 3.0]),
    ]
    got = audit(spark, users, rows, "u1")["u1"]
    assert json.loads(got.metadata)["user_id"] == "u1" and got.metadata_source == "stored"
    assert got.embeddings.embedding01 == [1.0, 2.0, 3.0] and got.embeddings.embedding02 == []
    assert got.queries == "[]"
    assert got.report.split("\n")[:7] == [
        "|- u1 /", "  |- metadata folder /", "    |- metadata /", "  |- queries folder /",
        "    |- queries /", "  |- embedding folder /", "    |- embedding01 /",
    ]
    assert got.report.split("\n")[7] == "    |- embedding02 x"


def test_audit_rebuilds_metadata_from_the_profile(spark, users):
    got = audit(spark, users, [("u1", "embedding", "embedding02", None, [1.0])], "u1")["u1"]
    assert got.metadata_source == "profile"
    assert json.loads(got.metadata) == {
        "user_id": "u1", "current_status": "active", "education_level": "year2", "education_major": "Eng CS",
        "target_roles": "DS", "timezone": "UTC", "max_output_tokens": 1024, "feed_text_max_chars": 872,
        "temperature": 0.1,
    }
    assert "  |- metadata folder x" in got.report


def test_audit_missing_embedding_folder(spark, users):
    got = audit(spark, users, [("u1", "metadata", "metadata", "{}", None)], "u1")["u1"]
    assert got.embeddings.embedding01 == [] and "  |- embedding folder x" in got.report


def test_audit_unknown_user(spark, users):
    got = audit(spark, users, [("u1", "metadata", "metadata", "{}", None)], "ghost")["ghost"]
    assert got.report.startswith("|- ghost x") and got.metadata_source == "none" and got.metadata == "{}"


def test_queries_audit(spark):
    stored = spark.createDataFrame([("u1", "queries", "queries", "[1]", None)], STORED)
    got = {r.user_id: (r.queries, r.present) for r in B.queries_audit(asked(spark, "u1", "u2"), stored).collect()}
    assert got == {"u1": ("[1]", True), "u2": ("", False)}


@pytest.mark.parametrize("n", [0, 4, 5, 6])
def test_bundle_needs_five_vectors(spark, n):
    df = spark.createDataFrame(
        [("u", [f"t{i}" for i in range(n)], [[float(i)] for i in range(n)], None)],
        "user_id string, queries array<string>, vectors array<array<float>>, error string",
    ).withColumn("metadata", F.struct(F.lit(1).alias("m")))
    row = B.build_bundle(df).first()
    assert len(row.queries) == n
    if n < 5:
        assert (row.status, row.error, row.embeddings) == ("Fail", f"bad_query_count: {n}", None)
        assert B.bundle_artifacts(B.build_bundle(df)).count() == 0
    else:
        assert row.status == "Complete" and row.embeddings.embedding05 == [4.0]
        parts = B.bundle_artifacts(B.build_bundle(df)).collect()
        assert [p.name for p in parts] == ["metadata", "queries", *B.EMBEDDING_NAMES]


def test_heavy_users_spill_to_rows_and_nothing_is_lost(spark):
    rows = [("heavy", f"i{n}", T0 + timedelta(seconds=n), "view", 0) for n in range(30)]
    rows += [("light", f"i{n}", T0 + timedelta(seconds=n), "view", 0) for n in range(3)]
    events = spark.createDataFrame(rows, schemas.EVENTS).repartition(4)
    people = asked(spark, "heavy", "light", "cold")
    columns = (
        "curriculum_name", "student_year", "faculty_name", "onboard_grp",
        "recent_tag_interaction", "recent_category_interaction",
    )
    routed = E.event_counts(people, events).withColumns(
        {**{c: F.lit("x") for c in columns}, "template": F.lit("profile")}
    )
    params = JobParams(inline_events=10)
    got = {r.user_id: r for r in B.bundle_metadata(routed, events, params).select("metadata.*").collect()}
    assert got["heavy"].interactions is None and not got["heavy"].interactions_inline
    assert got["cold"].interactions == []
    assert [json.loads(x)["ts"] for x in got["light"].interactions] == [
        f"2026-01-01T00:00:0{n}Z" for n in range(3)
    ]
    spilled = B.spilled_events(events, routed, params.inline_events)
    assert spilled.count() == 30 and {r.user_id for r in spilled.collect()} == {"heavy"}
    assert "event_ts" not in spilled.first().record


def test_users_just_above_the_limit_are_not_inlined_cut_short(spark):
    """Few enough rows to escape the hot list, more than the limit: left out whole."""
    rows = [("just", f"i{n}", T0, "view", 0) for n in range(4)]
    rows += [(f"u{m}", "same", T0, "view", 0) for m in range(8) for _ in range(3)]
    events = spark.createDataFrame(rows, schemas.EVENTS).repartition(5)
    got = {r.user_id: len(r.interactions) for r in B.inline_events(events, 3).collect()}
    assert got == {f"u{m}": 3 for m in range(8)}


def test_hot_keys_are_few_by_definition(spark):
    counts = spark.createDataFrame([("a", 50), ("b", 30), ("c", 20)], "k string, n bigint")
    assert [r.k for r in E.hot_keys(counts, "k", "n", 3).collect()] == ["a"]
    assert [r.k for r in E.hot_keys(counts, "k", "n", 4).orderBy("k").collect()] == ["a", "b"]
    assert E.hot_keys(counts, "k", "n", 1).count() == 0


def test_retention(spark):
    df = spark.createDataFrame([("a", T0), ("b", T0 - timedelta(seconds=11)), ("c", None)], "k string, created timestamp_ntz")
    kept = B.retention_filter(df, T0, 10)
    assert {r.k for r in kept.collect()} == {"a", "c"}


def test_costs(spark):
    calls = spark.createDataFrame(
        [("m", 1000, None), ("m", None, 500), ("x", 2000, 1000)],
        "model_name string, input_tokens bigint, output_tokens bigint",
    )
    got = {r.model_name: (r.n_calls, round(r.estimated_cost_usd, 8)) for r in L.llm_cost(calls, {"x": (1.0, 2.0)}).collect()}
    assert got == {"m": (2, 0.0002), "x": (1, 4.0)}
    texts = spark.createDataFrame(
        [("u", "e", "abcd"), ("u", "e", None)], "user_id string, model_name string, text string"
    )
    row = L.embedding_cost(texts, "user_id").first()
    assert (row.num_texts, row.total_chars) == (2, 4) and abs(row.estimated_cost_usd - 2e-7) < 1e-15


def test_token_usage(spark):
    df = spark.createDataFrame([('{"prompt_token_count": 7}',), ('{"prompt_token_count": "x"}',), (None,)], "u string")
    got = [r.n for r in df.select(L.token_usage("u", "prompt_token_count").alias("n")).collect()]
    assert got == [7, None, None]


def test_run_report_counts_slow_as_updated(spark):
    st = spark.createDataFrame(
        [("a", "Complete", True), ("b", "Fail", False), ("c", "Complete", False)],
        "user_id string, status string, slow boolean",
    )
    row = L.run_report(st, datetime(2026, 1, 31, 20, 5), 3.14159).first()
    assert tuple(row) == ("report_260201_0305", "2026-02-01T03:05:00+07:00", 3, 2, 1, 1, 3.14)


def test_append_is_all_or_nothing(spark, tmp_path):
    path = str(tmp_path / "events")
    good = spark.createDataFrame(
        [("u", "i", "2026-01-06T13:12:10Z", "view", "52000")],
        "user_id string, item_id string, ts string, event_type string, dwell_ms string",
    )
    bad = good.union(good.withColumn("dwell_ms", F.lit("1x")).withColumn("user_id", F.lit("")))
    required = ("user_id", "item_id")
    sinks.append_validated(good, schemas.EVENTS, required, path)
    with pytest.raises(ValueError, match="1 rows rejected.*user_id missing; dwell_ms unreadable"):
        sinks.append_validated(bad, schemas.EVENTS, required, path)
    sinks.append_validated(good, schemas.EVENTS, required, path)
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.first().ts == datetime(2026, 1, 6, 13, 12, 10)
    with pytest.raises(ValueError, match="lack item_id"):
        sinks.validated(good.drop("item_id"), schemas.EVENTS, required)


def test_ledger_appends_differing_records(spark, tmp_path):
    path = str(tmp_path / "ledger")
    sinks.append_ledger(spark.createDataFrame([("llm", 5)], "event_type string, input_tokens bigint"), path)
    sinks.append_ledger(spark.createDataFrame([("embedding", 9)], "event_type string, total_chars bigint"), path)
    back = spark.read.option("mergeSchema", True).parquet(path).orderBy("event_type").collect()
    assert [(r.event_type, r.input_tokens, r.total_chars) for r in back] == [("embedding", None, 9), ("llm", 5, None)]


def test_bundles_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(f"u{i}", ["ภาษาไทย"], None) for i in range(20)], "user_id string, queries array<string>, error string"
    )
    path = str(tmp_path / "bundles")
    sinks.write_bundles(df, path, buckets=4, files_per_bucket=2)
    back = spark.read.json(path)
    assert back.count() == 20 and back.select("bucket").distinct().count() == 4
    one = spark.range(1).select(F.lit("u7").alias("user_id")).select(sinks.bucket_of("user_id", 4)).first()[0]
    assert back.where((F.col("bucket") == one) & (F.col("user_id") == "u7")).first().queries == ["ภาษาไทย"]


def test_report_files(spark, tmp_path):
    st = spark.createDataFrame(
        [("a", "Complete", True), ("b", "Fail", False)], "user_id string, status string, slow boolean"
    )
    sinks.write_report(st, str(tmp_path / "r"), datetime(2026, 1, 1), 1.0)
    counts = {n: spark.read.json(str(tmp_path / "r" / n)).count() for n in ("run_metadata", "users", "failed", "slow")}
    assert counts == {"run_metadata": 1, "users": 2, "failed": 1, "slow": 1}


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"item_id \(missing.*dwell_ms \(string"):
        schemas.require_columns(
            spark.createDataFrame([], "user_id string, ts timestamp_ntz, event_type string, dwell_ms string"),
            schemas.EVENTS, "events",
        )
