"""Appends with rejects, written bundles and their audit, retention by day, the narrow catalog."""

import glob
import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from intentloom.operators import bundle as B, events as E
from intentloom.sources import readers as R, schemas, sinks, stores as S

NOW = datetime(2026, 1, 10, 12)
RAW = "user_id string, item_id string, ts string, event_type string, dwell_ms string"
PROFILE = (
    "user_id string, current_status string, student_year string, faculty_name string, "
    "curriculum_name string, university_name string, target_roles string"
)


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW)


GOOD = ("u", "p", "2026-01-01 10:00:00", "view", "5")
BAD = ("", None, "soon", "view", "5x")


def accepted(spark, path):
    return sorted((r.user_id, r.item_id, r.ts, r.dwell_ms) for r in S.read_accepted(spark, path, schemas.EVENTS).collect())


def test_accepted_and_rejected_rows_are_published_together(spark, tmp_path):
    path = str(tmp_path / "t")
    S.append_with_rejects(raw(spark, GOOD, BAD, GOOD), schemas.EVENTS, ("user_id", "item_id"), path, "one")
    assert accepted(spark, path) == [("u", "p", datetime(2026, 1, 1, 10), 5)] * 2  # repeated rows stay
    bad = S.read_rejected(spark, path, schemas.EVENTS).collect()
    assert [(r.run, r.reject_reason) for r in bad] == [("one", "user_id missing; item_id missing; ts unreadable; dwell_ms unreadable")]
    assert json.loads(bad[0].given) == {"user_id": "", "item_id": None, "ts": "soon", "event_type": "view", "dwell_ms": "5x"}


def test_a_repeated_run_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "t")
    S.append_with_rejects(raw(spark, GOOD, BAD), schemas.EVENTS, ("user_id",), path, "one")
    S.append_with_rejects(raw(spark, BAD), schemas.EVENTS, ("user_id",), path, "two")
    S.append_with_rejects(raw(spark, GOOD), schemas.EVENTS, ("user_id",), path, "two")
    assert len(accepted(spark, path)) == 2
    assert [r.run for r in S.read_rejected(spark, path, schemas.EVENTS).collect()] == ["one"]


def test_append_refuses_names_it_cannot_keep(spark, tmp_path):
    with pytest.raises(ValueError, match="run"):
        S.append_with_rejects(raw(spark, GOOD), schemas.EVENTS, (), str(tmp_path), "a/b")
    clashing = T.StructType([T.StructField("Run", T.StringType())])
    with pytest.raises(ValueError, match="taken"):
        S.append_with_rejects(spark.createDataFrame([("x",)], "Run string"), clashing, (), str(tmp_path), "one")


def test_rows_to_append_are_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    for append in (
        lambda rows: S.append_with_rejects(rows, schemas.EVENTS, (), str(tmp_path / "a"), "one"),
        lambda rows: sinks.append_validated(rows, schemas.EVENTS, (), str(tmp_path / "b")),
    ):
        before = seen.value
        append(raw(spark, GOOD, GOOD, GOOD).mapInPandas(noted, RAW))
        assert seen.value - before == 3


def bundles(spark, *ids, error=None):
    row = [
        (i, error, {"a": i}, [{"query_id": f"Q{n}", "query_text": f"t{n}"} for n in range(5)], [[float(n), 1.5] for n in range(5)])
        for i in ids
    ]
    df = spark.createDataFrame(
        row, "user_id string, error string, metadata struct<a: string>, "
        "queries array<struct<query_id: string, query_text: string>>, vectors array<array<float>>",
    )
    return B.build_bundle(df)


def spoil(path, user, cut):
    """Cut the end of the line of a user in the files."""
    for name in glob.glob(f"{path}/bucket=*/*.json"):
        lines = open(name).read().splitlines()
        if any(f'"user_id":"{user}"' in x for x in lines):
            with open(name, "w") as f:
                f.writelines((x[:cut] if f'"user_id":"{user}"' in x else x) + "\n" for x in lines)
            crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
            os.path.exists(crc) and os.unlink(crc)
            return
    raise AssertionError(user)


def test_audit_of_written_bundles(spark, tmp_path):
    path = str(tmp_path / "b")
    made = bundles(spark, "whole", "cut", "nobody", "other").union(bundles(spark, "failed", error="call: down"))
    sinks.write_bundles(made, path, buckets=4)
    spoil(path, "cut", 60)
    spoil(path, "nobody", 10)
    users = spark.createDataFrame([("cut", "active", "year2", "Eng", "CS", None, "DS")], PROFILE)
    asked = spark.createDataFrame([(i,) for i in ("whole", "cut", "failed", "unknown")], "user_id string")
    back = S.read_bundles(spark, path, made.schema, 4, asked)
    got = {r.user_id: r for r in B.stored_audit(asked, back, users, "m1").collect()}
    assert {u: r.state for u, r in got.items()} == {"whole": "stored", "cut": "corrupt", "failed": "failed", "unknown": "absent"}
    assert json.loads(got["whole"].metadata) == {"a": "whole"} and got["whole"].embeddings.embedding03 == [2.0, 1.5]
    assert [q["query_text"] for q in json.loads(got["whole"].queries)] == ["t0", "t1", "t2", "t3", "t4"]
    assert "embedding folder /" in got["whole"].report and "    |- embedding05 /" in got["whole"].report
    assert json.loads(got["cut"].metadata)["model_name"] == "m1" and got["cut"].metadata_source == "profile"
    assert got["cut"].note.startswith('{"user_id":"cut"') and len(got["cut"].note) == 60
    assert "embedding folder x" in got["cut"].report and got["cut"].embeddings.embedding01 == []
    assert got["failed"].note == "call: down" and got["failed"].queries == ""
    assert "|- unknown x" in got["unknown"].report and got["unknown"].metadata == "{}"
    everything = S.read_bundles(spark, path, made.schema, 4).collect()
    assert len(everything) == 5 and [r.corrupt for r in everything if r.user_id is None] == ['{"user_id"']


def test_only_the_buckets_of_asked_users_are_read(spark, tmp_path):
    path = str(tmp_path / "b")
    made = bundles(spark, *[f"u{i}" for i in range(40)])
    sinks.write_bundles(made, path, buckets=8)
    asked = spark.createDataFrame([("u3",)], "user_id string")
    found = S.read_bundles(spark, path, made.schema, 8, asked)
    assert [r.user_id for r in found.collect()] == ["u3"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    one = sorted(glob.glob(f"{path}/bucket=*"))
    assert len(one) == 8 and S.read_bundles(spark, path, made.schema, 8, asked.where("user_id is null")).count() == 0


def test_an_escaped_id_is_read_from_a_corrupt_line(spark, tmp_path):
    path = str(tmp_path / "b")
    made = bundles(spark, 'a"b\\c')
    sinks.write_bundles(made, path, buckets=2)
    name = glob.glob(f"{path}/bucket=*/*.json")[0]
    line = open(name).read()
    with open(os.path.join(os.path.dirname(name), "more.json"), "w") as f:
        f.write(line[:50] + "\n")
    asked = spark.createDataFrame([('a"b\\c',)], "user_id string")
    back = S.read_bundles(spark, path, made.schema, 2, asked)
    assert sorted(r.corrupt is None for r in back.collect()) == [False, True]
    users = spark.createDataFrame([], PROFILE)
    assert [r.state for r in B.stored_audit(asked, back, users).collect()] == ["stored"]  # the better of the two lines


def objects(spark):
    rows = [(f"d{d}h{h}", datetime(2026, 1, d, h)) for d in (1, 5, 8, 9, 10) for h in (0, 12, 23)]
    return spark.createDataFrame([*rows, ("unknown", None)], "name string, created timestamp_ntz")


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/day=*/*.parquet")}


def names(spark, path):
    return {r.name for r in spark.read.parquet(path).collect()}


def test_retention_rewrites_one_day_and_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "o")
    S.write_by_day(objects(spark), path)
    before = files(path)
    ttl = 2 * 86400  # the cutoff is 8 January, 12:00, which is kept itself
    assert S.expire(spark, path, NOW, ttl) == (["2026-01-01", "2026-01-05"], "2026-01-08")
    kept = {r.name for r in B.retention_filter(objects(spark), NOW, ttl).collect()}
    assert names(spark, path) == kept and {"unknown", "d8h12"} <= kept
    after = files(path)
    same = [f for f in before if not any(d in f for d in ("01-01", "01-05", "01-08"))]
    assert same and all(after[f] == before[f] for f in same)
    assert S.expire(spark, path, NOW, ttl) == ([], None) and files(path) == after


def test_retention_of_a_day_that_goes_whole(spark, tmp_path):
    path = str(tmp_path / "o")
    S.write_by_day(objects(spark).where("name not in ('d8h12', 'd8h23')"), path)
    assert S.expire(spark, path, NOW, 2 * 86400) == (["2026-01-01", "2026-01-05", "2026-01-08"], None)
    assert S.expire(spark, path, NOW + timedelta(days=9999), 1) == (["2026-01-09", "2026-01-10"], None)
    assert names(spark, path) == {"unknown"}


def posts(spark):
    rows = [(f"p{i % 50}", NOW - timedelta(hours=i % 7), f"t{i}", "x" * i) for i in range(200)]
    df = spark.createDataFrame(rows, "post_id string, post_created_at timestamp_ntz, post_topic string, post_content_body string")
    have = set(df.columns)
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.ITEMS.fields if f.name not in have])


def test_catalog_without_bodies_keeps_the_same_rows(spark, tmp_path):
    items = posts(spark)
    whole, narrow = R.item_catalog(items), R.item_catalog(items, body=False)
    assert "feed_text" not in narrow.columns
    assert sorted(whole.drop("feed_text").collect(), key=str) == sorted(narrow.collect(), key=str)
    items.write.parquet(str(tmp_path / "p"))
    plan = R.item_catalog(spark.read.parquet(str(tmp_path / "p")), body=False)._jdf.queryExecution().executedPlan().toString()
    assert "post_content_body" not in plan and "post_topic" in plan


def test_joins_with_the_kept_catalog_move_only_the_other_side(spark, tmp_path):
    catalog = S.write_catalog(posts(spark), "kept_catalog", str(tmp_path / "c"), buckets=8)
    rows = [(f"u{i % 9}", f"p{i % 60}", NOW - timedelta(minutes=i), "view", 1) for i in range(300)]
    events = spark.createDataFrame(rows, "user_id string, item_id string, ts timestamp_ntz, event_type string, dwell_ms long")
    want = sorted(E.recent_titles(events, R.item_catalog(posts(spark)), 5).collect())
    assert sorted(E.recent_titles(events, catalog, 5).collect()) == want and len(want) == 9
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = events.join(catalog, "item_id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("drop table kept_catalog")
    assert plan.count("Exchange hashpartitioning(item_id") == 1 and "Bucketed: true" in plan
