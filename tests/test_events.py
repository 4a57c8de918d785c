from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from intentloom.operators import context as C, events as E, themes as T
from intentloom.params import JobParams
from intentloom.sources import readers as R

T0 = datetime(2026, 1, 1)
SCHEMA = "user_id string, item_id string, ts timestamp_ntz, event_type string, dwell_ms bigint"


def at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        ("u1", "a", at(1), "view", 0),
        ("u1", "b", at(2), "click", 0),
        ("u1", "c", at(2), "View ", 0),  # same time as b
        ("u1", "a", at(3), "like", 0),
        ("u1", None, at(9), "view", 0),
        ("u1", "d", None, "view", 0),
        ("u1", " ", at(8), "view", 0),
        ("u2", " e ", at(1), "view", 0),
        ("u2", "f", None, "view", 0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def catalog(spark):
    rows = [
        ("a", "Title A", "Body\n of A  here", '["t1","t2"]', '["c1"]'),
        ("c", None, "Body of C", "['t0',\n't1']", None),
        ("e", "Title E", None, None, "broken"),
    ]
    return spark.createDataFrame(
        rows, "item_id string, title string, feed_text string, tags string, post_category string"
    )


def users(spark, *rows):
    return spark.createDataFrame(rows, "user_id string, language string")


def test_recent_items_order_ties_and_bad_times(events):
    got = [(r.user_id, r.rk, r.item_id) for r in E.recent_items(events, 10).orderBy("user_id", "rk").collect()]
    assert got == [
        ("u1", 1, " "), ("u1", 2, "a"), ("u1", 3, "b"), ("u1", 4, "c"), ("u1", 5, "d"),
        ("u2", 1, " e "), ("u2", 2, "f"),
    ]
    assert E.recent_items(events, 0).count() == 0


def test_recent_titles_fall_back_to_the_id(events, catalog):
    got = {r.user_id: r.recent_titles for r in E.recent_titles(events, catalog, 4).collect()}
    assert got == {"u1": " , Title A, b, c", "u2": " e , f"}


def test_recent_block_counts_only_known_items(spark, events, catalog):
    languages = users(spark, ("u1", "en"), ("u2", "th"), ("u3", "en"))
    got = {r.user_id: r.recent_block for r in E.recent_block(events, catalog, languages, 2, 9).collect()}
    assert got == {
        "u1": "Recent interacted feeds (truncated):\n- (1) a | Title A | Body of…\n- (2) c |  | Body of C",
        "u2": "ฟีดล่าสุดที่มีปฏิสัมพันธ์ (ตัดสั้น):\n- (1) e | Title E | Title E",
    }


def pairs(df):
    return {(r.user_id, r.item_id) for r in df.collect()}


def test_seen_items(events):
    assert pairs(E.seen_items(events)) == {
        ("u1", "a"), ("u1", "b"), ("u1", "c"), ("u1", "d"), ("u2", "e"), ("u2", "f"),
    }
    assert pairs(E.seen_items(events, event_types=["VIEW ", ""])) == {
        ("u1", "a"), ("u1", "c"), ("u1", "d"), ("u2", "e"), ("u2", "f"),
    }
    assert pairs(E.seen_items(events, event_types=[" "])) == set()
    # a window drops unreadable times, zero days mean no window
    late = dict(now=at(2) + timedelta(days=1), window_days=1)
    assert pairs(E.seen_items(events, **late)) == {("u1", "a"), ("u1", "b"), ("u1", "c")}
    assert len(pairs(E.seen_items(events, window_days=0))) == 6
    assert pairs(E.seen_items(events, max_unique=2)) == {("u1", "a"), ("u1", "b"), ("u2", "e")}
    with pytest.raises(ValueError):
        E.seen_items(events, window_days=3)


def test_exclude_seen(spark, events):
    wanted = spark.createDataFrame([("u1", "a"), ("u1", "z"), ("u2", "a")], "user_id string, item_id string")
    assert pairs(E.exclude_seen(wanted, E.seen_items(events))) == {("u1", "z"), ("u2", "a")}


def test_counts_include_every_row_and_cold_users(spark, events):
    people = spark.createDataFrame([("u1",), ("u9",)], "user_id string")
    got = {r.user_id: r.n_events for r in E.event_counts(people, events).collect()}
    assert got == {"u1": 7, "u9": 0}


def test_last20(events, catalog):
    got = {r.user_id: r for r in E.last20_profile(events.where("item_id <> ' '"), catalog).collect()}
    assert got["u1"].recent_post_interaction == '["title a"]'
    assert got["u1"].recent_tag_interaction == '["t0","t1","t2"]'
    assert got["u1"].recent_category_interaction == '["c1"]'
    assert got["u2"].recent_post_interaction == "[]"


@pytest.mark.parametrize("n, want", [(0, "profile"), (19, "profile"), (20, "interaction")])
def test_route(spark, n, want):
    assert spark.range(1).select(C.route(F.lit(n), 20).alias("t")).first().t == want


@pytest.mark.parametrize(
    "n, threshold, want",
    [(0, 5, "starter"), (1, 5, "starter"), (2, 5, "mixed"), (5, 5, "history"), (1, 1, "history")],
)
def test_route_3way(spark, n, threshold, want):
    assert spark.range(1).select(C.route_3way(F.lit(n), threshold).alias("t")).first().t == want


def test_item_catalog_keeps_the_newest(spark):
    rows = [("p", at(1), "old", 1), ("p", at(5), "new", None), ("q", None, "only", 3)]
    items = spark.createDataFrame(
        rows, "post_id string, post_created_at timestamp_ntz, post_topic string, num_click bigint"
    )
    text = ("post_status", "is_valid", "post_content_body", "post_tags", "post_target_group", "post_category")
    items = items.withColumns({c: F.lit(None).cast("string") for c in text}).withColumns(
        {c: F.lit(None).cast("bigint") for c in ("num_like", "num_comment", "num_share", "num_bookmark")}
    )
    got = {r.item_id: (r.title, r.views, r.like) for r in R.item_catalog(items).collect()}
    assert got == {"p": ("new", 0, 0), "q": ("only", 3, 0)}


def test_items_semi_join_without_ids_means_all(spark):
    items = spark.createDataFrame([("a",), ("b",)], "item_id string")
    some = spark.createDataFrame([("a",), (None,), ("a",)], "item_id string")
    none = spark.createDataFrame([(None,)], "item_id string")
    assert R.items_semi_join(items, some).count() == 1
    assert R.items_semi_join(items, none).count() == 2
    assert R.items_semi_join(items, None).count() == 2


def test_first_per_key_is_stable(spark):
    df = spark.createDataFrame([("k", i) for i in range(50)], "k string, v bigint")
    assert R.first_per_key(df, "k").first() == R.first_per_key(df.orderBy(F.desc("v")), "k").first()


def test_theme_summary(spark):
    rows = [("u1", f"TH_BIO{i}", at(i), "view", 100) for i in range(2)]
    rows += [("u1", "TH_F1", at(5), "like", 70000), ("u1", "TH_F1", at(6), "click", 0)]
    rows += [("u2", "x", at(1), "view", 0)]
    events = spark.createDataFrame(rows, SCHEMA)
    got = {
        r.user_id: r.theme_summary
        for r in T.theme_summary(T.theme_rollup(events), users(spark, ("u1", "en"), ("u2", "th")), 4, 30).collect()
    }
    assert got["u1"].split("\n") == [
        "Summary of last 30 days (total 4 events):",
        "Highest engagement themes:",
        "- data_career: score=3.3, events=2, likes=1, clicks=1, max_dwell_ms=70000",
        "- biotech: score=2.0, events=2, likes=0, clicks=0, max_dwell_ms=100",
        "Lower engagement themes: biotech",
    ]
    assert got["u2"].split("\n") == [
        "สรุปพฤติกรรม 30 วันล่าสุด (รวม 1 เหตุการณ์):",
        "ธีมที่มีการมีส่วนร่วมสูง:",
        "- other: คะแนน=1.0, เหตุการณ์=1, ไลก์=0, คลิก=0, dwell สูงสุด=0ms",
    ]


def test_history_needs_events_and_a_last20_row(spark, events, catalog):
    people = spark.createDataFrame(
        [("u1", "en"), ("u2", "en"), ("u9", "en")], "user_id string, preferred_language string"
    )
    last20 = spark.createDataFrame(
        [("u1", "['p', 'q']", "('t',)", None, "bad["), ("u9", "[]", "[]", "[]", "[]")],
        "user_id string, recent_post_interaction string, recent_tag_interaction string, "
        "recent_category_interaction string, recent_keyword_search string",
    )
    features = C.user_features(people, events, catalog, last20, JobParams(recent_k=2))
    got = {r.user_id: r.history_text for r in C.history_summary(features, 30).collect()}
    assert got["u1"] == (
        "User activity in last 30 days. Posts interacted: p, q. Tags: t. Categories: . "
        "Search keywords: . Recent feeds:  , Title A."
    )
    assert got["u2"] == "" and got["u9"] == ""


def test_a_hot_user_gives_the_same_ranking(spark):
    """One user with most rows: the ranking equals a plain Python one."""
    rows = [("hot", f"i{(7 * n) % 101}", at(n % 997), "view", 0) for n in range(3000)]
    rows += [(f"u{n % 40}", f"i{n % 13}", at(n), "view", 0) for n in range(600)]
    last = {}
    for u, i, t, *_ in rows:
        last[u, i] = max(t, last.get((u, i), t))
    want = {}
    for (u, i), t in last.items():
        want.setdefault(u, []).append((-t.timestamp(), i))
    want = {u: [i for _, i in sorted(v)[:5]] for u, v in want.items()}
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = {}
    for r in E.recent_items(df, 5).orderBy("user_id", "rk").collect():
        got.setdefault(r.user_id, []).append(r.item_id)
    assert got == want
