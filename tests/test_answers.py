import json

import pytest
from hypothesis import given, settings, strategies as st


from intentloom.functions.answers_json import close_object, first_object, resolve
from intentloom.operators import answers as A

values = st.recursive(
    st.none() | st.booleans() | st.integers() | st.text('a"\\{}[]é', max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text('k"{', max_size=3), inner, max_size=3),
    max_leaves=8,
)
objects = st.dictionaries(st.text("k{}", max_size=3), values, max_size=3)


@pytest.mark.parametrize(
    "text, want",
    [
        ('x {"a": {"b": "}"}} y', '{"a": {"b": "}"}}'),
        (r'{"a": "say \"}\" "} tail', r'{"a": "say \"}\" "}'),
        ('{"a": 1', None),
        ("none", None),
        ("", None),
        (None, None),
        ('{} {"b": 1}', "{}"),
        (r'\{"a":1}', '{"a":1}'),
    ],
)
def test_first_object(text, want):
    assert first_object(text) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"a":[{"b":1', '{"a":[{"b":1}]}'),
        ('{"a":[1,2', '{"a":[1,2]}'),
        (' {"a":1} ', '{"a":1}'),
        ('{"a":"open', None),
        ("[1", None),
        (None, None),
    ],
)
def test_close_object(text, want):
    assert close_object(text) == want


@settings(max_examples=200, deadline=None, database=None)
@given(objects, st.text('ab" \\', max_size=5))
def test_an_object_is_found_whole(value, tail):
    text = json.dumps(value, ensure_ascii=False)
    assert first_object("note " + text + tail) == text


@settings(max_examples=200, deadline=None, database=None)
@given(objects, st.data())
def test_closing_repairs_or_refuses(value, data):
    text = json.dumps(value)
    cut = text[: data.draw(st.integers(1, len(text)))]
    closed = close_object(cut)
    if closed is not None:
        assert closed.startswith(cut.strip())
        assert close_object(closed) == closed
    if cut == text:
        assert closed == text


@settings(max_examples=200, deadline=None, database=None)
@given(st.text('{}[]"\\a,:1 ', max_size=30))
def test_no_text_raises(text):
    first_object(text), close_object(text)
    answer, how = resolve([text], text)
    assert (answer is None) == (how == "failed")


@pytest.mark.parametrize(
    "parts, text, want",
    [
        (['{"a":1}'], None, ('{"a":1}', "direct")),
        (["  ", 'Sure {"a":1}!'], None, ('{"a":1}', "first_object")),
        (['{"a":[1'], None, ('{"a":[1]}', "auto_close")),
        (['[{"a":1}]'], '[{"a":1}]', ('{"a":1}', "text_first_object")),
        (['[1]', '{"a":1}'], None, (None, "failed")),
        (["null"], '{"a":{"b":1}', ('{"a":{"b":1}}', "text_auto_close")),
        ([], None, (None, "failed")),
        ([None, '{"b":2}'], "", ('{"b":2}', "direct")),
    ],
)
def test_resolution_order(parts, text, want):
    assert resolve(parts, text) == want


def test_resolve_answers_columns(spark):
    rows = [("1", '{"p":1}', None, None), ("2", None, ["x"], '{"t":2'), ("3", None, None, None)]
    df = spark.createDataFrame(rows, "id string, parsed string, parts array<string>, text string")
    got = A.resolve_answers(df, parsed="parsed", parts="parts", text="text").orderBy("id").collect()
    assert [(r.answer, r.resolution) for r in got] == [
        ('{"p":1}', "parsed"), ('{"t":2}', "text_auto_close"), (None, "failed"),
    ]


@pytest.mark.parametrize(
    "answer, texts, error",
    [
        ('{"queries":[{"query_text":" a "},{"query_text":null},{}]}', ["a", "", ""], None),
        ('{"queries":[]}', [], None),
        ('{"queries":null}', [], None),
        ("{}", [], None),
        ('{"queries":"x"}', [], "queries must be a list"),
        ('{"queries":{"a":1}}', [], "queries must be a list"),
        ('{"queries":[{"query_text":"a"}, 2]}', [], "queries entries must be objects"),
        ('{"queries":[null]}', [], "queries entries must be objects"),
        (None, [], "no JSON object"),
        ('{"queries":[{"query_text":5}]}', ["5"], None),
    ],
)
def test_parse_queries(spark, answer, texts, error):
    df = spark.createDataFrame([(answer,)], "answer string")
    row = A.parse_queries(df, "queries").first()
    assert [q.query_text for q in row.queries] == texts
    assert row.query_error == error


def test_explode_keeps_users_without_queries(spark):
    df = spark.createDataFrame(
        [("u1", '{"queries":[{"query_id":"Q1"},{"query_id":"Q2"}]}'), ("u2", None)],
        "user_id string, answer string",
    )
    got = A.explode_queries(df, "queries").orderBy("user_id", "slot").collect()
    assert [(r.user_id, r.slot, r.query_id, r.error) for r in got] == [
        ("u1", 1, "Q1", None), ("u1", 2, "Q2", None), ("u2", None, None, "no JSON object"),
    ]


COLUMNS = (
    "user_id string, query_id string, query_text string, weight double, intent_label string, "
    "template string, language string, output_language string"
)


def query_rows(spark, *rows):
    return spark.createDataFrame(rows, COLUMNS)


def five(user, texts, lang="en"):
    return [(user, f"Q{i}", t, 1.0, "profile_based", "profile", lang, lang) for i, t in enumerate(texts, 1)]


def test_checks(spark):
    good = five("ok", ["one two three four five six", "b c d e f g", "x", "d", "e"])
    twice = five("twice", ["Same  text", "same text", "c", "d", "D "]) + [
        ("twice", "Q5", "again", 0.6, "ai_exploration", "interaction", "th", "fr")
    ]
    df = query_rows(spark, *good, *twice, *five("few", ["a", "b"], "th"))
    slots = {r.user_id: (r.n_queries, r.missing_slots, r.ok) for r in A.check_slots(df).collect()}
    assert slots == {"ok": (5, "", True), "twice": (6, "", False), "few": (2, "Q3,Q4,Q5", False)}
    differ = {r.user_id: (r.q1_q2_differ, r.q4_q5_differ) for r in A.check_distinct(df).collect()}
    assert differ["ok"] == (True, True) and differ["few"] == (True, True)
    assert differ["twice"][0] is False
    lengths = [r.ok for r in A.check_length(df.where("user_id = 'ok'")).orderBy("query_id").collect()]
    assert lengths == [True, True, False, False, False]
    plan = A.check_slot_plan(df, A.slot_plan_table(spark)).where("user_id = 'twice' and template = 'interaction'")
    assert [tuple(r)[3:] for r in plan.collect()] == [(True, True, True)]
    language = A.check_language(df).where("user_id = 'twice' and not allowed").collect()
    assert len(language) == 1 and not language[0].ok


@pytest.mark.parametrize(
    "text, words_ok", [("ก" * 24, False), ("ก" * 25, True), ("ก" * 70, True), ("ก" * 71, False), (None, False)]
)
def test_thai_length(spark, text, words_ok):
    df = query_rows(spark, ("u", "Q1", text, 1.0, "x", "profile", "th", "th"))
    assert A.check_length(df).first().ok is words_ok


@pytest.mark.parametrize(
    "text, ok", [("plain words", True), ("no, comma", False), ("“quoted”", False), ("ภาษาไทย", True), ("a|b", False)]
)
def test_style(spark, text, ok):
    df = query_rows(spark, ("u", "Q1", text, 1.0, "x", "profile", "th", "th"))
    assert A.check_style(df).first().ok is ok


def test_parsing_runs_once_per_row(spark):
    """The plan holds one typed parse and one shape check, and the UDF stays single."""
    df = spark.createDataFrame([("u", "{}")], "user_id string, raw string")
    found = A.explode_queries(A.resolve_answers(df, text="raw"), "queries")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("resolve_answer(") == 1
