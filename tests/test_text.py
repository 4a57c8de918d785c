import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from intentloom.functions import text as X
from intentloom.operators import themes as T


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(fn(F.col("c")).alias("r")).first().r


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, ""),
        ("  a\r\nb   c\t d \n", "a b c\t d"),
        (" 　x ", "x"),
        ("\n \n", ""),
    ],
)
def test_clean_text(spark, raw, want):
    assert one(spark, raw, X.clean_text) == want


@pytest.mark.parametrize(
    "raw, n, want",
    [
        ("abcdef", 0, ""),
        ("abcdef", -1, ""),
        ("abcdef", 1, "…"),
        ("abcdef", 6, "abcdef"),
        ("abc def", 5, "abc…"),
        ("นักศึกษา", 8, "นักศึกษา"),
        ("นักศึกษา", 4, "นัก…"),
        (None, 4, ""),
    ],
)
def test_truncate_text(spark, raw, n, want):
    assert one(spark, raw, lambda c: X.truncate_text(c, n)) == want


def test_text_functions_agree_with_python(spark):
    """strip, clean and truncate against plain Python over many generated texts."""
    alphabet = st.sampled_from("ab \t\n\r 　 ก็é😀")
    samples = set()

    @settings(max_examples=200, deadline=None, database=None)
    @given(st.text(alphabet, max_size=14))
    def gather(t):
        samples.add(t)

    gather()

    def clean(t):
        t = t.replace("\n", " ").replace("\r", " ").strip()
        while "  " in t:
            t = t.replace("  ", " ")
        return t

    df = spark.createDataFrame([(t,) for t in sorted(samples)], "c string")
    rows = df.select(
        "c", X.strip("c").alias("s"), X.clean_text("c").alias("k"), X.truncate_text("c", 5).alias("t")
    ).collect()
    for r in rows:
        assert r.s == r.c.strip()
        assert r.k == clean(r.c)
        assert len(r.t) <= 5
        assert r.t == (r.c if len(r.c) <= 5 else r.c[:4].rstrip() + "…")


@pytest.mark.parametrize(
    "raw, want",
    [(None, "th"), ("", "th"), (" en ", "en"), ("EN", "th"), ("fr", "th"), ("th", "th")],
)
def test_language(spark, raw, want):
    assert one(spark, raw, X.normalize_language) == want


def test_or_default(spark):
    assert [one(spark, v, lambda c: X.or_default(c, "d")) for v in (None, "", " ")] == ["d", "d", " "]


def test_roles(spark):
    got = one(spark, "a||Data  Lead | |b", X.parse_roles)
    assert [tuple(r) for r in got] == [("a", "a", 1), ("data__lead", "Data  Lead", 2), ("b", "b", 3)]
    assert one(spark, None, X.parse_roles) == []


def test_skills(spark):
    got = one(spark, "x:1:2; Big Data ;;y: ;:L3", X.parse_skills)
    assert [tuple(r) for r in got] == [
        ("x", "x", "1"), ("big_data", "Big Data", "unknown"), ("y", "y", ""), ("", "", "L3"),
    ]
    array = '[{"skill_id":"7","skill_name":"SQL","skill_level":"L2"},\n{"skill_name":"A B"}]'
    assert [tuple(r) for r in one(spark, array, X.parse_skills)] == [
        ("7", "SQL", "L2"), ("a_b", "A B", "unknown"),
    ]
    assert [tuple(r) for r in one(spark, "[broken", X.parse_skills)] == [("[broken", "[broken", "unknown")]
    assert one(spark, ";", X.parse_skills) == []


def test_interests(spark):
    assert one(spark, " a ; ;b;", X.parse_interests) == ["a", "b"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("['a', \"b\"]", ["a", "b"]),
        ("['it\\'s']", ["it's"]),
        ("('a', 'b')", ["a", "b"]),
        ('["x"]', ["x"]),
        ("[]", []),
        ("['a', None]", ["a"]),
        ("[None, 'b', None, 'c']", ["b", "c"]),
        ("('a',)", ["a"]),
        ("['a','b',]", ["a", "b"]),
        ("['a\\xa0b']", ["a\xa0b"]),
        ("['None']", ["None"]),
        ("['a'", []),
        ("junk", []),
        ("", []),
        (None, []),
    ],
)
def test_list_literals(spark, raw, want):
    assert one(spark, raw, X.parse_list_column) == want


def test_times(spark):
    iso = lambda c: X.iso_z(X.parse_ts(c))
    assert one(spark, "2026-01-06T13:12:10Z", iso) == "2026-01-06T13:12:10Z"
    assert one(spark, "2026-01-06 13:12:10+07:00", iso) == "2026-01-06T06:12:10Z"
    assert one(spark, " 2026-01-06 13:12:10 ", iso) == "2026-01-06T13:12:10Z"
    assert one(spark, "soon", iso) is None
    assert one(spark, "2026-01-06 23:30:00", lambda c: X.run_name(c.cast("timestamp"))) == "260107_0630"


def test_safe_int(spark):
    assert one(spark, "3.7", X.safe_int) == 0
    assert one(spark, " 12 ", X.safe_int) == 12
    assert one(spark, None, X.safe_int) == 0
    assert one(spark, 3.7, X.safe_int, "double") == 3


@pytest.mark.parametrize(
    "item, want",
    [
        ("th_f001", "data_career"), ("EN_F2", "data_career"), ("TH_BIO9", "biotech"),
        ("Th_Sch1", "scholarship"), ("TH_UNI", "university"), ("TH_X", "other"), (None, "other"),
    ],
)
def test_theme(spark, item, want):
    assert one(spark, item, T.infer_theme) == want


@pytest.mark.parametrize(
    "kind, dwell, want",
    [
        ("view", 0, "1.0"), (" CLICK ", 9999, "1.2"), ("like", 10000, "1.7"), ("share", 30000, "2.0"),
        ("comment", 60000, "2.2"), ("bookmark", None, "2.0"), ("odd", 59999, "1.4"), (None, 0, "1.0"),
    ],
)
def test_score(spark, kind, dwell, want):
    df = spark.createDataFrame([(kind, dwell)], "event_type string, dwell_ms bigint")
    assert str(T.score_events(df).first().score) == want
