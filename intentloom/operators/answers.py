"""From raw model answers to checked search queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from intentloom.functions.answers_json import resolve_answer
from intentloom.functions.text import clean_text, col, normalize_language, rows_of, strip, word_count
from intentloom.params import CHARS_TH, LANGUAGES, SLOT_PLANS, SLOTS, WORDS_EN


def resolve_answers(
    responses: DataFrame,
    *,
    parsed: str | None = None,
    parts: str | None = None,
    text: str | None = None,
) -> DataFrame:
    """Add ``answer`` (object text or null) and ``resolution``.

    ``parsed`` is a column with an already parsed object as JSON text,
    ``parts`` an array column of text parts, ``text`` the whole text.
    """
    whole = col(text) if text else F.lit(None).cast("string")
    pieces = col(parts) if parts else F.array(whole)
    done = F.col(parsed).isNotNull() if parsed else F.lit(False)
    # rows that are parsed already send nulls to Python
    # kept out of filter push-down, which would run it a second time
    found = resolve_answer.asNondeterministic()(F.when(~done, pieces), F.when(~done, whole))
    out = responses.withColumn("_found", found)
    answer, how = F.col("_found.answer"), F.col("_found.resolution")
    if parsed:
        answer = F.when(done, F.col(parsed)).otherwise(answer)
        how = F.when(done, "parsed").otherwise(how)
    return out.withColumn("answer", answer).withColumn("resolution", how).drop("_found")


_QUERIES = "array<struct<query_id:string,query_text:string,weight:double,intent_label:string>>"
_EMPTY = ("", "0", "false", "null", "{}", "[]")


def parse_queries(df: DataFrame, field: str, answer: str = "answer") -> DataFrame:
    """Add ``queries`` and ``query_error`` from an object text.

    A missing or empty list is no error and gives an empty array; a field that is
    no list, or an entry that is no object, is one. The list is cut out, typed and
    checked in columns of their own, so each of these runs once per row.
    """
    listed = df.withColumn("_list", F.get_json_object(answer, f"$.{field}"))
    typed = listed.withColumns(
        {
            "_kind": F.schema_of_variant(F.try_parse_json("_list")),
            "_typed": F.from_json("_list", _QUERIES),
        }
    )
    empty = F.col("_list").isNull() | F.col("_list").isin(*_EMPTY)
    kind = F.coalesce("_kind", F.lit(""))
    error = (
        F.when(F.col(answer).isNull(), "no JSON object")
        .when(empty, F.lit(None))
        .when(~kind.startswith("ARRAY<"), f"{field} must be a list")
        .when(~kind.startswith("ARRAY<OBJECT<"), f"{field} entries must be objects")
    )
    good = ~empty & kind.startswith("ARRAY<OBJECT<")

    def entry(q: Column) -> Column:
        text = strip(F.coalesce(q["query_text"], F.lit("")))
        return F.struct(
            q["query_id"].alias("query_id"),
            text.alias("query_text"),
            q["weight"].alias("weight"),
            q["intent_label"].alias("intent_label"),
        )

    queries = F.when(good, F.transform("_typed", entry)).otherwise(F.array().cast(_QUERIES))
    return typed.withColumns({"queries": queries, "query_error": error}).drop(
        "_list", "_kind", "_typed"
    )


def explode_queries(answers: DataFrame, field: str) -> DataFrame:
    """One row per query in answer order; users without one keep a row of nulls."""
    return (
        parse_queries(answers, field)
        .select("user_id", "query_error", F.posexplode_outer("queries").alias("position", "q"))
        .select(
            "user_id", (F.col("position") + 1).alias("slot"), "q.*", F.col("query_error").alias("error")
        )
    )


# ---------------------------------------------------------------------------
# Checks over a query table: user_id, query_id, query_text, weight,
# intent_label, template, language, output_language
# ---------------------------------------------------------------------------

_SLOT_IDS = tuple(f"Q{i}" for i in range(1, SLOTS + 1))


def check_slots(queries: DataFrame) -> DataFrame:
    """Exactly Q1..Q5, once each."""
    per_slot = [F.count_if(F.col("query_id") == s).alias(s) for s in _SLOT_IDS]
    counted = queries.groupBy("user_id").agg(F.count("query_id").alias("n_queries"), *per_slot)
    once_each = F.lit(True)
    for s in _SLOT_IDS:
        once_each = once_each & (F.col(s) == 1)
    missing = F.concat_ws(",", *[F.when(F.col(s) == 0, s) for s in _SLOT_IDS])
    return counted.select(
        "user_id",
        "n_queries",
        missing.alias("missing_slots"),
        ((F.col("n_queries") == SLOTS) & once_each).alias("ok"),
    )


def check_length(queries: DataFrame) -> DataFrame:
    counted = queries.select(
        "user_id",
        "query_id",
        "language",
        word_count("query_text").cast("bigint").alias("n_words"),
        F.length(strip(F.coalesce("query_text", F.lit("")))).cast("bigint").alias("n_chars"),
    )
    ok = F.when(F.col("language") == "en", F.col("n_words").between(*WORDS_EN)).otherwise(
        F.col("n_chars").between(*CHARS_TH)
    )
    return counted.withColumn("ok", ok).drop("language")


def check_distinct(queries: DataFrame) -> DataFrame:
    """Q1 differs from Q2, and Q4 from Q5, after normalising case and spaces."""
    text = F.lower(clean_text("query_text"))
    slots = {s: F.max(F.when(F.col("query_id") == s, text)).alias(s) for s in ("Q1", "Q2", "Q4", "Q5")}
    wide = queries.groupBy("user_id").agg(*slots.values())

    def differ(a: str, b: str) -> Column:
        return ~F.coalesce(F.col(a) == F.col(b), F.lit(False))

    return wide.select(
        "user_id",
        differ("Q1", "Q2").alias("q1_q2_differ"),
        differ("Q4", "Q5").alias("q4_q5_differ"),
    )


def slot_plan_table(spark: SparkSession) -> DataFrame:
    rows = [(t, *slot) for t, plan in SLOT_PLANS.items() for slot in plan]
    return rows_of(spark, rows, "template", "query_id", "plan_label", "plan_weight")


def check_slot_plan(queries: DataFrame, plan: DataFrame) -> DataFrame:
    """Weight and label against the plan, a fixed table of 25 rows (broadcast)."""
    joined = queries.join(F.broadcast(plan), ["template", "query_id"], "left")
    return joined.select(
        "user_id",
        "query_id",
        "template",
        F.col("plan_label").isNotNull().alias("slot_known"),
        F.coalesce(F.col("weight") == F.col("plan_weight"), F.lit(False)).alias("weight_ok"),
        F.coalesce(F.col("intent_label") == F.col("plan_label"), F.lit(False)).alias("label_ok"),
    )


def check_style(queries: DataFrame) -> DataFrame:
    text = F.coalesce("query_text", F.lit(""))
    return queries.select(
        "user_id", "query_id", (~text.rlike(r"[\p{P}\p{Punct}]")).alias("ok")
    )


def check_language(queries: DataFrame) -> DataFrame:
    """The answer's language is an allowed one and that of the profile."""
    allowed = F.coalesce(F.col("output_language").isin(*LANGUAGES), F.lit(False))
    same = normalize_language("output_language") == normalize_language("language")
    return queries.select(
        "user_id", "query_id", allowed.alias("allowed"), (allowed & same).alias("ok")
    )
