"""Text, list and time columns."""

from __future__ import annotations

import ast
import json
import warnings

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from intentloom.params import DEFAULT_LANGUAGE, LANGUAGES

# The characters that count as blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def rows_of(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A small fixed table made of literals, without a Python worker or a file."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(BLANKS))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(col(c), F.lit(BLANKS))


def or_default(c: Column | str, default: str) -> Column:
    """Null and the empty string both take the default."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit(default))


def normalize_language(c: Column | str) -> Column:
    value = strip(col(c))
    return F.when(value.isin(*LANGUAGES), value).otherwise(F.lit(DEFAULT_LANGUAGE))


def clean_text(c: Column | str) -> Column:
    """Line breaks to spaces, trimmed, runs of spaces collapsed (tabs stay)."""
    text = F.coalesce(col(c), F.lit(""))
    one_line = F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" "))
    return F.regexp_replace(strip(one_line), " {2,}", " ")


def truncate_text(c: Column | str, max_chars: int) -> Column:
    if max_chars <= 0:
        return F.lit("")
    text = F.coalesce(col(c), F.lit(""))
    cut = F.concat(rstrip(F.substring(text, 1, max_chars - 1)), F.lit("…"))
    return F.when(F.length(text) <= max_chars, text).otherwise(cut)


def snake(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def non_blank_parts(c: Column | str, sep_regex: str) -> Column:
    """Split, drop blank parts; the parts keep their own padding."""
    parts = F.split(strip(F.coalesce(col(c), F.lit(""))), sep_regex)
    return F.filter(parts, lambda x: F.length(strip(x)) > 0)


def parse_roles(c: Column | str) -> Column:
    """``a|b`` to structs; priority counts from 1 after blanks are dropped."""
    return F.transform(
        non_blank_parts(c, r"\|"),
        lambda x, i: F.struct(
            snake(strip(x)).alias("role_id"),
            strip(x).alias("role_name"),
            (i + 1).cast("int").alias("priority"),
        ),
    )


_SKILL_JSON = "array<struct<skill_id:string,skill_name:string,skill_level:string>>"


def parse_skills(c: Column | str) -> Column:
    """``name:level;name`` or a JSON array of skill objects, to structs."""
    raw = strip(F.coalesce(col(c), F.lit("")))

    def from_part(x: Column) -> Column:
        name = strip(F.get(F.split(x, ":"), F.lit(0)))
        level = F.get(F.split(x, ":"), F.lit(1))
        return F.struct(
            snake(name).alias("skill_id"),
            name.alias("skill_name"),
            F.coalesce(strip(level), F.lit("unknown")).alias("proficiency"),
        )

    def from_object(o: Column) -> Column:
        name = F.coalesce(o["skill_name"], F.lit(""))
        return F.struct(
            F.coalesce(o["skill_id"], snake(name)).alias("skill_id"),
            name.alias("skill_name"),
            F.coalesce(o["skill_level"], F.lit("unknown")).alias("proficiency"),
        )

    listed = F.transform(non_blank_parts(raw, ";"), from_part)
    objects = F.transform(F.from_json(raw, _SKILL_JSON), from_object)
    return F.when(raw.startswith("["), F.coalesce(objects, listed)).otherwise(listed)


def parse_interests(c: Column | str) -> Column:
    return F.transform(non_blank_parts(c, ";"), strip)


def _entries(literal: str) -> list[str]:
    """The entries of one list literal in either notation; what is neither has none."""
    value = None
    for read in (ast.literal_eval, json.loads):
        try:
            value = read(literal)
            break
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            continue
    if not isinstance(value, list | tuple):
        return []
    # escaped halves of surrogate pairs become one character, or a mark where one is alone
    return [str(x).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace") for x in value if x is not None]


@F.arrow_udf(T.ArrayType(T.StringType()))
def _parsed_list(texts: pa.Array) -> pa.Array:
    # no iterator: Spark then reads all list columns of a row in one Python worker, not in one for each column
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", SyntaxWarning)  # of escapes that mean nothing
        return pa.array([_entries(x.as_py()) if x.is_valid else None for x in texts], pa.list_(pa.string()))


def parse_list_column(c: Column | str) -> Column:
    """A list or tuple literal, or a JSON list, to array<string>; anything else is an empty array.

    ``None`` and null entries are dropped; entries that are no strings have their literal form as text.
    """
    raw = strip(col(c))
    listed = raw.startswith("[") | raw.startswith("(")
    return F.coalesce(_parsed_list(F.when(listed, raw)), F.array().cast("array<string>"))


def parse_ts(c: Column | str) -> Column:
    """Text to timestamp (the session zone is UTC); anything unreadable is null."""
    return F.try_to_timestamp(strip(col(c)))


def iso_z(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_name(c: Column | str) -> Column:
    """Wall clock seven hours ahead of UTC, as used in run names."""
    return F.date_format(F.from_utc_timestamp(col(c), "+07:00"), "yyMMdd_HHmm")


def safe_int(c: Column | str) -> Column:
    """Integer value; unreadable or missing is 0."""
    return F.coalesce(col(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def word_count(c: Column | str) -> Column:
    text = strip(F.coalesce(col(c), F.lit("")))
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(text, f"[{BLANKS}]+")))
