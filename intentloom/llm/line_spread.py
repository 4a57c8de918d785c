"""Cross-site boilerplate lines by the spread of each line over distinct sites.

Every line hash gets a HyperLogLog sketch of its sites, merged by aggregation: map-side first, so
a line on a third of all documents sends one sketch a task. Lines whose estimate lies within a band
around the threshold get an exact distinct count; the others are far enough off. A line on
``min_sites`` sites or more is boilerplate and is removed wherever it stands, from every document.

A text that stands in many documents says no more about its lines than one of them: it counts for
the smallest of its sites only, so that copies of a document on many sites, which are for
deduplication to judge, don't turn its own lines into boilerplate.

Lines are split at \\n and compared without white space at their ends; lines without other
characters are never removed. A null text stays null, an empty one empty. A null site counts as no
site. Rows are told apart by a 128-bit hash of id and text: null and shared ids and repeated rows are cleaned
each by its own text. Extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.llm.runtime import stored

MIN_SITES = 10
BAND = 0.2
SKETCH_BITS = 10


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """96 bits for a line; null if there is nothing in it."""
    bare = F.btrim(line, F.lit(" \t\r\f\x0b"))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b")))


def _row(id_col: Column, text: Column) -> Column:
    return F.struct(F.xxhash64(id_col, text).alias("a"), F.xxhash64(F.lit("row"), text, id_col).alias("b"))


def boilerplate_lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_sites: int = MIN_SITES) -> DataFrame:
    """(row, bad): for each row hash with boilerplate the places of those lines, from 0."""
    lines = docs.select(
        _row(F.col(id_col), F.col(text_col)).alias("row"), F.xxhash64(text_col).alias("text"), F.col(site_col).alias("site"),
        F.posexplode(F.transform(_lines(F.col(text_col)), _key)).alias("pos", "line"),
    ).where("line is not null")
    lines = stored(lines, "lines")
    sites = lines.groupBy("line", "text").agg(F.min("site").alias("site"))
    spread = sites.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"))
    spread = stored(spread.where(F.col("sites") >= min_sites * (1 - BAND)), "spread")
    near = spread.where(F.col("sites") <= min_sites * (1 + BAND)).select("line")
    exact = (
        lines.join(near, "line", "left_semi").groupBy("line", "text").agg(F.min("site").alias("site"))
        .select("line", "site").distinct().groupBy("line").agg(F.count("site").alias("sites"))
    )
    bad = spread.where(F.col("sites") > min_sites * (1 + BAND)).select("line").union(
        exact.where(F.col("sites") >= min_sites).select("line")
    )
    return lines.select("row", "pos", "line").join(bad, "line", "left_semi").groupBy("row").agg(F.collect_set("pos").alias("bad"))


def remove_boilerplate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES,
) -> DataFrame:
    """The documents with cleaned text and a struct column ``line_dedup`` (n_lines, n_boilerplate, n_removed)."""
    bad = boilerplate_lines(docs, id_col, text_col, site_col, min_sites).select(F.struct("row", "bad").alias("b"))
    text = F.col(f"d.`{text_col}`")
    rows = docs.select(F.struct("*").alias("d"))
    joined = rows.join(bad, _row(F.col(f"d.`{id_col}`"), text) == F.col("b.row"), "left")
    # set difference by hashing: linear in the lines, where a search of each among the bad ones is not
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("l") - 1), F.col("b.bad")), lambda i: F.get(F.col("l"), i))
    joined = joined.withColumn("l", _lines(text)).withColumn("kept", F.when(F.col("b").isNull(), F.col("l")).otherwise(kept))
    n, k = F.size("l"), F.size("kept")
    gone = F.when(text.isNull(), 0).otherwise(n - k).cast("long")
    count = F.struct(F.when(text.isNull(), 0).otherwise(n).cast("long").alias("n_lines"), gone.alias("n_boilerplate"), gone.alias("n_removed"))
    return joined.select(
        *(F.array_join("kept", "\n").alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns if c.lower() != "line_dedup"),
        count.alias("line_dedup"),
    )


def oracle(min_sites: int = MIN_SITES) -> str:
    """DuckDB SQL for the query, with exact counts throughout."""
    return f"""
with split as (select doc_id, source, text, string_split(text, chr(10)) as ls from documents),
lines as (select doc_id, source, unnest(ls) as l, generate_subscripts(ls, 1) as i, text from split),
bare as (select *, trim(l, chr(32)||chr(9)||chr(13)||chr(12)||chr(11)) as b from lines),
seen as (select b, text, min(source) as source from bare where b <> '' group by b, text),
bad as (select b from seen group by b having count(distinct source) >= {min_sites}),
marked as (select bare.*, bad.b is not null as gone from bare left join bad on bare.b = bad.b),
per as (select doc_id, count(*) as n_lines, count(*) filter (gone) as n_boilerplate,
 coalesce(string_agg(l, chr(10) order by i) filter (not gone), '') as kept from marked group by doc_id)
select doc_id, n_lines, n_boilerplate, n_boilerplate as n_removed, md5(kept) as kept_md5 from per"""
