"""Quality verdicts by the Jensen-Shannon distance to language references, in DataFrame operations only.

References are learned from all documents: for each language, the histogram of character classes
and that of its most frequent words. A document is compared with every language and judged by the
nearest. Documents with too few words, or too few characters, are not judged by a histogram that
they can't fill.

Null and empty texts have no words and fail the base rule. Repeated rows are judged alike. A null
language counts for no reference; without any reference nothing beyond the base rule is judged.
Ties between words are broken by the word. Texts are read whole; other columns are unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from intentloom.llm.runtime import stored

# The contract's white space and symbols.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
#: Frequent words of each reference.
COMMON = 40
#: Documents with fewer words or characters aren't judged by that histogram.
WORDS_GUARD, CHARS_GUARD = 50, 200
WORD_DISTANCE, CHAR_DISTANCE = 0.77, 0.26
_CLASSES = {"upper": "[A-Z]+", "digit": "[0-9]+", "mark": r"[.,;:!?'\"()\-]+"}


def _bind(value: Column, body) -> Column:
    """Evaluate an array once and use it in ``body`` many times."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda x: x != "")


def repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    The hashes of the windows carry their positions in the low bits and are sorted as numbers, so equal
    windows are neighbours; n log n for any text.
    """

    def count(h: Column) -> Column:
        n = F.size(h) - 2
        bits = F.ceil(F.log2(F.greatest(n, F.lit(1)) + 1)).cast("int")
        windows = F.transform(F.slice(h, 1, F.greatest(n, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
        # most texts repeat no window: only the others are sorted
        return _bind(windows, lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), F.array(F.lit(0).cast("long"))).otherwise(positions(t, bits)))

    def positions(t: Column, bits: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        tagged = F.sort_array(F.transform(t, lambda x, i: F.call_function("shiftleft", x, bits).bitwiseOR(i.cast("long"))))

        def twice(s: Column) -> Column:
            def same(x: Column, y: Column) -> Column:
                full = F.get(t, x.bitwiseAND(mask).cast("int")) == F.get(t, y.bitwiseAND(mask).cast("int"))
                return (F.call_function("shiftright", x, bits) == F.call_function("shiftright", y, bits)) & full

            return F.filter(s, lambda x, i: F.coalesce(same(x, F.get(s, i - 1)), F.lit(False)) | F.coalesce(same(x, F.get(s, i + 1)), F.lit(False)))

        at = F.sort_array(F.transform(_bind(tagged, twice), lambda x: x.bitwiseAND(mask)))
        return F.array(_bind(at, covered))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, i: F.when(i == 0, F.lit(3).cast("long")).otherwise(F.least(F.lit(3).cast("long"), x - F.get(p, i - 1)))),
            F.lit(0).cast("long"), lambda a, x: a + x,
        )

    return F.coalesce(_bind(F.transform(words, lambda x: F.xxhash64(x)), count)[0], F.lit(0).cast("long"))


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, lang, counts of the base rules and of character classes)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words, lines = F.col("c.words"), F.col("c.lines")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col("lang"), text.alias("text"),
        F.struct(words_of(text).alias("words"), F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))).alias("lines")).alias("c"),
    )
    chars = F.length(F.array_join(words, ""))
    return rows.select(
        "doc_id", "lang", F.size(words).cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeat_words(words).alias("n_repeat_words"), F.length("text").cast("long").alias("chars"),
        *(_removed(F.col("text"), p).cast("long").alias(c) for c, p in _CLASSES.items()),
    )


def _histogram() -> list[Column]:
    """Character classes: white space, capitals, digits, marks, symbols, and the rest."""
    space = F.col("chars") - F.col("word_chars")
    known = [space, F.col("upper"), F.col("digit"), F.col("mark"), F.col("n_symbols")]
    return [*known, F.greatest(F.lit(0).cast("long"), F.col("chars") - sum(known[1:], known[0]))]


def _divergence(p: Column, q: Column) -> Column:
    """The term of one bin, in nats."""
    m = (p + q) / 2
    part = lambda x: F.when(x > 0, x * F.log(x / m) / 2).otherwise(0.0)
    return part(p) + part(q)


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), divergence / F.log(F.lit(2.0))))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, n_words, base counts, base_failed, kept, nearest, char_distance, word_distance)."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = stored(base(docs, "doc_id", "text"), "counts")
    bins = _histogram()
    sums = rows.where("lang is not null and chars > 0").groupBy("lang").agg(*(F.sum(b).alias(f"q{i}") for i, b in enumerate(bins)))
    all_q = sum((F.col(f"q{i}") for i in range(1, len(bins))), F.col("q0"))
    known = sums.select("lang", *((F.col(f"q{i}") / all_q).alias(f"q{i}") for i in range(len(bins)))).orderBy("lang").collect()  # a row for each language
    kind = f"array<struct<ref:string,{','.join(f'q{i}:double' for i in range(len(bins)))}>>"
    refs = F.array(*(F.struct(*(F.lit(x) for x in r)) for r in known)).cast(kind)

    words = docs.select("doc_id", "lang", F.explode(F.split(F.lower(F.col("text")), SPACE)).alias("word")).where("word <> ''")
    counts = words.where("lang is not null").groupBy("lang", "word").count()
    top = W.partitionBy("lang").orderBy(F.desc("count"), "word")
    common = stored(counts.withColumn("r", F.row_number().over(top)).where(F.col("r") <= COMMON), "common")
    total = W.partitionBy("lang")
    # COMMON rows for each language
    common = common.select(F.col("lang").alias("ref"), F.col("word").alias("term"), (F.col("count") / F.sum("count").over(total)).alias("q"))
    hits = words.select("doc_id", "word").join(F.broadcast(common), F.col("word") == F.col("term")).groupBy("doc_id", "ref", "term").agg(
        F.count("*").alias("n"), F.first("q").alias("q")
    )
    per = hits.groupBy("doc_id", "ref").agg(F.sum("n").alias("total"), F.collect_list(F.struct("n", "q")).alias("bins"))
    shared = F.aggregate("bins", F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("q")), lambda a, x: F.struct(
        (a["d"] + _divergence(x["n"] / F.col("total"), x["q"])).alias("d"), (a["q"] + x["q"]).alias("q")))
    # bins that the document leaves empty add q log 2 / 2 each
    per = per.select("doc_id", "ref", shared.alias("s")).select(
        F.struct("doc_id", "ref").alias("k"), _distance(F.col("s.d") + (1 - F.col("s.q")) * F.log(F.lit(2.0)) / 2).alias("word_distance")
    )
    p = [F.when(F.col("chars") > 0, b / F.col("chars")).otherwise(0.0) for b in bins]
    char = _distance(sum((_divergence(p[i], F.col(f"q{i}")) for i in range(1, len(bins))), _divergence(p[0], F.col("q0"))))
    near = (
        rows.select("doc_id", "chars", "word_chars", "upper", "digit", "mark", "n_symbols").distinct()
        .select("*", F.inline(refs)).select("doc_id", "ref", char.alias("char_distance"))
        .join(per, (F.col("doc_id").eqNullSafe(F.col("k.doc_id"))) & (F.col("ref") == F.col("k.ref")), "left")
        .select("doc_id", "ref", "char_distance", F.coalesce("word_distance", F.lit(1.0)).alias("word_distance"))
        .groupBy("doc_id").agg(F.min_by(F.struct("ref", "char_distance", "word_distance"), F.struct(F.col("word_distance") + F.col("char_distance"), "ref")).alias("near"))
    ).select(F.struct("doc_id", "near").alias("v"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    char_d, word_d = F.col("v.near.char_distance"), F.col("v.near.word_distance")
    far = (F.col("n_words") >= WORDS_GUARD) & (word_d > WORD_DISTANCE) | (F.col("chars") >= CHARS_GUARD) & (char_d > CHAR_DISTANCE)
    return rows.join(near, F.col("doc_id").eqNullSafe(F.col("v.doc_id")), "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"),
        F.col("v.near.ref").alias("nearest"), F.round(char_d, 9).alias("char_distance"), F.round(word_d, 9).alias("word_distance"),
    )
