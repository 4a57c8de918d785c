"""Collocations by dynamic itemset counting over cyclic scans of shards.

The texts are dealt into shards once. Step by step one shard after the other is scanned, round and
round. Words are counted from the first step; a longer phrase becomes active as soon as both phrases
that it is made of by leaving out its last and its first word have reached ``min_count`` so far, in
whatever step that is. So all lengths are counted side by side.

A frequent phrase has its share of the threshold, ``min_count`` by the number of shards, in one shard
at least. Counts are kept from the first shard on in which a phrase has that much, for one full cycle. As that
shard is one of the first cycle after activation, a phrase stays active for two cycles less one
step, and the scans end when no phrase reached the threshold within as many steps. So what is kept
and merged is about as small as what is frequent, however many rare phrases there are.

A phrase is counted wholly or not at all in a step, and the count of a shard is added once
whichever step brings it, so a cycle that begins anywhere ends with the exact count. Which phrases
have reached the threshold is passed to the tasks as a bit filter of fixed size: a phrase that it
lets through by chance costs rows, and cannot reach the threshold, as no phrase occurs more often
than its parts. Counts are summed in each task before the shuffle. Phrases are told apart by 128 bits,
the language among them; each keeps the place of one occurrence, from which its words are read in the end.

A text that is null or has no words adds nothing. A null language counts as ``und``. Repeated rows
count each. Documents need no id. An empty table gives no rows. Texts are worked on in blocks of a
few megabytes; memory grows further only with the longest single word.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intentloom.llm import kernel
from intentloom.llm.runtime import stored

MIN_COUNT = 100
MAX_WORDS = 5
SHARDS = 4
TOP = 2000
#: Of each of the two filters, 4 MB; the driver receives at most one row for 64 of them.
FILTER_BITS = 1 << 25

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_STEP = np.uint64(kernel.BASES[1])
_COUNTED = "g1 long, g2 long, k int, n long, doc long, span long"
BLOCK_BYTES = 4 * kernel.CHUNK_BYTES


class Block:
    """Words of some texts: where they lie, how many words are left in their piece, and whose phrases are counted here.

    ``skipped`` bytes of the first text came in blocks before.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, own: int, languages: list[np.ndarray], skipped: int = 0):
        kind = _KIND[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kind == 0
        cut = np.zeros(len(data) + 1, bool)
        cut[at] = True
        self.start = np.flatnonzero(inside[1:-1] & (cut[:-1] | ~inside[:-2]))
        self.end = np.flatnonzero(inside[1:-1] & (cut[1:] | ~inside[2:])) + 1
        self.row = np.searchsorted(at, self.start, "right") - 1
        piece = np.cumsum(kind == 2)[self.start] + self.row
        self.left = np.searchsorted(piece, piece, "right") - np.arange(len(piece))
        self.own = self.start < own
        self.at, self.skipped = at, skipped
        self.data = kernel.lower(data)
        self.words = [kernel.mix(kernel.span_hashes(kernel.prefix_hashes(self.data, w), self.start, self.end, w)) for w in (0, 1)]
        self.seeds = [x[self.row] for x in languages]

    def longer(self, hashes: list[np.ndarray], k: int, at: np.ndarray) -> list[np.ndarray]:
        """Hashes of the phrases of k words at the given words, from those of k - 1 words at all of them."""
        out = []
        for g, h in zip(hashes, self.words):
            x = (g[at] + h[at + (k - 1)]) * _STEP
            out.append(x ^ (x >> np.uint64(29)))
        return out

    def span(self, i: np.ndarray, k: int) -> np.ndarray:
        """First byte in the text and length of the phrases of k words at the given words, in one number."""
        first, last = self.start[i], self.end[i + max(k - 1, 0)]
        return ((first - self.at[self.row[i]] + self.skipped) << 32) | (last - first)


def _skip(data: np.ndarray, at: int, word: bool) -> int:
    """The first byte from ``at`` that is no part of a word, or that is."""
    while at < len(data):
        found = np.flatnonzero((_KIND[data[at : at + 65536]] != 0) == word)
        if len(found):
            return at + int(found[0])
        at += 65536
    return len(data)


def _blocks(batch: pa.RecordBatch, max_words: int) -> Iterator[tuple[int, Block]]:
    """(first row, words) of a batch of languages and texts. Blocks of a long text share some words at their ends."""
    names = pc.fill_null(batch.column(0), "und")
    data, at = kernel.bytes_of(names)
    # mixed twice, as a language must not count as the word of the same letters
    languages = [kernel.mix(kernel.mix(kernel.span_hashes(kernel.prefix_hashes(data, w), at[:-1], at[1:], w)) + _STEP) for w in (0, 1)]
    for row, last, data, at in kernel.chunks(batch.column(1), BLOCK_BYTES):
        mine = [x[row:last] for x in languages]
        pos = 0
        while len(data) - pos > 2 * BLOCK_BYTES:
            own = end = _skip(data, pos + BLOCK_BYTES, True)
            for _ in range(max_words):
                end = _skip(data, _skip(data, end, False), True)
            yield row, Block(data[pos:end], np.array([0, end - pos]), own - pos, mine, pos)
            pos = own
        yield row, Block(data[pos:], np.maximum(at - pos, 0), len(data), mine, pos)


class Filter:
    """Phrases by one bit of their hash."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def slot(g: Column) -> Column:
        return F.shiftrightunsigned(g, 20).bitwiseAND(FILTER_BITS - 1)

    def has(self, g: np.ndarray) -> np.ndarray:
        slot = (g >> np.uint64(20)) & np.uint64(FILTER_BITS - 1)
        return (self.words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def _filters(phrases: DataFrame, *wanted: Column) -> list[Filter]:
    """A filter for each condition; what reaches the driver is bounded by FILTER_BITS."""
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    bits = phrases.withColumn("slot", Filter.slot(F.col("g1"))).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        *(F.bit_or(F.when(w, bit).otherwise(F.lit(0).cast("long"))).alias(f"f{i}") for i, w in enumerate(wanted))
    ).toArrow()
    out = []
    for i in range(len(wanted)):
        words = np.zeros(FILTER_BITS // 64, np.uint64)
        words[bits.column("word").to_numpy()] = bits.column(f"f{i}").to_numpy().view(np.uint64)
        out.append(Filter(words))
    return out


def _runs(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, where runs of equal hashes begin, their lengths)."""
    order = np.argsort(hashes[0], kind="stable")
    a, b = hashes[0][order], hashes[1][order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(a)))


def _counter(filters, words: bool, total: bool, max_words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the active phrases by block: of words in the first steps, of longer phrases by the filters.

    With ``total``, also the words of each language, as phrases of no words.
    """

    def active(block: Block) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
        reached, young = filters.value
        mine = np.flatnonzero(block.own)
        if total:
            yield 0, [g[mine] for g in block.seeds], mine
        hashes = block.longer(block.seeds, 1, np.arange(len(block.start)))
        if words:
            yield 1, [g[mine] for g in hashes], mine
        alive = np.flatnonzero(reached.has(hashes[0]))
        for k in range(2, max_words + 1):
            known = np.zeros(len(block.start) + 1, bool)
            known[alive] = True
            first = alive[known[alive + 1] & (block.left[alive] >= k)]
            fresh = young.has(hashes[0][first]) | young.has(hashes[0][first + 1])
            now = block.longer(hashes, k, first)
            wanted = fresh & block.own[first]
            yield k, [g[wanted] for g in now], first[wanted]
            for old, new in zip(hashes, now, strict=True):
                old[first] = new
            alive = first[reached.has(now[0])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(2).to_numpy()
            for row, block in _blocks(batch, max_words):
                for k, hashes, places in active(block):
                    order, first, n = _runs(hashes)
                    at = order[first]
                    words_at = places[at]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(g[at].view(np.int64)) for g in hashes), pa.array(np.full(len(at), k, np.int32)), pa.array(n),
                         pa.array(docs[row + block.row[words_at]]), pa.array(block.span(words_at, k))],
                        ["g1", "g2", "k", "n", "doc", "span"],
                    )

    return run


def phrase_counts(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS, shards: int = SHARDS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of the phrases that occur ``min_count`` times or more, and (lang, n), the words of each language."""
    spark = docs.sparkSession
    texts = stored(
        docs.select(
            F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
            F.monotonically_increasing_id().alias("doc"), F.pmod(F.monotonically_increasing_id(), F.lit(shards)).alias("shard"),
        ).where("text is not null"), "texts", "shard",
    )
    share, horizon = -(-min_count // shards), 2 * shards - 1
    counts, step, last = None, 0, -1
    while step < horizon or last >= step - horizon:
        shard = step % shards
        if counts is None:
            filters = [Filter(np.zeros(FILTER_BITS // 64, np.uint64))] * 2
        else:
            parts = counts.where(f"reached is not null and k between 1 and {max_words - 1}")
            filters = _filters(parts, F.lit(True), F.col("reached") >= step - horizon)
        sent = spark.sparkContext.broadcast(filters)
        scan = texts.where(F.col("shard") == shard).select("lang", "text", "doc").mapInArrow(_counter(sent, step < horizon, step < shards, max_words), _COUNTED)
        bit = F.lit(1 << shard).cast("long")
        none = F.lit(None).cast("long")
        rows = scan.select("g1", "g2", "k", none.alias("old"), "n", none.alias("seen"), none.cast("int").alias("reached"), "doc", "span")
        if counts is not None:
            rows = rows.union(counts.select("g1", "g2", "k", F.col("f").alias("old"), none.alias("n"), "seen", "reached", "doc", "span"))
        rows = rows.groupBy("g1", "g2", "k").agg(*(F.max(c).alias(c) for c in ("old", "seen", "reached")), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *(F.first(c).alias(c) for c in ("doc", "span")))
        # what is not known yet and has less than its share of the threshold in this shard has it in another, or is rare
        rows = rows.where(F.col("old").isNotNull() | (F.col("n") >= share) | (F.col("k") == 0))
        old, seen = F.coalesce("old", F.lit(0)), F.coalesce("seen", F.lit(0).cast("long"))
        rows = rows.select(
            "g1", "g2", "k", (old + F.when(seen.bitwiseAND(bit) != 0, 0).otherwise(F.col("n"))).alias("f"),
            F.when(F.col("n") > 0, seen.bitwiseOR(bit)).otherwise(seen).alias("seen"), "reached", "doc", "span",
        ).withColumn("reached", F.when(F.col("reached").isNull() & (F.col("f") >= min_count), F.lit(step)).otherwise(F.col("reached")))
        counts = stored(rows, "counts")
        last = counts.where(f"k between 1 and {max_words - 1}").agg(F.max("reached")).first()[0]
        last = -horizon - 1 if last is None else last
        sent.unpersist()
        step += 1
    found = counts.where("reached is not null or k = 0").select("doc", "span", "k", "f")
    here = found.join(texts.select("doc", "lang", "text"), "doc").select(
        F.coalesce("lang", F.lit("und")).alias("lang"), "k", "f",
        F.expr("decode(substring(cast(text as binary), cast(span >> 32 as int) + 1, cast(span & 4294967295L as int)), 'UTF-8')").alias("said"),
    )
    bare = F.regexp_replace(F.translate("said", string.ascii_uppercase, string.ascii_lowercase), "[\\x20\\x09]+", " ")
    named = stored(here.select("lang", bare.alias("phrase"), "k", "f"), "phrases")
    return named.where("k > 0"), named.where("k = 0").select("lang", F.col("f").alias("n"))


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS, shards: int = SHARDS, top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language that hold together best."""
    found, total = phrase_counts(docs, lang_col, text_col, min_count, max_words, shards)
    cand = found.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    inner = (
        cand.where("k > 2").select("lang", "w", "k", "a", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("m"))
        .select("lang", "w", "m", "a", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("i"))
        .select("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase"), F.col("a").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    left = cand.join(inner, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 100 * a")
    cuts = left.select("lang", "phrase", "a", "w", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("c")).select(
        "lang", "phrase", "a", "c", F.array_join(F.slice("w", F.lit(1), F.col("c")), " ").alias("p"),
        F.array_join(F.slice("w", F.col("c") + 1, F.col("k") - F.col("c")), " ").alias("q"),
    )
    part = found.select("lang", F.col("phrase").alias("p"), F.col("f").alias("l"))
    rest = part.select("lang", F.col("p").alias("q"), F.col("l").alias("r"))
    # products of three counts pass 64 bits: decimals of 38 digits, an overflow of which is an error
    scored = cuts.join(part, ["lang", "p"]).join(rest, ["lang", "q"]).join(total, "lang").withColumn(
        "score", F.expr("1000BD * cast(a as decimal(15,0)) * cast(n as decimal(18,0)) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    )
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "c", "l", "r")).alias("b"))
    ranked = best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")
    )
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP) -> str:
    """DuckDB SQL for the query: every phrase counted outright."""
    return rf"""
with piece as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p from documents),
words as (select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') as w from piece),
total as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang),
starts as (select lang, w, unnest(range(1, len(w) + 1)) as i from words),
grams as (select lang, w[i : i + k - 1] as g, k from starts, range(1, {max_words + 1}) as r(k) where i + k - 1 <= len(w)),
found as (select lang, g, any_value(k) as k, count(*) as f from grams group by lang, g having count(*) >= {min_count}),
cand as (select * from found where k > 1),
subs as (select lang, g, f, k, unnest(range(2, k)) as m from cand),
inside as (select lang, g[i : i + m - 1] as g, f from (select lang, g, f, m, unnest(range(1, k - m + 2)) as i from subs)),
longer as (select lang, g, max(f) as longer from inside group by lang, g),
kept as (select cand.* from cand left join longer using (lang, g) where longer is null or 100 * longer < 100 * f),
cuts as (select lang, g, f as a, unnest(range(1, k)) as c from kept),
scored as (select c.lang, c.g, c.c, c.a, x.f as l, y.f as r, n,
 cast((1000::hugeint * c.a * n) // (x.f::hugeint * y.f) as bigint) as score
 from cuts c join found x on x.lang = c.lang and x.g = c.g[1 : c.c] join found y on y.lang = c.lang and y.g = c.g[c.c + 1 :] join total t on t.lang = c.lang),
best as (select * from scored qualify row_number() over (partition by lang, g order by score, c) = 1),
named as (select lang, array_to_string(g, ' ') as phrase, a, l, r, n, score from best)
select lang, rank, phrase, a, l, r, n, score from (
 select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from named) where rank <= {top}"""
