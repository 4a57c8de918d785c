"""Virtual slots, prefix trie and collocations against plain versions, and odd inputs."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from intentloom.llm import phrases, prefix_trie, virtual_slots
from intentloom.llm.runtime import stored

CLASHING = "c long, d string, p string, slot string, piece string, bytes string, r string, g1 string, k string"


def with_clashes(df):
    for f in CLASHING.split(", "):
        name, kind = f.split()
        df = df.withColumn(name, F.lit("7").cast(kind))
    return df


# virtual slots

DOCS = "doc_id long, text string"


def slot_docs(spark):
    r = random.Random(5)
    rows = [(i, "é" * r.randrange(400)) for i in range(700)] + [(None, "same")] * 500 + [(None, None)] * 3 + [(4, None), (4, ""), (5, "x" * 3000)]
    return rows, with_clashes(spark.createDataFrame(rows, DOCS).repartition(5))


def test_slots_hold_every_row_in_equal_shards(spark):
    rows, docs = slot_docs(spark)
    got = virtual_slots.deal(docs, 6).collect()
    want = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert collections.Counter((x.doc_id, x["size"], x.text_crc32) for x in got) == want
    load = collections.Counter()
    for x in got:
        load[x.shard] += x["size"]
    assert set(load) == set(range(6)) and max(load.values()) - min(load.values()) < 0.02 * sum(load.values())
    for shard in range(6):
        assert sorted(x.slot for x in got if x.shard == shard) == list(range(sum(x.shard == shard for x in got)))
    assert {x.law for x in got} == {"bytes"} and {x.grown_shard for x in got} == {None}


def test_a_map_is_edited_and_not_made_anew(spark):
    _, docs = slot_docs(spark)
    rows = virtual_slots.records(docs)
    sizes = virtual_slots.slot_sizes(rows, 6)
    first = virtual_slots.first_map(sizes, 6)
    even = virtual_slots.rebalanced(sizes, first, 6)
    more = virtual_slots.grown(sizes, even, 6)
    maps = [{(x.slot, x.piece): x.shard for x in m.collect()} for m in (first, even, more)]
    assert [{x.version for x in m.collect()} for m in (first, even, more)] == [{0}, {1}, {2}]
    weight = {(x.slot, x.piece): x.bytes for x in sizes.collect()}
    assert set(maps[0]) == set(maps[1]) == set(maps[2]) == set(weight)
    fair = sum(weight.values()) / 6

    def loads(m):
        out = collections.Counter()
        for k, shard in m.items():
            out[shard] += weight[k]
        return out

    before = loads(maps[0])
    moved = {k for k in maps[0] if maps[0][k] != maps[1][k]}
    assert moved and all(before[maps[0][k]] > fair for k in moved)
    assert {maps[2][k] for k in maps[1] if maps[1][k] != maps[2][k]} == {6}
    grown = loads(maps[2])
    assert max(grown[s] for s in range(6)) <= sum(weight.values()) / 7 < grown[6] < fair * 1.1


def test_no_documents_no_slots(spark):
    _, docs = slot_docs(spark)
    assert virtual_slots.deal(docs.where("doc_id < 0"), 6).collect() == []


# prefix trie


def plain_trie(rows):
    """Every prefix of every rebuilt conversation, grouped outright."""
    said = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(v)] for c, v in said.items()}
    built = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = said.get(c - c % 20, [])[:h] + own[h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
        ends[tuple(built[c])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        cost = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += cost
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else -1, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p, m in members.items()
    )


def spark_trie(spark, rows):
    df = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    turns = stored(prefix_trie.turns(df), "numbered")
    parts, members = prefix_trie.rebuilt(turns, F.crc32(F.col("c").cast("string")) % 4, F.col("c") - F.col("c") % 20)
    return sorted(
        (x.conv_id, x.depth, -1 if x.parent_conv_id is None else x.parent_conv_id, x.n_convs, x.n_children, x.n_leaves, x.saved_tokens, x.ends_sha256)
        for x in prefix_trie.prefix_trie(parts, members).collect()
    )


def test_trie_equals_every_prefix_grouped(spark):
    r = random.Random(3)
    rows = []
    for c in range(90):  # few texts, so that conversations share long beginnings, end inside others and are repeated
        rows += [(c, t, "u" if t % 2 else "a", f"w{r.randrange(2)} x y") for t in range(r.choice([1, 2, 3, 5, 9, 17]))]
    rows += [(c, t, "u", "same one") for c in range(100, 119) for t in range(6)]
    rows += [(200 + c, t, None, None if t < c else f"own {c}") for c in range(12) for t in range(c + 3)]  # a ladder
    rows += [(300, None, "z", "first"), (300, 1, "b", "tie"), (300, 1, "a", "tie"), (300, 1, "a", "tie"), (None, 1, "a", "nobody's"), (301, 0, "", "")]
    rows += [(400, t, "u", f"long {t}") for t in range(300)] + [(401, t, "u", f"long {t}" if t < 250 else "else") for t in range(260)]
    assert spark_trie(spark, rows) == plain_trie(rows)


def test_trie_of_one_turn_and_of_nothing(spark):
    assert spark_trie(spark, [(1, 0, "u", "a b")]) == plain_trie([(1, 0, "u", "a b")])
    assert spark_trie(spark, [(None, 0, "u", "a b")]) == []


def test_member_hashes_run_over_many_pieces(spark):
    ids = [-3000, -1, *range(0, 5000, 3), 1 << 40]
    df = spark.createDataFrame([(i,) for i in ids], "c long").withColumn("p", F.expr(prefix_trie.ROOT)).repartition(7)
    (row,) = prefix_trie.member_hashes(df).collect()
    assert row.ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


# collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def plain_collocations(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for p in pieces(text):
            n[lang] += len(p)
            f.update((lang, tuple(p[i : i + k])) for k in range(1, 6) for i in range(len(p) - k + 1))
    f = {k: v for k, v in f.items() if v >= least}
    inside = collections.Counter()
    for (lang, w), v in f.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inside[lang, w[i : i + m]] = max(inside[lang, w[i : i + m]], v)
    out = collections.defaultdict(list)
    for (lang, w), a in f.items():
        if len(w) > 1 and not 100 * inside[lang, w] >= 100 * a:
            score, c = min((1000 * a * n[lang] // (f[lang, w[:c]] * f[lang, w[c:]]), c) for c in range(1, len(w)))
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:c]], f[lang, w[c:]]))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items() for i, (s, a, p, left, right) in enumerate(sorted(v)[:top], 1)
    )


def phrase_rows():
    r = random.Random(8)
    words = "The of ÉTÉ to x it's en es de und".split(" ") + [f"w{i}" for i in range(30)]
    out = [(r.choice(["en", "de", None, "es", "und", ""]), "".join(r.choice(words[: r.choice([3, 9, 40])]) + r.choice([" "] * 9 + ["\t ", ". ", ",", "\r\n"]) for _ in range(r.randrange(60)))) for _ in range(400)]
    out += [("en", "a a a a a a a a " * 40), ("en", None), ("en", ""), (None, " ..\n"), ("xx", "new york city of new york " * 30)]
    return out + [("fr", "quite the same text, quite")] * 90


@pytest.mark.parametrize("shards, least, top", [(4, 20, 2000), (1, 5, 7), (3, 100, 2000)])
def test_collocations_equal_outright_counts(spark, shards, least, top):
    rows = phrase_rows()
    docs = with_clashes(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    got = phrases.collocations(docs, min_count=least, shards=shards, top=top)
    assert sorted(tuple(x) for x in got.collect()) == plain_collocations(rows, least, top)


def test_no_texts_no_collocations(spark):
    docs = spark.createDataFrame([("en", None), (None, "")], "lang string, text string")
    assert phrases.collocations(docs).collect() == []
    assert phrases.collocations(docs.where("lang = 'x'")).collect() == []


@pytest.mark.parametrize("limit", [7, 50, 1000])
def test_blocks_of_long_texts_count_each_phrase_once(monkeypatch, limit):
    monkeypatch.setattr(phrases, "BLOCK_BYTES", limit)
    rows = phrase_rows()
    batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.string())], ["lang", "text"])
    got, want = collections.Counter(), collections.Counter()
    for row, block in phrases._blocks(batch, 5):
        for i in range(len(block.start)):
            for k in range(1, 6):
                if block.own[i] and block.left[i] >= k:
                    lang, text = rows[row + int(block.row[i])]
                    first, length = divmod(int(block.span(np.array([i]), k)[0]), 1 << 32)
                    said = text.encode()[first : first + length].decode().translate(LOWER)
                    got[lang, re.sub(r"[\x20\x09]+", " ", said)] += 1
    for lang, text in rows:
        for p in pieces(text):
            want.update((lang, " ".join(p[i : i + k])) for k in range(1, 6) for i in range(len(p) - k + 1))
    assert got == want


def test_sql_is_right_on_odd_rows():
    con = duckdb.connect()
    con.execute("create table documents (lang varchar, text varchar)")
    con.executemany("insert into documents values (?, ?)", phrase_rows())
    cols = "lang, rank, phrase, a, l, r, n, score"
    assert sorted(con.sql(f"select {cols} from ({phrases.oracle(20)})").fetchall()) == plain_collocations(phrase_rows(), 20, 2000)
