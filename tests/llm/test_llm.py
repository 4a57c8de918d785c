"""Brute-force comparisons and odd inputs for the operators of llm."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from intentloom.llm import context_mixing, crf_language, divergence, html_blocks, line_spread, mixing, quotes, suffix_dedup
from intentloom.llm.decontaminate import contaminated, drop_contaminated, tiles
from intentloom.llm.graph import components
from intentloom.llm.jaccard_join import jaccard_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, line string, doc string, rate double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, texts, parts=3):
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 12}", len(t or ""), "x", "y", 1.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def prose(seed, n, vocab=60):
    r = random.Random(seed)
    return " ".join(r.choice("ab cde fg hij k lm".split()) + str(r.randrange(vocab)) for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    """Null, empty, blank, short, long, repeated and near-equal texts."""
    base = prose(1, 200)
    near = base.split()
    near[50], near[120] = "changed", "altered"
    hot = prose(3, 45)
    out = [None, "", " \n\t ", "one two", "one two", "é" * 500, base, base, " ".join(near), prose(2, 4000, 5), "ab " * 400, "ab " * 410]
    out += [f"{prose(100 + i, 30)} {hot} {prose(200 + i, 25)}" for i in range(24)]
    out += [" ".join([*near[: 40 + i], "z" + str(i), *near[41 + i :]]) for i in range(12)]
    return out


def test_empty_table(spark):
    none = frame(spark, ["x"]).where("doc_id < 0")
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert jaccard_groups(none).count() == 0
    assert line_spread.remove_boilerplate(none).count() == 0
    assert crf_language.languages(none, crf_language.learned(none, F.col("doc_id"), F.col("text"), F.col("lang"), F.lit(True))).count() == 0
    assert divergence.judge(none).count() == 0
    assert mixing.mix(none, none.select("doc_id", F.lit("good").alias("domain"))).count() == 0
    assert context_mixing.score(none, F.lit(True)).count() == 0
    assert html_blocks.extract(none.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))).count() == 0
    assert contaminated(none, none.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


@pytest.mark.parametrize("most", [4096, 3])
def test_suffix_dedup(spark, odd, most):
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(frame(spark, odd), most=most).collect()}
    data = [(t or "").encode() for t in odd]
    seen = collections.Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    for d, b in enumerate(data):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        assert bytes(r.kept) == kept


def test_suffix_sort():
    r = random.Random(0)
    parts = [bytes(r.choice(b"ab") for _ in range(r.randrange(0, 40))) for _ in range(300)]
    group = np.sort(np.array([r.randrange(4) for _ in parts]))
    order, shared = suffix_dedup._depths(parts, group)
    want = sorted(range(len(parts)), key=lambda i: (group[i], parts[i]))
    assert [(group[i], parts[i]) for i in order] == [(group[i], parts[i]) for i in want]
    for i in range(1, len(order)):
        a, b = parts[order[i - 1]], parts[order[i]]
        n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert shared[i] == (n if group[order[i]] == group[order[i - 1]] else 0)


def test_jaccard_groups(spark, odd):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_groups(frame(spark, odd)).collect()}
    sets = []
    for t in odd:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(odd)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(odd)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: (len(sets[i]), find(i)) for i in range(len(odd))}


def plain_groups(texts):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("changes", [(1, 3), (2, 6), (4, 9)])
def test_jaccard_near_copies(spark, changes):
    """300 documents, 100 of them near copies of one text: links between the copies are all, some or hardly any."""
    r = random.Random(changes[0])
    base = prose(7, 120, 4000).split()
    texts = [prose(1000 + i, r.randrange(3, 90), 300) for i in range(170)]
    texts += [f"{prose(2000 + i, 12, 900)} {' '.join(base[:40])}" for i in range(30)]
    for i in range(100):
        words = list(base)
        for k in range(r.randrange(*changes)):
            words[r.randrange(len(words))] = f"edit{i}x{k}"
        texts.append(" ".join(words))
    r.shuffle(texts)
    got = {d: (n, c) for d, n, c in jaccard_groups(frame(spark, texts).select("doc_id", "text", "line")).collect()}
    assert got == plain_groups(texts)


def test_jaccard_shared_ids(spark):
    """An id of two texts links by either of them."""
    a, b = prose(1, 80, 900), prose(2, 80, 900)
    rows = [(1, a), (1, b), *((10 + i, f"{a} a{i}") for i in range(6)), *((30 + i, f"{b} b{i}") for i in range(6))]
    got = jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {1}


def test_jaccard_null_ids(spark):
    text = prose(1, 60)
    rows = [(None, text), (4, text), (3, text + " end"), (None, prose(2, 60)), (None, None), (9, prose(3, 60))]
    got = [tuple(r) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()]
    assert len(got) == len(rows)
    assert {(d, c) for d, _, c in got if d is not None} == {(3, 3), (4, 3), (9, 9)}
    assert sorted(((n, c) for d, n, c in got if d is None), key=str) == [(0, None), (56, 3), (56, None)]


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_components_of_links_in_many_parts(spark):
    from intentloom.llm import graph

    for parts in (1, 9):
        r = random.Random(parts)
        chain = r.sample(range(1000, 1200), 200)
        links = [(r.randrange(-300, 300), r.randrange(-300, 300)) for _ in range(250)] + list(zip(chain, chain[1:], strict=False))
        links += [(2000, 2000 + i) for i in range(1, 100)] + [(5, 5)]
        want = {}
        for a, b in links:
            want |= {a: want.get(a, a), b: want.get(b, b)} if a != b else {}
            low, high = sorted((want.get(a, a), want.get(b, b)))
            want = {x: low if c == high else c for x, c in want.items()}
        jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
        before = jobs()
        got = dict(components(spark.createDataFrame(links, "a long, b long").repartition(parts)).collect())
        assert got == want
        assert jobs() - before <= 30  # 13; 61 and 62 with six shuffles a round
        far, root = graph._stars(*(np.array(x) for x in zip(*((max(z), min(z)) for z in links if z[0] != z[1]), strict=True)))
        assert dict(zip(far.tolist(), root.tolist(), strict=True)) == {x: c for x, c in want.items() if x != c}


@pytest.mark.parametrize("nearest", ["any", "each", None])
def test_long_lists_are_compared_in_few_steps(monkeypatch, nearest):
    from intentloom.llm import jaccard_join

    r = np.random.default_rng(5)
    rows = []
    for token in range(6):
        ids = r.choice(300, 80, replace=False)
        for i, n in zip(ids, np.sort(r.integers(40, 60, 80)), strict=True):
            bits = np.zeros(1024, np.uint8)
            bits[r.integers(0, 1024, r.integers(0, 9))] = 1
            dist = 0.0 if i == ids[0] else float(r.choice([-1.0, 0.05, 0.4]))
            rows.append((token, ids[0], i, n, r.integers(0, 9), dist, i if r.random() < 0.6 else 0, None if r.random() < 0.1 else np.packbits(bits).tobytes()))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.binary()]
    names = ["token", "leader", "doc_id", "size", "pos", "dist", "comp", "sketch"]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
    want = set()
    for k, x in enumerate(rows):
        most = collections.Counter(z[6] for z in rows if z[0] == x[0])
        main = min(most, key=lambda c: (-most[c], c))
        found = []
        for m, y in enumerate(rows):
            low, high = (x, y) if k < m else (y, x)
            need = -(-(75 * (x[3] + y[3])) // 175)
            seen = x[5] >= 0 and y[1] == x[1] and y[2] == x[1] or y[5] >= 0 and x[2] == y[1]
            if x[0] != y[0] or x[6] in (main, y[6]) or y[6] != main and m < k or 100 * low[3] < 75 * high[3] or seen:
                continue
            if x[5] >= 0 and y[5] >= 0 and abs(x[5] - y[5]) > 0.25 + 1e-9 or 1 + min(x[3] - x[4], y[3] - y[4]) - 1 < need:
                continue
            apart = sum(int(p ^ q).bit_count() for p, q in zip(x[7], y[7], strict=True)) if x[7] and y[7] else 0
            if 2 * need <= x[3] + y[3] - apart:
                found.append((y[6] if nearest == "each" else 0, apart, m, (x[2], y[2], y[6], apart)))
        best = {f[0]: f for f in sorted(found, reverse=True)}
        want |= {(x[0], *f[3]) for f in (best.values() if nearest else found)}
    calls = []
    reach = jaccard_join._reachable
    monkeypatch.setattr(jaccard_join, "_reachable", lambda *z: calls.append(1) or reach(*z))
    out = [t for x in jaccard_join._rest_rows(75, nearest)(iter([batch.slice(0, 100), batch.slice(100)])) for t in zip(*x.to_pydict().values(), strict=True)]
    assert sorted(out) == sorted(w[1:] for w in want)
    assert len(calls) <= 3


def test_line_spread(spark):
    texts = [None, "", "same line\nown 0 is a longer line of its own", *(f" same line \nown {i} is a longer line of its own\n" for i in range(1, 14)), "same line"]
    got = {r.doc_id: r for r in line_spread.remove_boilerplate(frame(spark, texts), min_sites=10).collect()}
    assert got[0].text is None and got[1].text == ""
    assert got[2].text == "own 0 is a longer line of its own"
    assert got[5].text == "own 3 is a longer line of its own\n"
    assert got[16].text == "" and got[16].line_dedup.n_boilerplate == 1 and got[16].line_dedup.n_removed == 1
    assert got[2].line == "x" and got[2].rate == 1.0


def test_line_spread_against_plain_counts(spark):
    rng = random.Random(5)
    lines = [f"line {i}" for i in range(40)] + ["", "  "]
    rows = []
    for i in range(400):
        text = "\n".join(rng.choice(lines[: 5 + i % 37]) for _ in range(rng.randint(1, 8)))
        rows.append((rng.choice([i, 7, None]), rng.choice([text, text, "a copy\nof two lines", None]), rng.choice([None, *(f"s{k}" for k in range(3 + i % 23))]), i))
    rows += [(1, "a long text\n" * 3000, "s1", -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, line int").repartition(5)
    sites = {}
    for _, text, site, _ in rows:
        for line in set((text or "").split("\n")):
            if line.strip():
                sites.setdefault(line.strip(), {}).setdefault(text, set()).add(site)
    spread = {line: {min(s - {None}, default=None) for s in texts.values()} - {None} for line, texts in sites.items()}
    bad = {line for line, s in spread.items() if len(s) >= 10}
    want = sorted((n, None if t is None else "\n".join(x for x in t.split("\n") if x.strip() not in bad)) for _, t, _, n in rows)
    out = line_spread.remove_boilerplate(docs)
    got = sorted((r.line, r.text) for r in out.collect())
    assert 2 < len(bad) < 38 and "a copy" not in bad and got == want
    assert out.columns == [*docs.columns, "line_dedup"]


def test_tiling_catches_reordered_passages(spark):
    item = prose(9, 40).split()
    turned = item[20:] + ["between"] + item[:20]
    texts = [None, "", " ".join(item), prose(5, 50) + " " + " ".join(turned).upper(), " ".join(item[:12]) + " " + prose(6, 60), prose(7, 90)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (4, " ".join(item))], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contaminated(frame(spark, texts), bench).collect()}
    assert set(got) == {(d, i) for d in (2, 3) for i in (1, 4)}
    assert got[3, 1].n_tiles == 2 and got[3, 1].coverage == 1.0
    assert {r.doc_id for r in drop_contaminated(frame(spark, texts), bench).collect()} == {0, 1, 4, 5}


def test_tiles_do_not_overlap():
    found = tiles(np.array([0, 1, 10]), np.array([0, 1, 0]), 5, lambda t, i: True, 6)
    assert found == [(0, 0, 6)]


def test_language_field_switches(spark):
    r = random.Random(1)
    word = {"de": lambda: r.choice(("sch", "ung", "ver", "keit")) + r.choice(("en", "er", "ung")), "en": lambda: r.choice(("th", "wh", "sh")) + r.choice(("ing", "ed", "ly"))}
    texts, langs = [], []
    for i in range(60):
        lang = ("de", "en")[i % 2]
        langs.append(lang)
        texts.append(" ".join(word[lang]() for _ in range(40)))
    field = crf_language.fit(texts, langs)
    mixed = [word["de"]() for _ in range(30)] + [word["en"]() for _ in range(30)]
    labels = [x for _, x in crf_language.word_languages(" ".join(mixed), field)]
    assert sum(a == b for a, b in zip(labels, ["de"] * 30 + ["en"] * 30, strict=True)) >= 57
    got = crf_language.languages(frame(spark, [None, "", "12 34 ||", texts[0], texts[1], "É"]), field).orderBy("doc_id").collect()
    assert [x.lang_pred for x in got[:5]] == ["und", "und", "und", "de", "en"] and got[5].lang_pred != "und"


def test_forward_backward_matches_brute_force():
    field = crf_language.Field(["a", "b"])
    field.move = np.array([[1.0, -0.5], [0.2, 0.7]], np.float32)
    scores = np.random.default_rng(0).normal(size=(9, 2)).astype(np.float32)
    got = field.posteriors(scores, np.array([0, 9]))
    weight = np.zeros((9, 2))
    for path in np.ndindex(*(2,) * 9):
        w = math.exp(sum(scores[i, k] for i, k in enumerate(path)) + sum(field.move[path[i - 1], path[i]] for i in range(1, 9)) + math.log(math.exp(field.move[0, path[0]]) + math.exp(field.move[1, path[0]])))
        for i, k in enumerate(path):
            weight[i, k] += w
    assert np.allclose(got, weight / weight.sum(1, keepdims=True), atol=1e-4)


def test_divergence_counts(spark, odd):
    texts = [*odd, "a b c a b c\n\n a b \n a b \nx", "# $5 | <b> & *", prose(4, 300, 3)]
    for r in divergence.judge(frame(spark, texts)).collect():
        t = texts[r.doc_id] or ""
        w = WORD.findall(t)
        seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        again = {i + k for i, g in enumerate(zip(w, w[1:], w[2:], strict=False)) if seen[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_only_repeated_windows_are_sorted(spark):
    """Without a window found twice the count is nought, and the sort stands behind that test in the plan."""
    words = divergence.words_of(F.col("text"))
    docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(300)),), ("a b c a b c",), ("a b",), ("",), ("a a a a",)], "text string")
    rows = docs.select(divergence.repeat_words(words).alias("n"))
    assert [x.n for x in rows.collect()] == [0, 6, 0, 0, 4]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("array_distinct") < plan.index("sort_array")


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<p>", ""),
    ("<article><h1>A &amp; B</h1><p>one\n two&nbsp;three<p>x<script>if (a < b) '</p>'</script></article><footer>f</footer>", "A & B\none two three\nx"),
    ("<nav><a href=x>Home</a></nav><main><p>Body</p><div class='comments'><p>" + "nice " * 40 + "</p></div></main>", "Body"),
    ("<body><div id=side-bar class=sidebar>" + "word " * 60 + "</div><p>" + "text " * 50 + "</p></body>", ("text " * 50).strip()),
])
def test_main_text(page, text):
    assert html_blocks.main_text(page or "") == text


def test_later_links_walk_only_between_groups(spark, monkeypatch):
    from intentloom.llm import graph

    r = random.Random(3)
    first = [(r.randrange(300), r.randrange(300)) for _ in range(150)] + [(400 + i, 401 + i) for i in range(40)]
    later = [(r.randrange(350), r.randrange(350)) for _ in range(60)] + [(7, 7), (410, 430), (299, 420)]
    kind = "a long, b long"
    walked = []
    walk = graph.components

    def noted(links, a="a", b="b"):
        walked.append(links.select(F.least(a, b), F.greatest(a, b)).where(f"{a} <> {b}").distinct().count())
        return walk(links, a, b)

    groups = walk(spark.createDataFrame(first, kind))
    monkeypatch.setattr(graph, "components", noted)
    got = {x.id: x.component_id for x in graph.merged(groups, spark.createDataFrame(later, kind)).collect()}
    want = dict(walk(spark.createDataFrame(first + later, kind)).collect())
    assert {i: c for i, c in got.items() if i in want} == want and set(got) - set(want) <= {7}
    assert len(walked) == 1 and walked[0] <= len(later)


def test_context_mixing(spark, odd):
    docs = frame(spark, odd)
    got = {r.doc_id: r for r in context_mixing.score(docs.union(docs), F.pmod("doc_id", F.lit(3)) != 0).collect()}
    words = [[*WORD.findall((t or "").lower()), None] for t in odd]
    seen = collections.Counter(w for i, ws in enumerate(words) if i % 3 for w in ws * 2)
    n, v = sum(seen.values()), len(seen)
    for d, ws in enumerate(words):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d % 3 == 0, len(ws), sum(seen[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((seen[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert r.score < 0
    assert got[6].bits_per_byte < 4


def test_context_mixing_is_a_distribution():
    model = context_mixing.Model(np.random.default_rng(0).integers(-60, 60, context_mixing._STARTS[-1]).astype(np.int8))
    total = sum(10 ** model.score(np.array([b], np.uint8)) for b in range(256))
    assert total == pytest.approx(1, abs=1e-4)


def test_contexts_keep_counts_of_their_own(spark):
    r = random.Random(5)
    texts = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=3000)) for _ in range(40)]
    rows = frame(spark, texts).select(F.col("doc_id").alias("id"), "doc_id", (F.col("doc_id") % 4 != 0).alias("learn"), "text")
    true = collections.defaultdict(collections.Counter)
    for i, t in enumerate(texts):
        text = np.append(np.frombuffer(t.encode(), np.uint8), np.uint8(0))
        for key, byte in zip(context_mixing.contexts(text).T, text, strict=True):
            for k in key:
                true[int(k)][int(byte)] += i % 4 != 0
    assert len(true) > sum((1 << 12, 1 << 15, 1 << 17)) // 2
    seen = collections.defaultdict(dict)
    found = context_mixing.gathered(rows, 4096)[0].where("key is not null").collect()
    for x in found:
        seen[x.key] = dict(zip(x.seen, np.frombuffer(x.n, np.float32), strict=True))
    assert len({x.block for x in found}) > 10
    assert seen == {k: {b: n for b, n in c.items() if n} for k, c in true.items() if c.total()}


def test_context_mixing_is_fitted_on_all_training_texts(spark):
    texts = [*("plain words here " * 3 for _ in range(250)), "é" * 20_000, "ש" * 20_000]
    rows = frame(spark, texts).select(F.col("doc_id").alias("id"), "doc_id", (F.col("doc_id") < 251).alias("learn"), "text")
    blocks, (weights, last) = context_mixing.gathered(rows, 4096)
    read = blocks.mapInArrow(context_mixing._fit_rows, "place int, a double, b double").where(F.col("place") < context_mixing.LAST)
    assert read.agg(F.sum("a")).first()[0] == 8 * sum(len(t.encode()) + 1 for t in texts[:251])
    untrained = np.tile(1 / (1 + np.exp(-((np.arange(33) + 0.5) * 24 / 32 - 12))), 256).astype(np.float32).reshape(256, 33)
    moved = ~np.isclose(last.reshape(256, 33), untrained).all(1)
    bits = lambda byte: [(1 << j) | (byte >> (8 - j)) for j in range(8)]
    assert moved[bits("é".encode()[0])].all() and not moved[bits("ש".encode()[0])[4:]].any()
    assert np.isfinite(weights).all()


def test_equal_counts_share_log_odds(spark):
    rows = frame(spark, ["abcdefgh " * 50, "abcdefgh " * 50, "none like it"]).select(
        F.col("doc_id").alias("id"), "doc_id", (F.col("doc_id") < 2).alias("learn"), "text")
    batches = context_mixing.gathered(rows)[0].coalesce(1).sortWithinPartitions("block", F.col("key").isNull(), "id").toArrow().to_batches()
    for part, (odds, keys, starts) in context_mixing._by_block(batches):
        assert len(starts) == len(keys) + 1 and not odds[starts[-1] :].any()
        seen = {r["key"]: r for b in batches for r in b.to_pylist() if r["key"] is not None and r["block"] == part.column("block")[0].as_py()}
        assert len(odds) == 256 * (1 + len({(r["seen"], r["n"]) for r in seen.values()}))
        for key, start in zip(keys, starts, strict=False):
            dense = np.zeros(256, np.float32)
            dense[list(seen[int(key)]["seen"])] = np.frombuffer(seen[int(key)]["n"], np.float32)
            assert (odds[start : start + 256] == context_mixing.log_odds(dense)).all()


def test_what_blocks_send_grows_with_texts_not_with_copies_of_common_contexts(spark):
    r = random.Random(6)
    texts = [f"{prose(500 + i, 200)} {''.join(r.choices('abcdefghijklmnopqrstuvwxyz0123456789', k=600))}" for i in range(240)]
    rows = frame(spark, texts).select(F.col("doc_id").alias("id"), "doc_id", (F.col("doc_id") % 10 != 0).alias("learn"), "text")
    blocks, common = context_mixing._blocks(rows, 1 << 15)
    packed = {x.texts: x for x in blocks.where("block >= 0").groupBy("texts").agg(F.sum(F.length("data")).alias("size"), F.count("*").alias("n")).collect()}
    plain = context_mixing.gathered(rows, 1 << 15)[0].where("key is not null")
    each = plain.agg(F.sum(F.length("seen")), F.countDistinct("block"), F.count("*")).first()
    assert each[1] > 8 and packed[False].n < each[2] // 50
    assert packed[False].size < (8 * each[2] + 5 * each[0]) / 4  # plain rows have eight bytes for a key, five for a byte and its count
    assert packed[True].size < sum(map(len, texts)) * 0.8
    every, _ = common.counts()
    some = {x.key for x in plain.where("block = 0").collect()}
    assert len(every) and some & {int(k) for k in every >> np.uint64(8)}


def test_packed_and_plain_blocks_have_equal_scores(spark):
    texts = [prose(700 + i, 150 + i) for i in range(60)] + ["", "none like it", "zq " * 900]
    rows = frame(spark, texts).select(F.col("doc_id").alias("id"), "doc_id", (F.col("doc_id") % 3 != 0).alias("learn"), "text")
    blocks, common = context_mixing._blocks(rows, 1 << 13)
    assert len(common.counts()[0])
    view, fitted = context_mixing.gathered(rows, 1 << 13)
    columns = "id long, doc_id long, learn boolean, n long, n_bytes long, known long, logs double, score double"
    none = np.zeros(0, np.uint64), np.zeros(0)
    packed = {x.id: x.score for x in blocks.mapInArrow(context_mixing._score_rows(fitted, *none, common), columns).collect()}
    plain = {x.id: x.score for x in view.mapInArrow(context_mixing._score_rows(fitted, *none), columns).collect()}
    assert len(plain) == len(texts) and packed == pytest.approx(plain, rel=1e-5)


def test_mixing_meets_targets(spark):
    texts = [*("good word here " * 20 for _ in range(30)), *("poor junk stuff " * 10 for _ in range(10)), None, "", "unseen"]
    docs = frame(spark, texts)
    labels = docs.where("doc_id < 40").select("doc_id", F.when(F.col("doc_id") < 30, "good").otherwise("poor").alias("domain"))
    rows = mixing.mix(docs, labels, {"good": 0.4, "poor": 0.6}).collect()
    total = sum(r.tokens for r in rows)
    assert len(rows) == len(texts) and min(r.rate for r in rows) >= 0
    assert sum(r.rate * r.tokens * r.p_poor for r in rows) == pytest.approx(0.6 * total, rel=1e-3)
    assert sum(r.rate * r.tokens * r.p_good for r in rows) == pytest.approx(0.4 * total, rel=1e-3)


def test_mixing_keeps_every_row(spark):
    rows = [(None if i % 4 == 0 else i // 2, ["good word " * 9, "poor junk " * 5, None, ""][i % 7 % 4], i, 0.5) for i in range(80)]
    rows += [(3, "good word", -1, 0.5)] * 20  # repeated rows
    docs = spark.createDataFrame(rows, "doc_id long, text string, k int, rate double").repartition(7)
    labels = spark.createDataFrame([(1, "good"), (3, "poor")], "doc_id long, domain string")
    whole = mixing.mix(docs, labels, {"good": 0.5, "poor": 0.5}, whole=True)
    assert whole.columns == ["doc_id", "text", "k", "tokens", "p_good", "p_poor", "rate"]
    got = whole.collect()
    assert sorted((r.k, r.text or "", r.doc_id or -1) for r in got) == sorted((k, t or "", d or -1) for d, t, k, _ in rows)
    assert all(r.tokens == len((r.text or "").split()) for r in got)
    thin = mixing.mix(docs, labels, {"good": 0.5, "poor": 0.5}).collect()
    assert len(thin) == len(rows) and sum(r.rate * r.tokens for r in thin) == pytest.approx(sum(r.rate * r.tokens for r in got))


def test_mixing_against_plain_least_squares(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([1, 1, 1], 60)
    tokens, copies = rng.integers(1, 90, 60), rng.integers(1, 4, 60)
    members = spark.createDataFrame(
        [(int(t), int(c), *map(float, x)) for t, c, x in zip(tokens, copies, p)], "tokens long, copies long, p_a double, p_b double, p_c double"
    )
    n = (tokens * copies).astype(float)
    for targets in ({"a": 0.5, "b": 0.3, "c": 0.2}, {"a": 0.98, "b": 0.01, "c": 0.01}):
        goal = n.sum() * np.array(list(targets.values())) / sum(targets.values())
        rate, step = np.ones(60), 1 / np.trace((p * n[:, None]).T @ p)
        for _ in range(mixing.STEPS):  # plain projected gradient, as many steps
            rate = np.maximum(0, rate - step * p @ ((p * n[:, None]).T @ rate - goal))
        best = np.linalg.norm((p * n[:, None]).T @ rate - goal)
        rows = mixing.fit_rates(members, targets).collect()
        totals = np.array([sum(r.rate * r.tokens * r.copies * r[f"p_{d}"] for r in rows) for d in targets])
        assert min(r.rate for r in rows) >= 0
        assert np.linalg.norm(totals - goal) <= best
        assert targets["a"] > 0.9 or np.linalg.norm(totals - goal) <= 1e-4 * n.sum()  # what can be met is met


def test_quotes(spark):
    rows = [
        (1, 0, "user", "First point\nof two lines.\n\nSecond point."), (1, 1, "assistant", "> first  point\n> of two lines.\nI agree."),
        (1, 2, "user", ">> First point\n>> of two lines.\n> I agree.\nMe too."), (1, 3, "user", None), (1, 4, "user", "> Second point.\nNo."),
        (2, 0, "user", "> Me too.\nFrom elsewhere"), (2, 1, "user", "> never said"), (1, 3, "user", None), (3, None, "user", "> First"),
    ]
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    at = {(r.conv_id, r.turn): r for r in got}
    assert (at[1, 1].reply_to_turn, at[1, 1].depth, at[1, 1].text) == (0, 1, "I agree.")
    assert (at[1, 2].reply_to_turn, at[1, 2].depth, at[1, 2].root_turn, at[1, 2].text) == (1, 2, 0, "Me too.")
    assert (at[1, 4].reply_to_turn, at[1, 4].root_turn) == (0, 0)
    assert (at[1, 3].reply_to_turn, at[1, 3].text, at[1, 3].root_turn) == (None, "", 3)
    assert (at[2, 0].reply_to_conv, at[2, 0].reply_to_turn, at[2, 0].root_turn) == (1, 2, 0)
    assert at[2, 1].reply_to_conv is None and at[3, None].reply_to_conv is None


def test_quotes_link_past_own_and_null_conversations_and_by_parts(spark):
    rows = [
        (1, 0, "user", "> shared words\nreply"), (1, 1, "user", "shared words"), (2, 0, "user", "shared words"), (3, 0, "user", "shared words"),
        (None, 0, "user", "null thread"), (5, None, "user", "null thread"), (6, 2, "user", "null thread"), (7, 0, "user", "> null thread\nok"),
        (8, 0, "user", "A first line.\nAnother one here. And a sentence after it."), (8, 1, "user", "> another one here.\nYes."),
        (8, 2, "user", "> A first line.\n> And a sentence after it.\n> not said\nNo."), (9, 0, "user", "> and a sentence after it.\nSure."),
        (None, 1, "user", "> null thread\nsame"), (8, 3, "user", "> Another one\n> here.\nOnce more."), (8, 4, "user", "> another one here. and a sentence\nAgain."),
    ]
    got = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    to = {(r.conv_id, r.turn): (r.reply_to_conv, r.reply_to_turn) for r in got}
    assert len(got) == len(rows)
    assert to[1, 0] == (2, 0) and to[7, 0] == (6, 2) and to[None, 1] == (6, 2)
    assert to[8, 1] == (8, 0) and to[8, 2] == (8, 0) and to[9, 0] == (8, 0)
    assert to[8, 3] == (8, 0) and to[8, 4] == (8, 0)


def test_pipeline(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert 0 < len(out) <= docs and min(r.rate for r in out) >= 0
