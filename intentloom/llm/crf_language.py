"""Language of words in code-switched text by a linear-chain conditional random field.

A word's score for a language sums the weights of its character trigrams (with the word's ends),
of its first and last three bytes and of its lexicon entry (the whole word), all hashed; a matrix
of learned transitions links neighbours. Forward-backward over the whole text gives every word's
posterior; a document's language is the one with the most words with a letter in expectation.

The field is fitted by gradient steps on a bounded sample: at most ``PER_LANG`` documents of each
language, those of the smallest hash, of at most ``SAMPLE_BYTES`` each. Runs of words of different
documents are spliced, so that transitions are learned from switches with known labels.

Documents without a letter, empty and null texts: ``und`` with score 0; so is everything if no
labelled document is there to learn from. Repeated rows get equal answers; ties go to the
language that sorts first. Texts of any length are read whole, in blocks. Other columns are unused.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from intentloom.llm import kernel

PER_LANG = 400
SAMPLE_BYTES = 64_000
UND = "und"
_GRAMS, _AFFIXES, _LEXICON = 1 << 15, 1 << 14, 1 << 17
_BLOCK = 64


class Features:
    """Hashed feature indices of the words of a run of texts."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        low = kernel.lower(data)
        self.start, self.end, self.first = start, end, first = kernel.words(data, at)
        n = len(low)
        if not len(start):
            return
        inside = np.zeros(n + 1, np.int8)
        np.add.at(inside, start, 1)
        np.subtract.at(inside, end, 1)
        inside = np.cumsum(inside[:-1]).astype(bool)
        here = low.astype(np.uint32)
        before, after = np.empty_like(here), np.empty_like(here)
        before[1:], after[:-1] = here[:-1], here[1:]
        before[start], after[end - 1] = 32, 32
        code = (before * np.uint32(0x9E3779B1) ^ here * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
        self.grams = (code >> np.uint32(17))[inside].astype(np.intp)
        self.gram_at = np.concatenate([[0], np.cumsum(end - start)[:-1]])
        stop, begin = np.maximum(end - 3, start), np.minimum(start + 3, end)
        prefix = kernel.prefix_hashes(low)
        self.head = (kernel.mix(kernel.span_hashes(prefix, start, begin)) >> np.uint64(50)).astype(np.intp)
        self.tail = (kernel.mix(kernel.span_hashes(prefix, stop, end)) >> np.uint64(50)).astype(np.intp)
        self.word = (kernel.mix(kernel.span_hashes(prefix, start, end)) >> np.uint64(47)).astype(np.intp)
        letter = np.add.reduceat(((low[inside] >= 97) & (low[inside] <= 122) | (low[inside] >= 128)).astype(np.int64), self.gram_at)
        self.letters = letter


class Sample:
    """The features of all words of a column, built chunk by chunk and kept in 32 bits: the sample lies in one task."""

    def __init__(self, column: pa.Array):
        first, parts, words = [np.zeros(1, np.int64)], [], 0
        for _, _, data, at in kernel.chunks(column):
            f = Features(data, at)
            first.append(f.first[1:] + words)
            words += len(f.start)
            if len(f.start):
                parts.append([x.astype(np.int32) for x in (f.grams, np.diff(np.append(f.gram_at, len(f.grams))), f.head, f.tail, f.word)])
        self.first = np.concatenate(first)
        self.grams, self.count, self.head, self.tail, self.word = (
            (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int32) for _ in range(5))
        )
        self.gram_at = np.cumsum(self.count, dtype=np.int64) - self.count


class Field:
    """Weights of the field."""

    def __init__(self, labels: list[str]):
        k = len(labels)
        self.labels = labels
        self.w = [np.zeros((n, k), np.float32) for n in (_GRAMS, _AFFIXES, _AFFIXES, _LEXICON)]
        self.move = np.eye(k, dtype=np.float32) * 2

    def scores(self, f: Features) -> np.ndarray:
        g, h, t, x = self.w
        return np.add.reduceat(g[f.grams], f.gram_at, axis=0) + h[f.head] + t[f.tail] + x[f.word]

    def posteriors(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Forward-backward over each text. Blocks of words run side by side: the product of each block's
        transfer matrices first, then the messages from block to block, then those inside the blocks."""
        k = scores.shape[1]
        emit = np.exp(scores - scores.max(1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
        move = np.exp(self.move - self.move.max())
        length = np.diff(first)
        blocks = -(-length // _BLOCK)
        base = np.concatenate([[0], np.cumsum(blocks)])
        doc = np.repeat(np.arange(len(length)), blocks)
        begin = first[doc] + (np.arange(base[-1]) - base[doc]) * _BLOCK
        words = np.minimum(_BLOCK, first[doc + 1] - begin)
        index = begin[:, None] + np.arange(_BLOCK)
        valid = np.arange(_BLOCK) < words[:, None]
        e = np.where(valid[:, :, None], emit[np.minimum(index, len(emit) - 1)], np.float32(1))
        product = np.broadcast_to(np.eye(k, dtype=np.float32), (len(begin), k, k)).copy()
        for t in range(_BLOCK):
            step = (product @ move) * e[:, t, None, :]
            step /= step.max((1, 2), keepdims=True)
            product = np.where(valid[:, t, None, None], step, product)
        ahead = np.empty((len(begin), k), np.float32)
        behind = np.empty((len(begin), k), np.float32)
        many = np.argsort(-blocks, kind="stable")
        live = blocks[many]
        now = np.full((len(length), k), 1 / k, np.float32)
        back = np.full((len(length), k), 1 / k, np.float32)
        for s in range(int(blocks.max())):
            d = many[: int(np.searchsorted(-live, -s))]
            b = base[d] + s
            ahead[b] = now[d]
            x = (now[d][:, None, :] @ product[b])[:, 0]
            now[d] = x / x.sum(1, keepdims=True)
            b = base[d + 1] - 1 - s
            behind[b] = back[d]
            x = (product[b] @ back[d][:, :, None])[:, :, 0]
            back[d] = x / x.sum(1, keepdims=True)
        alpha = np.empty_like(e)
        for t in range(_BLOCK):
            x = (ahead @ move) * e[:, t]
            x /= x.sum(1, keepdims=True)
            ahead = np.where(valid[:, t, None], x, ahead)
            alpha[:, t] = ahead
        for t in range(_BLOCK - 1, -1, -1):
            x = behind * alpha[:, t]
            x /= x.sum(1, keepdims=True)
            alpha[:, t] = x
            y = (behind * e[:, t]) @ move.T
            behind = np.where(valid[:, t, None], y / y.sum(1, keepdims=True), behind)
        return alpha[valid]


def fit(texts: list[str], langs: list[str], epochs: int = 4, seed: int = 0) -> Field:
    """Fit a field on texts of one language each, spliced into switching runs of 64 words."""
    labels = sorted(set(langs))
    field = Field(labels)
    if len(labels) < 2:
        return field
    rng = np.random.default_rng(seed)
    f = Sample(pa.array(texts, pa.large_string()))
    if not len(f.word):
        return field
    gold = np.repeat([labels.index(x) for x in langs], np.diff(f.first))
    n, k = len(gold), len(labels)
    pieces, p = [], 0
    while p < n:
        size = int(rng.integers(4, 60))
        pieces.append(np.arange(p, min(n, p + size)))
        p += size
    sums = [np.full(w.shape, 1e-3, np.float32) for w in field.w]
    move_sum = np.full((k, k), 1e-3, np.float32)
    for _ in range(epochs):
        order = np.concatenate([pieces[i] for i in rng.permutation(len(pieces))])
        order = order[: len(order) // _BLOCK * _BLOCK] if len(order) >= _BLOCK else order
        runs = order.reshape(-1, min(_BLOCK, len(order)))
        for s in range(0, len(runs), 256):
            _step(field, f, gold, runs[s : s + 256], sums, move_sum)
    return field


def _step(field: Field, f: Sample, gold: np.ndarray, runs: np.ndarray, sums: list, move_sum: np.ndarray) -> None:
    k, flat = len(field.labels), runs.ravel()
    count = f.count[flat]
    gram_at = np.cumsum(count, dtype=np.int64) - count
    grams = np.repeat(f.gram_at[flat] - gram_at, count) + np.arange(count.sum())
    g, h, t, x = field.w
    score = np.add.reduceat(g[f.grams[grams]], gram_at, axis=0) + h[f.head[flat]] + t[f.tail[flat]] + x[f.word[flat]]
    e = np.exp(score - score.max(1, keepdims=True)).reshape(*runs.shape, k) + 1e-12
    move = np.exp(field.move - field.move.max())
    a = np.empty_like(e)
    a[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for i in range(1, runs.shape[1]):
        y = (a[:, i - 1] @ move) * e[:, i]
        a[:, i] = y / y.sum(1, keepdims=True)
    b = np.full((len(runs), k), 1.0)
    post, pair = np.empty_like(e), np.zeros((k, k))
    for i in range(runs.shape[1] - 1, -1, -1):
        y = a[:, i] * b
        post[:, i] = y / y.sum(1, keepdims=True)
        c = b * e[:, i]
        if i:
            z = a[:, i - 1][:, :, None] * move * c[:, None, :]
            pair += (z / z.sum((1, 2), keepdims=True)).sum(0)
        b = c @ move.T
        b /= b.sum(1, keepdims=True)
    y = gold[runs]
    grad = -post.reshape(-1, k)
    grad[np.arange(len(flat)), y.ravel()] += 1
    np.add.at(pair_gold := np.zeros((k, k)), (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    n = len(flat)
    spread = np.repeat(grad, count, axis=0)
    for w, total, at, part in ((g, sums[0], f.grams[grams], spread), (h, sums[1], f.head[flat], grad), (t, sums[2], f.tail[flat], grad), (x, sums[3], f.word[flat], grad)):
        step = np.stack([np.bincount(at, part[:, j], len(w)) for j in range(k)], 1).astype(np.float32) / n * 100
        total += step * step
        w += 0.2 * step / np.sqrt(total) - 1e-4 * w
    step = ((pair_gold - pair) / n * 10).astype(np.float32)
    move_sum += step * step
    field.move += 0.2 * step / np.sqrt(move_sum)


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the labels and weights fitted on all rows (text, language) of the task; none without rows."""
    texts: list[str] = []
    langs: list[str] = []
    for batch in batches:
        texts += batch.column(0).to_pylist()
        langs += batch.column(1).to_pylist()
    if texts:
        field = fit(texts, langs)
        yield pa.RecordBatch.from_arrays(
            [pa.array([field.labels]), pa.array([[x.tobytes() for x in (*field.w, field.move)]], pa.list_(pa.binary()))], names=["labels", "weights"]
        )


def learned(docs: DataFrame, doc_id: Column, text: Column, lang: Column, learn: Column) -> Field | None:
    """Fit on a bounded sample of the rows for which ``learn`` holds, in one task; only the weights reach the driver."""
    rows = docs.select(doc_id.alias("i"), text.alias("t"), lang.alias("l"), learn.alias("go")).where("go and l is not null and t is not null")
    rows = rows.where(F.octet_length("t") <= SAMPLE_BYTES)
    first = W.partitionBy("l").orderBy(F.xxhash64("i"), "i")
    ids = (
        rows.select("i", "l").withColumn("r", F.row_number().over(first))
        .where(F.col("r") <= PER_LANG).select("i").distinct().toPandas()["i"].tolist()
    )
    if not ids:
        return None
    again = W.partitionBy("l").orderBy(F.xxhash64("i"), "i", "t")  # rows of one id may be many
    sample = rows.where(F.col("i").isin(ids)).withColumn("r", F.row_number().over(again)).where(F.col("r") <= PER_LANG)
    sample = sample.repartition(1).sortWithinPartitions("i", "t", "l").select("t", "l")
    found = sample.mapInArrow(_fit_rows, "labels array<string>, weights array<binary>").first()
    if found is None:
        return None
    field = Field(found["labels"])
    field.w, field.move = (
        [np.frombuffer(x, np.float32).reshape(old.shape).copy() for x, old in zip(found["weights"], field.w, strict=False)],
        np.frombuffer(found["weights"][-1], np.float32).reshape(field.move.shape).copy(),
    )
    return field


def _labelled(field: Field | None, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text of a column."""
    pred, score = [UND] * len(column), np.zeros(len(column))
    for row, _, data, at in kernel.chunks(column):
        f = Features(data, at)
        if field is None or not len(f.start):
            continue
        post = field.posteriors(field.scores(f), f.first)
        some = np.flatnonzero(np.diff(f.first))
        mass = np.add.reduceat(post * (f.letters > 0)[:, None], f.first[some], axis=0)
        for d, m in zip(some, mass, strict=True):
            text = data[at[d] : at[d + 1]]
            if not ((text | 32) - 97 < 26).any() and not any(c.isalpha() for c in text.tobytes().decode("utf-8", "replace")):
                continue
            pred[row + d] = field.labels[int(m.argmax())]
            score[row + d] = min(1.0, float(m.max() / m.sum()))
    return pred, score


def _predict(field: Field | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = _labelled(field, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return run


def _accepted(field: Field | None, least: float, column: pa.Array) -> np.ndarray:
    pred, score = _labelled(field, column)
    return (np.array(pred) != UND) & (score >= least)


def with_language(docs: DataFrame, field: Field | None, text_col: str = "text", least: float = 0.3) -> DataFrame:
    """The documents with a language: a letter, and at least this share of words in the likeliest one; no row moves."""
    return kernel.where_arrow(docs, text_col, partial(_accepted, field, least))


def languages(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_predict(field), "doc_id long, lang_pred string, score double")


def word_languages(text: str, field: Field) -> list[tuple[str, str]]:
    """(word, language) of each word of one text."""
    data, at = kernel.bytes_of(pa.array([text], pa.large_string()))
    f = Features(data, at)
    if not len(f.start):
        return []
    best = field.posteriors(field.scores(f), f.first).argmax(1)
    return [(data[s:e].tobytes().decode("utf-8", "replace"), field.labels[b]) for s, e, b in zip(f.start, f.end, best, strict=True)]
