"""Benchmark decontamination by greedy string tiling.

Word n-grams that a document shares with a benchmark item are seeds. Seeds on one diagonal, checked
word by word, make maximal matches. The longest match whose words are still free is marked as a
tile, what tiles leave of other matches goes back into the heap at its own length, and so on down to
the shortest match. No rolling hash is run again at each length, as Karp-Rabin tiling does: every match
of a length is a part of one maximal match on its diagonal, so the heap holds all it would find. A document whose tiles cover enough of an item's
words holds that item, also where passages come in another order.

Benchmarks are taken in blocks of a bounded size, one pass over the documents for each, so what a
task holds doesn't grow with the benchmark. Null and empty texts hold nothing; items with fewer
words than a seed are never matched (chance would do). Repeated rows are judged alike; items with
equal text are all reported. Words are compared with A-Z lower-cased.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.llm import kernel

SEED_WORDS = 5
COVERAGE = 0.5
BLOCK_BYTES = 4 << 20


class _Block:
    """Seeds of some items: sorted n-gram hashes with (item, position)."""

    def __init__(self, ids: list[int], texts: list[str], n: int):
        self.ids, self.n = ids, n
        column = pa.array(texts, pa.large_string())
        data, at = kernel.bytes_of(column)
        hashes, first = kernel.word_hashes(data, at)
        low = kernel.lower(data).tobytes()
        start, end, _ = kernel.words(data, at)
        self.words = [hashes[first[i] : first[i + 1]] for i in range(len(ids))]
        self.spelt = [[low[s:e] for s, e in zip(start[first[i] : first[i + 1]], end[first[i] : first[i + 1]], strict=True)] for i in range(len(ids))]
        seeds = [(kernel.shingles(w, n), i) for i, w in enumerate(self.words) if len(w) >= n]
        grams = np.concatenate([g for g, _ in seeds]) if seeds else np.zeros(0, np.uint64)
        item = np.concatenate([np.full(len(g), i) for g, i in seeds]) if seeds else np.zeros(0, int)
        pos = np.concatenate([np.arange(len(g)) for g, _ in seeds]) if seeds else np.zeros(0, int)
        order = np.argsort(grams, kind="stable")
        self.grams, self.item, self.pos = grams[order], item[order], pos[order]

    def seeds(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in the text, item, position in the item) of all shared n-grams."""
        low = np.searchsorted(self.grams, grams)
        hit = np.flatnonzero(self.grams[np.minimum(low, len(self.grams) - 1)] == grams)
        low, high = low[hit], np.searchsorted(self.grams, grams[hit], "right")
        count = high - low
        at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(hit, count), self.item[at], self.pos[at]


def tiles(text_at: np.ndarray, item_at: np.ndarray, n: int, equal, item_words: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from seed pairs: (position in the text, position in the item, words)."""
    order = np.lexsort((item_at, text_at - item_at))
    t, i = text_at[order], item_at[order]
    fresh = np.flatnonzero(np.concatenate([[True], (np.diff(t - i) != 0) | (np.diff(i) != 1)]))
    heap: list[tuple[int, int, int]] = []
    for a, b in zip(fresh, np.append(fresh[1:], len(t)), strict=True):
        run = [equal(int(t[a]) + k, int(i[a]) + k) for k in range(int(b - a) + n - 1)]  # a hash may lie
        _push(heap, int(t[a]), int(i[a]), run, n)
    free_item, free_text, out = np.ones(item_words, bool), set(), []
    while heap:
        length, s, j = heapq.heappop(heap)
        run = [bool(free_item[j + k]) and s + k not in free_text for k in range(-length)]
        if all(run):
            out.append((s, j, -length))
            free_item[j : j - length] = False
            free_text.update(range(s, s - length))
        else:
            _push(heap, s, j, run, n)
    return out


def _push(heap: list, s: int, j: int, run: list[bool], n: int) -> None:
    at = 0
    while at < len(run):
        end = at
        while end < len(run) and run[end]:
            end += 1
        if end - at >= n:
            heapq.heappush(heap, (-(end - at), s + at, j + at))
        at = max(end, at) + 1


def _found(block: _Block, coverage: float, column: pa.Array) -> tuple[list, list, list, list]:
    """(rows, item ids, coverages, tiles) of the texts of a column that hold items."""
    n = block.n
    rows, items, shares, sizes = [], [], [], []
    for row, _, data, at in kernel.chunks(column):
        hashes, first = kernel.word_hashes(data, at)
        if len(hashes) < n or not len(block.grams):
            continue
        place, item, pos = block.seeds(kernel.shingles(hashes, n))
        doc = np.searchsorted(first, place, "right") - 1
        keep = place + n <= first[doc + 1]
        place, item, pos, doc = place[keep], item[keep], pos[keep], doc[keep]
        if not len(place):
            continue
        start, end, _ = kernel.words(data, at)
        low = kernel.lower(data)
        order = np.lexsort((item, doc))
        place, item, pos, doc = place[order], item[order], pos[order], doc[order]
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0), [True]]))
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            spelt = block.spelt[item[a]]
            if n * (b - a) < coverage * len(spelt):
                continue  # even tiles that don't touch could not cover enough
            found = tiles(place[a:b], pos[a:b], n, lambda t, i, s=spelt: low[start[t] : end[t]].tobytes() == s[i], len(spelt))
            words = sum(x[2] for x in found)
            if words and words >= coverage * len(spelt):
                rows.append(row + int(doc[a]))
                items.append(block.ids[item[a]])
                shares.append(words / len(spelt))
                sizes.append(len(found))
    return rows, items, shares, sizes


def _matches(block: _Block, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, items, shares, sizes = _found(block, coverage, batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()), pa.array(shares, pa.float64()), pa.array(sizes, pa.int64())],
                names=["doc_id", "item_id", "coverage", "n_tiles"],
            )

    return run


def _clean(block: _Block, coverage: float, column: pa.Array) -> np.ndarray:
    keep = np.ones(len(column), bool)
    keep[_found(block, coverage, column)[0]] = False
    return keep


def _blocks(benchmark: DataFrame, item_col: str, item_text: str, n: int) -> Iterator[_Block]:
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text")).where("text is not null and item_id is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == i).orderBy("item_id").toPandas()
        yield _Block(part["item_id"].tolist(), part["text"].tolist(), n)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", n: int = SEED_WORDS, coverage: float = COVERAGE,
) -> DataFrame:
    """The documents that hold no benchmark item; no row moves."""
    for block in _blocks(benchmark, item_col, item_text, n):
        docs = kernel.where_arrow(docs, text_col, partial(_clean, block, coverage))
    return docs


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", n: int = SEED_WORDS, coverage: float = COVERAGE,
) -> DataFrame:
    """(doc_id, item_id, coverage, n_tiles) of each document and benchmark item that it holds."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    result = None
    for block in _blocks(benchmark, item_col, item_text, n):
        part = docs.mapInArrow(_matches(block, coverage), "doc_id long, item_id long, coverage double, n_tiles long")
        result = part if result is None else result.union(part)
    return result.distinct()
