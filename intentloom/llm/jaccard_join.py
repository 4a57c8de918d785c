"""Exact n-gram Jaccard self-join with set-relation skipping.

A document's set holds the hashes of its k-word shingles. Each set lists its rarest part (a
quarter, for a threshold of 75 %) in inverted lists; two sets that link share one of these
tokens. Three relations between sets keep the work down:

* equal sets are one entry of a list, so copies are never paired;
* lists are ordered by set size and cut into blocks; a block outside the size range of its leader,
  and positions from which the overlap can't be reached, are skipped;
* the members of a long list are compared with the leader of their block only. The others'
  answers follow from the leader's: two members of one component need no comparison, and two
  whose distances to the leader differ by more than the largest distance of a link can't link, nor can
  two whose sketches (parities of their tokens, of fixed size) differ in too many places;
* of what is left each set meets its nearest sketch first, then the nearest of each other component,
  then all, so no link is lost, and a large group of near copies is joined by few comparisons.

Tokens that fill many lists come last in the order of a set, so they are hardly ever listed.

Nulls, empty texts: an empty set, linked with nothing. Fewer words than k: one shorter shingle.
Ties and repeated rows: equal sets share the smallest id. Other columns are ignored. A null id can name no
end of a link: such a row stays with its count, in the component of the documents of an equal set, else of none (null).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.llm import kernel
from intentloom.llm.graph import components, merged
from intentloom.llm.runtime import partitions, stored

#: Lists of at most so many sets are compared in pairs, longer ones by leaders.
SHORT = 3
#: The most tokens whose frequency orders them; the others are ordered by hash.
FREQUENT = 100_000
#: Parities in the sketch that goes with a set into a long list; of fixed size, whatever the size of the set.
SKETCH = 1024
_FLUSH = 4_000_000
#: Pairs of a long list that are looked at in one step.
_PAIRS = 1 << 18


def _sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of a column of texts."""
    for row, last, data, at in kernel.chunks(column):
        hashes, first = kernel.word_hashes(data, at)
        for i in range(last - row):
            yield row + i, np.unique(kernel.shingles(hashes[first[i] : first[i + 1]], k))


def _need(a, b, threshold: int):
    """The smallest overlap at which sets of sizes a and b link."""
    return -(-(threshold * (a + b)) // (100 + threshold))


def _set_rows(k: int):
    """Rows (doc_id, n, set key) of documents and (null, count, token) of tokens frequent in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = []
        held = 0

        def frequent():
            token, count = np.unique(np.concatenate(seen), return_counts=True)
            keep = count >= max(3, held // FREQUENT)
            n = int(keep.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int64()), pa.array(count[keep].astype(np.int64)), pa.array(token[keep].view(np.int64)), *(pa.nulls(n, pa.binary()) for _ in range(3))],
                names=["doc_id", "n", "token", "key", "bits", "sketch"],
            )

        for batch in batches:
            sizes, keys, bits, sketches = np.zeros(batch.num_rows, np.int64), [], [], []
            for row, tokens in _sets(batch.column(1), k):
                sizes[row] = len(tokens)
                keys.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None)
                bits.append(_bitmap(tokens))
                sketches.append(_parities(tokens, SKETCH) if len(tokens) else None)
                seen.append(tokens)
                held += len(tokens)
                if held >= _FLUSH:
                    yield frequent()
                    seen, held = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.nulls(batch.num_rows, pa.int64()), pa.array(keys, pa.binary()), pa.array(bits, pa.binary()), pa.array(sketches, pa.binary())],
                names=["doc_id", "n", "token", "key", "bits", "sketch"],
            )
        if seen:
            yield frequent()

    return run


def _prefix_rows(k: int, threshold: int, frequent: np.ndarray):
    """Rows (token, size, pos, set hash, doc_id): each set's part that every linked set meets."""
    by_hash = np.argsort(frequent)
    ordered = frequent[by_hash]

    def rank(tokens: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(ordered, tokens), len(ordered) - 1)
        return np.where(ordered[at] == tokens, len(ordered) - by_hash[at], 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            best: dict[bytes, int] = {}
            parts: dict[bytes, np.ndarray] = {}
            sizes: dict[bytes, int] = {}
            for row, tokens in _sets(batch.column(1), k):
                if not len(tokens):
                    continue
                key = hashlib.blake2b(tokens.tobytes(), digest_size=8).digest()
                if key in best:
                    best[key] = min(best[key], ids[row])
                    continue
                n = len(tokens)
                keep = n - (threshold * n + 99) // 100 + 1
                if len(ordered):
                    tokens = tokens[np.argsort(rank(tokens), kind="stable")]
                best[key], parts[key], sizes[key] = ids[row], tokens[:keep], n
            if not best:
                continue
            lens = np.array([len(x) for x in parts.values()])
            end = np.cumsum(lens)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(list(parts.values())).view(np.int64)),
                    pa.array(np.repeat(np.array(list(sizes.values()), np.int32), lens)),
                    pa.array((np.arange(end[-1]) - np.repeat(end - lens, lens)).astype(np.int32)),
                    pa.array(np.repeat(np.frombuffer(b"".join(best), np.int64), lens)),
                    pa.array(np.repeat(np.array(list(best.values()), np.int64), lens)),
                ],
                names=["token", "size", "pos", "sid", "doc_id"],
            )

    return run


def _whole_groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[dict[str, np.ndarray]]:
    """Columns of sorted rows, cut where the key changes."""
    held: list[dict[str, np.ndarray]] = []

    def joined():
        return {c: np.concatenate([x[c] for x in held]) for c in held[0]}

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = {f.name: batch.column(i).to_numpy(zero_copy_only=False) for i, f in enumerate(batch.schema)}
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            held.append({c: x[:cut] for c, x in cols.items()})
            yield joined()
            held = []
        held.append({c: x[cut:] for c, x in cols.items()})
    if held:
        yield joined()


def _reachable(a: dict, i, j, threshold: int) -> np.ndarray:
    """Whether the sets at rows i and j (size of i at most that of j) can still reach the overlap."""
    si, sj = a["size"][i].astype(np.int64), a["size"][j].astype(np.int64)
    left = 1 + np.minimum(si - a["pos"][i] - 1, sj - a["pos"][j] - 1)
    return (100 * si >= threshold * sj) & (left >= _need(si, sj, threshold))


def _list_rows(threshold: int):
    """Rows (x, y, null...) of pairs to compare and (leader, doc, token, size, pos) of long lists."""
    names = ["x", "y", "token", "size", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a in _whole_groups(batches):
            same = (a["token"][1:] == a["token"][:-1]) & (a["sid"][1:] == a["sid"][:-1]) & (a["size"][1:] == a["size"][:-1])
            first = np.concatenate([[True], ~same])  # copies follow each other, the smallest id first
            a = {c: x[first] for c, x in a.items()}
            token = a["token"]
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            length = np.diff(np.append(start, len(token)))
            n = np.repeat(length, length)
            pairs = []
            for d in range(1, SHORT):
                i = np.flatnonzero((n[:-d] <= SHORT) & (token[:-d] == token[d:])) if len(token) > d else np.zeros(0, int)
                i = i[_reachable(a, i, i + d, threshold)]
                pairs.append((a["doc_id"][i], a["doc_id"][i + d]))
            rest = []
            for s, m in zip(start[length > SHORT], length[length > SHORT], strict=True):
                at, stop = s, s + m
                while at < stop:  # blocks of sizes that can link with the first
                    last = at + int(np.searchsorted(100 * a["size"][s:stop][at - s :].astype(np.int64), 10_000 * int(a["size"][at]) // threshold, "right"))
                    j = np.arange(at + 1, last)
                    j = j[_reachable(a, np.full(len(j), at), j, threshold)]
                    pairs.append((np.full(len(j), a["doc_id"][at]), a["doc_id"][j]))
                    rest.append((np.full(last - at, a["doc_id"][at]), np.arange(at, last)))
                    at = last
            x = np.concatenate([np.minimum(p, q) for p, q in pairs])
            y = np.concatenate([np.maximum(p, q) for p, q in pairs])
            if len(x):
                x, y = np.unique(np.stack([x, y]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), *(pa.nulls(len(x), t) for t in (pa.int64(), pa.int32(), pa.int32()))], names=names)
            if rest:
                leader, j = (np.concatenate(z) for z in zip(*rest, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(leader), pa.array(a["doc_id"][j]), pa.array(token[j]), pa.array(a["size"][j]), pa.array(a["pos"][j])], names=names)

    return run


def _rest_rows(threshold: int, nearest: str | None):
    """Rows (x, y, component of y, apart) of pairs of a long list that their components, distances to a leader and sketches don't settle.

    With ``nearest``, a set meets only the nearest sketch of all other components or of each other one:
    one link joins two components whole, so this leaves few pairs for the pass without it.
    """
    limit = 1 - threshold / 100 + 1e-9

    def open_pairs(a: dict, here: np.ndarray, j: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keep = (a["comp"][j] != a["comp"][here]) & (~few[j] | (j > here))
        here, j = here[keep], j[keep]
        dh, dj = a["dist"][here], a["dist"][j]
        led = (a["leader"][j] == a["leader"][here]) & (dj >= 0) & (dh >= 0) & (np.abs(dj - dh) > limit)
        known = (a["leader"][j] == a["doc_id"][here]) & (dj >= 0) | (a["leader"][here] == a["doc_id"][j]) & (dh >= 0)
        here, j = here[~led & ~known], j[~led & ~known]
        keep = _reachable(a, np.minimum(j, here), np.maximum(j, here), threshold)
        return here[keep], j[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a in _whole_groups(batches):
            known_sketch = np.array([x is not None for x in a["sketch"]], bool)
            sketch = np.frombuffer(b"".join(x or bytes(SKETCH // 8) for x in a["sketch"]), np.uint64).reshape(len(a["token"]), -1)
            size, of = a["size"].astype(np.int64), np.cumsum(np.append(0, a["token"][1:] != a["token"][:-1]))
            few = a["comp"] != _largest(of, a["comp"])[of]
            i = np.flatnonzero(few)  # pairs within the largest component need no comparison
            low = np.searchsorted((of << 40) + 100 * size, (of[i] << 40) + threshold * size[i])
            n = np.searchsorted((of << 40) + threshold * size, (of[i] << 40) + 100 * size[i], "right") - low
            end = np.cumsum(n)
            s = 0
            while s < len(i):
                e = max(s + 1, int(np.searchsorted(end, end[s] - n[s] + _PAIRS, "right")))
                here = np.repeat(i[s:e], n[s:e])
                j = np.arange(len(here)) + np.repeat(low[s:e] - (end[s:e] - n[s:e]) + (end[s] - n[s]), n[s:e])
                here, j = open_pairs(a, here, j, few)
                apart = np.bitwise_count(sketch[j] ^ sketch[here]).sum(axis=1, dtype=np.int64) * (known_sketch[j] & known_sketch[here])
                near = 2 * _need(size[here], size[j], threshold) <= size[here] + size[j] - apart
                here, j, apart = here[near], j[near], apart[near]
                if nearest:
                    comp = a["comp"][j] if nearest == "each" else np.zeros(len(j), np.int64)
                    at = np.lexsort((j, apart, comp, here))
                    at = at[np.append(True, (here[at][1:] != here[at][:-1]) | (comp[at][1:] != comp[at][:-1]))[: len(at)]]
                    here, j, apart = here[at], j[at], apart[at]
                if len(j):
                    found = (a["doc_id"][here], a["doc_id"][j], a["comp"][j], apart)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["x", "y", "comp", "apart"])
                s = e

    return run


def _largest(of: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """The component with most rows of each list, the smallest of equal ones."""
    order = np.lexsort((comp, of))
    of, comp = of[order], comp[order]
    cut = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (comp[1:] != comp[:-1])))
    count = np.diff(np.append(cut, len(of)))
    best = np.lexsort((comp[cut], -count, of[cut]))
    return comp[cut][best[np.append(True, np.diff(of[cut][best]) > 0)]]


def _bitmap(tokens: np.ndarray) -> bytes:
    """Parities of the tokens by hash, in one or two bits a token: half of a bitmap folds onto the other."""
    return _parities(tokens, max(64, 1 << int(len(tokens)).bit_length()))


def _parities(tokens: np.ndarray, n: int) -> bytes:
    places = ((tokens >> np.uint64(20)) & np.uint64(n - 1)).astype(np.intp)
    bits = (np.bincount(places, minlength=n) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").tobytes()


def _differing(a: bytes, b: bytes) -> int:
    """A lower bound of the tokens in one of two sets only: each flips at most one parity."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _tokens_of(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, tokens in _sets(batch.column(1), k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, 1), pa.array([tokens.view(np.int64)], pa.list_(pa.int64()))],
                    names=["doc_id", "tokens"],
                )

    return run


def _possible(threshold: int):
    """The pairs whose bitmaps leave room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nx, ny = (batch.column(i).to_pylist() for i in (2, 3))
            bx, by = (batch.column(i).to_pylist() for i in (4, 5))
            keep = [2 * _need(m, n, threshold) <= m + n - _differing(a, b) for m, n, a, b in zip(nx, ny, bx, by, strict=True)]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def _possible_pairs(rows: DataFrame, pairs: DataFrame, threshold: int) -> DataFrame:
    """The pairs that the small bitmaps of their sets don't rule out; no whole set moves."""
    small = rows.where("key is not null").select("doc_id", "n", "bits")
    ends = pairs.join(small.toDF("y", "ny", "by"), "y").join(small.toDF("x", "nx", "bx"), "x").select("x", "y", "nx", "ny", "bx", "by")
    return stored(ends.mapInArrow(_possible(threshold), "x long, y long").distinct(), "possible")


def _sets_of(docs: DataFrame, pairs: DataFrame, have: DataFrame | None, k: int) -> DataFrame:
    """(doc_id, tokens) of the documents of the pairs: those at hand and the others."""
    ids = pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct()
    ids = stored(ids if have is None else ids.join(have, "doc_id", "left_anti"), "ids")
    more = stored(docs.join(ids, "doc_id", "left_semi").mapInArrow(_tokens_of(k), "doc_id long, tokens array<long>"), "tokens")
    return more if have is None else have.union(more)


def _compared(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(x, y, inter, nx, ny) of the pairs, from whole sets."""
    x = sets.select(F.col("doc_id").alias("x"), F.col("tokens").alias("tx"))
    y = sets.select(F.col("doc_id").alias("y"), F.col("tokens").alias("ty"))
    both = pairs.join(y, "y").join(x, "x")
    return both.select("x", "y", F.size(F.array_intersect("tx", "ty")).alias("inter"), F.size("tx").alias("nx"), F.size("ty").alias("ny"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id): groups of documents linked by a Jaccard similarity of ``threshold`` % or more."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spark = docs.sparkSession
    rows = stored(docs.mapInArrow(_set_rows(k), "doc_id long, n long, token long, key binary, bits binary, sketch binary"), "sets")
    common = (
        rows.where("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").toPandas()["token"]
    )
    frequent = common.to_numpy(np.int64).view(np.uint64)
    lists = (
        docs.where("doc_id is not null").mapInArrow(_prefix_rows(k, threshold, frequent), "token long, size int, pos int, sid long, doc_id long")
        .repartition(partitions(spark), "token").sortWithinPartitions("token", "size", "sid", "doc_id")
        .mapInArrow(_list_rows(threshold), "x long, y long, token long, size int, pos int")
    )
    lists = stored(lists, "lists")
    pairs = lists.where("token is null").select("x", "y").distinct()
    pairs = _possible_pairs(rows, pairs, threshold)
    sets = _sets_of(docs, pairs, None, k)
    first = stored(_compared(sets, pairs), "compared")
    linked = F.expr(f"100L * inter >= {threshold}L * (nx + ny - inter)")
    links = first.where(linked).select("x", "y")
    groups = stored(components(links, "x", "y"), "groups")
    for nearest in ("any", "each", None):
        rest = _rest(lists, rows, first, groups, threshold, nearest, partitions(spark)).join(first, ["x", "y"], "left_anti")
        pairs = _possible_pairs(rows, rest, threshold)
        if pairs.isEmpty():
            continue
        sets = _sets_of(docs, pairs, sets, k)
        more = stored(_compared(sets, pairs), "compared")
        first = first.union(more)
        found = more.where(linked).select("x", "y")
        if not found.isEmpty():
            groups = stored(merged(groups, found, "x", "y"), "groups")
    entries = rows.where("token is null").select("doc_id", "n", "key")
    best = entries.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("id"))
    best = best.join(groups, "id", "left").select("key", F.coalesce("component_id", "id").alias("component_id"))
    return entries.join(best, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _rest(lists: DataFrame, rows: DataFrame, compared: DataFrame, groups: DataFrame, threshold: int, nearest: str | None, n: int) -> DataFrame:
    """Pairs (x, y) still to compare, from the lists whose sets are of several components."""
    long = lists.where("token is not null").select(F.col("x").alias("leader"), F.col("y").alias("doc_id"), "token", "size", "pos")
    long = (
        long.join(groups.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .withColumn("comp", F.coalesce("component_id", "doc_id")).drop("component_id")
    )
    mixed = long.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("token")
    dist = F.expr("1 - inter / (nx + ny - inter)")
    seen = compared.select("x", "y", dist.alias("dist"))
    seen = seen.union(seen.select("y", "x", "dist")).toDF("leader", "doc_id", "dist")
    one = F.min("key") == F.max("key")  # an id of several texts has no sketch: nothing is ruled out by it
    sketches = rows.where("key is not null and doc_id is not null").groupBy("doc_id").agg(F.when(one, F.min("sketch")).alias("sketch"))
    found = (
        long.join(mixed, "token", "left_semi").join(seen, ["leader", "doc_id"], "left")
        .withColumn("dist", F.when(F.col("leader") == F.col("doc_id"), 0.0).otherwise(F.coalesce("dist", F.lit(-1.0))))
        .join(sketches, "doc_id")
        .select("token", "leader", "doc_id", "size", "pos", "dist", "comp", "sketch")
        .repartition(n, "token").sortWithinPartitions("token", "size", "doc_id")
        .mapInArrow(_rest_rows(threshold, nearest), "x long, y long, comp long, apart long")
    )
    if nearest:  # one of all lists
        found = found.groupBy("x", *(["comp"] if nearest == "each" else [])).agg(F.min_by("y", F.struct("apart", "y")).alias("y"))
    return found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
