"""Exact removal of repeated passages by a hash-compared suffix sort.

Every string of ``length`` bytes that starts at two places or more is removed at all of them. Only
suffixes that start at anchors are compared. An anchor is a place whose ``GRAM``-byte hash is the
least of a window, so each string of ``length`` bytes holds one, chosen by its content alone: equal
strings meet at equal anchors, and anchors take about two places in a hundred.

1. Each anchor goes to its hash with the hash of all bytes that strings around it can reach. Where
   these agree too, every string there is repeated, however many copies there are; no text moves.
2. Other anchors whose own bytes occur again, where a repeated passage begins or ends, fetch the
   bytes around them. Their suffixes, and their reversed prefixes, are merge-sorted: prefix
   polynomial hashes and binary search give the common extension of two in logarithmic time, and
   the bytes themselves confirm it. Sorted neighbours' extensions tell which strings are equal.
3. An anchor with more of these than fit a sort is settled instead by one row for each string,
   aggregated before and after the shuffle, so no group has to be in one task.

Null and empty texts lose nothing. Matches never cross texts. Equal rows are copies of each other;
rows are told apart by a hash of doc_id and text, as doc_id may repeat. Texts of any
length are read whole. Other columns are unused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intentloom.llm import kernel
from intentloom.llm.runtime import partitions, stored

LENGTH = 200
GRAM = 100
#: Anchors of one hash that a sort takes; more are settled by aggregation.
SORTED = 4096
_LIMIT = 1 << 19


def _slide(x: np.ndarray, w: int, best) -> np.ndarray:
    """best of each window of w values."""
    size = 1
    while 2 * size <= w:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[: len(x) - (w - size)], x[w - size :]) if size < w else x


def _anchors(data: np.ndarray, at: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in it, hash, hash of all around) of every anchor of texts of at least ``length`` bytes."""
    w = length - gram + 1
    prefix = kernel.prefix_hashes(data)
    low = np.arange(max(0, len(data) - gram + 1))
    hashes = kernel.mix(kernel.span_hashes(prefix, low, low + gram))
    docs, places = [], []
    for d in np.flatnonzero(np.diff(at) >= length):
        h = hashes[at[d] : at[d + 1] - gram + 1]
        least = _slide(h, w, np.minimum)
        padded = np.concatenate([np.zeros(w - 1, np.uint64), least, np.zeros(w - 1, np.uint64)])
        chosen = np.flatnonzero(_slide(padded, w, np.maximum) == h)
        places.append(chosen)
        docs.append(np.full(len(chosen), d))
    if not docs:
        return (np.zeros(0, int),) * 2 + (np.zeros(0, np.uint64),) * 2
    doc, place = np.concatenate(docs), np.concatenate(places)
    here = at[doc] + place
    begin = np.maximum(here - (w - 1), at[doc])
    end = np.minimum(here + length, at[doc + 1])
    wide = kernel.span_hashes(prefix, begin, end)
    edge = (here - begin).astype(np.uint64) * np.uint64(1 << 20) + (end - here).astype(np.uint64)
    return doc, place, hashes[here], kernel.mix(wide + kernel.mix(edge))


def _anchor_rows(length: int, gram: int):
    """Anchors of a batch, those that agree all around once, with their number (2 stands for more).

    The places of the latter are known to be repeated: they go on as merged ranges with number 0,
    dealt out by text, so a passage that fills a batch makes few rows.
    """
    w = length - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            found = [(row + d, p, h, x) for row, _, data, at in kernel.chunks(batch.column(1), _LIMIT) for d, p, h, x in [_anchors(data, at, length, gram)] if len(d)]
            if not found:
                continue
            doc, place, h, wide = (np.concatenate(z) for z in zip(*found, strict=True))
            order = np.lexsort((wide, h))
            new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (wide[order][1:] != wide[order][:-1])])
            first = order[new]
            count = np.diff(np.append(np.flatnonzero(new), len(order)))
            again = np.zeros(len(order), bool)
            again[order] = np.repeat(count > 1, count)
            d, p = doc[again], place[again]  # in the order of texts and places
            begin = np.maximum(p - (w - 1), 0)
            open_ = np.concatenate([[True], (d[1:] != d[:-1]) | (begin[1:] > p[:-1] + length)]) if len(d) else np.zeros(0, bool)
            close = np.concatenate([open_[1:], [True]]) if len(d) else open_
            route = kernel.mix(ids[d[open_]].astype(np.int64).view(np.uint64))
            yield _anchor_batch(h[first], h[first], wide[first], ids[doc[first]], place[first], place[first] + length, np.minimum(count, 2))
            yield _anchor_batch(route, route, route, ids[d[open_]], begin[open_], p[close] + length, np.zeros(len(route), int))

    return run


_ANCHOR = "route long, anchor long, around long, id long, place int, end int, n int"


def _anchor_batch(route, anchor, around, ids, place, end, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x.view(np.int64)) for x in (route, anchor, around)), pa.array(ids.astype(np.int64)), *(pa.array(x.astype(np.int32)) for x in (place, end, n))],
        names=["route", "anchor", "around", "id", "place", "end", "n"],
    )


#: What is known of an anchor: every string repeated, to be sorted, to be aggregated; and merged ranges.
WHOLE, SORT, SPLIT, RANGE = 0, 1, 2, 3


def _class_rows(most: int):
    """Rows (kind, anchor, id, place, end) from rows sorted by (anchor, around); looks at neighbours only.

    Of the anchors that agree all around, the first and the last also go on, to meet those that agree in part.
    """
    names = ("anchor", "id", "place", "end")

    def out(kind, a, pick):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pick), kind, np.int32)), *(pa.array(a[c][pick]) for c in names)], names=["kind", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (anchor, around) of the row before
        rest = None  # the last row, whose successor isn't known
        group: list[dict] = []  # rows that go on of the anchor at hand, up to ``most``
        count, split = 0, False

        def close():
            nonlocal group, count, split
            if group:
                rows = {c: np.concatenate([x[c] for x in group]) for c in names}
                yield out(SORT, rows, np.arange(count))
            group, count, split = [], 0, False

        def extend(a, pick):
            nonlocal group, count, split
            if not split and count + len(pick) > most:
                for rows in group:
                    yield out(SPLIT, rows, np.arange(len(rows["id"])))
                group, split = [], True
            count += len(pick)
            if split:
                yield out(SPLIT, a, pick)
            else:
                group.append({c: a[c][pick] for c in names})

        def judged(a, n):
            """The first n rows, of which both neighbours are known."""
            nonlocal before
            anchor, around = a["anchor"], a["around"]
            prev_a = np.concatenate([[before[0] if before else ~anchor[0]], anchor[:-1]])
            prev_w = np.concatenate([[before[1] if before else 0], around[:-1]])
            up, down = prev_a == anchor, np.append(anchor[1:], ~anchor[-1]) == anchor
            same_up, same_down = up & (prev_w == around), down & (np.append(around[1:], 0) == around)
            yield out(WHOLE, a, np.flatnonzero((same_up | same_down | (a["n"] > 1))[:n]))
            pick = np.flatnonzero((up & ~same_up | down & ~same_down)[:n])
            if before is not None and n and anchor[0] != before[0]:
                yield from close()
            before = (anchor[n - 1], around[n - 1]) if n else before
            if not len(pick):
                return
            cut = np.flatnonzero(np.concatenate([[True], anchor[pick][1:] != anchor[pick][:-1], [True]]))
            first, last = pick[: cut[1]], pick[cut[-2] :]
            if group and group[0]["anchor"][0] != anchor[pick[0]] or split and prev_a[pick[0]] != anchor[pick[0]]:
                yield from close()
            yield from extend(a, first)
            if len(cut) > 2:
                yield from close()
                size = np.repeat(np.diff(cut), np.diff(cut))[cut[1] : cut[-2]]
                middle = pick[cut[1] : cut[-2]]
                yield out(SORT, a, middle[size <= most])
                yield out(SPLIT, a, middle[size > most])
                yield from extend(a, last)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {c: batch.column(i).to_numpy() for i, c in enumerate(batch.schema.names)}
            ranges = cols["n"] == 0
            if ranges.any():
                yield out(RANGE, cols, np.flatnonzero(ranges))
                cols = {c: x[~ranges] for c, x in cols.items()}
                if ranges.all():
                    continue
            if rest is not None:
                cols = {c: np.concatenate([rest[c], cols[c]]) for c in cols}
            yield from judged(cols, len(cols["id"]) - 1)
            rest = {c: x[-1:] for c, x in cols.items()}
        if rest is not None:
            yield from judged(rest, 1)
        yield from close()

    return run


def _around_rows(length: int, gram: int):
    """Bytes around the anchors to be sorted, and hashes of all strings around those to be split.

    A string that a batch holds twice goes on once, with number 2, and its places as ranges.
    """
    w = length - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            keys, seconds, owners, places, context = [], [], [], [], []
            strings = []
            for row, last, data, at in kernel.chunks(batch.column(1), _LIMIT):
                prefixes = None
                for r in range(row, last):
                    begin, end = int(at[r - row]), int(at[r - row + 1])
                    text = data[begin:end].tobytes()
                    starts = []
                    for x in lists[r].as_py():
                        p = x["place"]
                        if x["kind"] == SORT:
                            keys.append(x["anchor"])
                            seconds.append(p - max(0, p - w + 1))
                            owners.append(ids[r])
                            places.append(p)
                            context.append(text[max(0, p - w + 1) : p + length])
                            continue
                        starts.append(np.arange(max(0, p - w + 1), min(p, end - begin - length) + 1))
                    if starts:  # neighbouring anchors share strings
                        s = np.unique(np.concatenate(starts))
                        prefixes = prefixes or [kernel.prefix_hashes(data, i) for i in (0, 1)]
                        one, two = (kernel.mix(kernel.span_hashes(prefixes[i], begin + s, begin + s + length, i)) for i in (0, 1))
                        strings.append((one, two, np.full(len(s), ids[r]), s))
            n = len(keys)
            yield _around_batch(keys, seconds, owners, places, [x + length for x in places], [1] * n, context)
            if strings:
                one, two, owner, s = (np.concatenate(z) for z in zip(*strings, strict=True))
                order = np.lexsort((two, one))
                new = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
                first, count = order[new], np.diff(np.append(np.flatnonzero(new), len(order)))
                again = np.zeros(len(order), bool)
                again[order] = np.repeat(count > 1, count)
                d, q = owner[again], s[again]
                start = np.concatenate([[True], (d[1:] != d[:-1]) | (q[1:] != q[:-1] + 1)]) if len(d) else np.zeros(0, bool)
                stop = np.concatenate([start[1:], [True]]) if len(d) else start
                yield _around_batch(one[first].view(np.int64), two[first].view(np.int64), owner[first], s[first], s[first] + length, np.minimum(count, 2), None)
                yield _around_batch(d[start], d[start], d[start], q[start], q[stop] + length, np.zeros(int(start.sum()), int), None)

    return run


_AROUND = "anchor long, second long, id long, place int, end int, n int, context binary"


def _around_batch(keys, seconds, owners, places, ends, n, context) -> pa.RecordBatch:
    columns = [*(pa.array(x, pa.int64()) for x in (keys, seconds, owners)), *(pa.array(x, pa.int64()).cast(pa.int32()) for x in (places, ends, n))]
    columns.append(pa.array(context, pa.binary()) if context is not None else pa.nulls(len(keys), pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["anchor", "second", "id", "place", "end", "n", "context"])


def extensions(prefix: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Common extension of the suffixes at a and b, by binary search over prefix hashes."""
    low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_] + 1) // 2
        x, y = a[open_], b[open_]
        same = kernel.span_hashes(prefix, x, x + mid) == kernel.span_hashes(prefix, y, y + mid)
        low[open_[same]] = mid[same]
        high[open_[~same]] = mid[~same] - 1


def sort_suffixes(data: np.ndarray, prefix: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, extension with the one before) of suffixes, sorted inside each group by mergesort.

    Groups are merged side by side: in every pass, each suffix finds its place in the neighbouring
    run by binary search, each comparison being one binary search over hashes.
    """

    def less(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before suffix y; shorter first."""
        most = np.minimum(size[x], size[y])
        e = extensions(prefix, start[x], start[y], most)
        inside = e < most
        px, py = np.where(inside, start[x] + e, 0), np.where(inside, start[y] + e, 0)
        return np.where(inside, data[px] < data[py], size[x] < size[y])

    order = np.argsort(group, kind="stable")
    edge = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0, [True]])) if len(order) else np.zeros(1, int)
    begin = np.repeat(edge[:-1], np.diff(edge))
    end = np.repeat(edge[1:], np.diff(edge))
    run, longest = 1, int(np.diff(edge).max()) if len(edge) > 1 else 0
    while run < longest:
        where = np.arange(len(order))
        own = begin + (where - begin) // run * run
        left = (own - begin) // run % 2 == 0
        other = np.where(left, own + run, own - run)
        low = np.minimum(np.maximum(other, begin), end)
        high = np.minimum(low + run, end)
        high = np.where(left & (own + run >= end), low, high)
        first = low.copy()
        while True:
            o = np.flatnonzero(low < high)
            if not len(o):
                break
            mid = (low[o] + high[o]) // 2
            x, y = order[o], order[mid]
            behind = np.where(left[o], less(y, x), ~less(x, y))  # equal ones of the left run come first
            low[o[behind]] = mid[behind] + 1
            high[o[~behind]] = mid[~behind]
        new = np.empty_like(order)
        new[np.minimum(own, np.where(left, own, other)) + (where - own) + (low - first)] = order
        order = new
        run *= 2
    shared = np.zeros(len(order), np.int64)
    if len(order) > 1:
        x, y = order[:-1], order[1:]
        most = np.where(group[x] == group[y], np.minimum(size[x], size[y]), 0)
        shared[1:] = extensions(prefix, start[x], start[y], most)
    return order, shared


def _verified(data: np.ndarray, start: np.ndarray, order: np.ndarray, shared: np.ndarray) -> bool:
    """Whether the bytes confirm what the hashes say of neighbours: equal up to the extension."""
    x, y, n = start[order[:-1]], start[order[1:]], shared[1:]
    total = int(n.sum())
    step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    return bool((data[np.repeat(x, n) + step] == data[np.repeat(y, n) + step]).all())


def _depths(context: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, extension) of byte strings, sorted inside groups; by the bytes alone if a hash lied."""
    size = np.array([len(c) for c in context], np.int64)
    data = np.frombuffer(b"".join(context), np.uint8) if size.sum() else np.zeros(0, np.uint8)
    start = np.cumsum(size) - size
    order, shared = sort_suffixes(data, kernel.prefix_hashes(data), start, size, group)
    if _verified(data, start, order, shared):
        return order, shared
    order = np.array(sorted(range(len(context)), key=lambda i: (group[i], context[i])), int)
    shared = np.zeros(len(order), np.int64)
    for i in range(1, len(order)):
        a, b = context[order[i - 1]], context[order[i]]
        if group[order[i - 1]] == group[order[i]]:
            n = min(len(a), len(b))
            diff = np.flatnonzero(np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8))
            shared[i] = diff[0] if len(diff) else n
    return order, shared


def repeated_around(group: np.ndarray, left: np.ndarray, context: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bytes before the anchor) of the strings that rows of one group share."""
    w = length - gram + 1
    right = [c[n:] for c, n in zip(context, left, strict=True)]
    back = [c[:n][::-1] for c, n in zip(context, left, strict=True)]
    r_order, r_shared = _depths(right, group)
    l_order, l_shared = _depths(back, group)
    r_size = np.array([len(x) for x in right])
    rows, offsets = [], []
    r_class, l_class = np.empty(len(group), np.int64), np.empty(len(group), np.int64)
    for a in range(w):  # strings that begin a bytes before the anchor
        ok = np.flatnonzero((left >= a) & (r_size >= length - a))
        if len(ok) < 2:
            continue
        r_class[r_order] = np.cumsum(np.concatenate([[True], (r_shared[1:] < length - a) | (np.diff(group[r_order]) != 0)]))
        l_class[l_order] = np.cumsum(np.concatenate([[True], (l_shared[1:] < a) | (np.diff(group[l_order]) != 0)]))
        key = r_class[ok] * (len(group) + 1) + l_class[ok]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        dup = ok[by[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        rows.append(dup)
        offsets.append(np.full(len(dup), a))
    return (np.concatenate(rows), np.concatenate(offsets)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _sorted_rows(length: int, gram: int):
    """(id, begin, end) of strings shared by anchors of one hash; rows come sorted by anchor."""

    def settle(anchor, second, ids, place, context):
        row, a = repeated_around(anchor, second, context, length, gram)
        begin = place[row].astype(np.int64) - a
        return pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(begin), pa.array(begin + length)], names=["id", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            anchor = held.column(0).to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1])) if len(anchor) else 0
            if cut >= 5000:
                yield from _settle(held.slice(0, cut), settle)
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from _settle(held, settle)

    return run


def _settle(batch: pa.RecordBatch, settle) -> Iterator[pa.RecordBatch]:
    anchor, second, ids, place = (batch.column(i).to_numpy() for i in range(4))
    yield settle(anchor, second, ids, place, batch.column(4).to_pylist())


def _merge(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    return begin[new], end[np.concatenate([new[1:], [True]])]


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the merged ranges out of the texts."""
    for batch in batches:
        n, gone, spans, hashes, texts = [], [], [], [], []
        for row, last, data, at in kernel.chunks(batch.column(1)):
            for r in range(row, last):
                text = data[at[r - row] : at[r - row + 1]].tobytes()
                ranges = batch.column(2)[r].values
                removed = count = 0
                if ranges is not None and len(ranges):
                    begin, end = _merge(*(ranges.field(i).to_numpy() for i in (0, 1)))
                    removed, count = int((end - begin).sum()), len(begin)
                    edge = [0, *np.stack([begin, end], 1).ravel().tolist(), len(text)]
                    kept = b"".join(text[edge[i] : edge[i + 1]] for i in range(0, len(edge), 2))
                else:
                    kept = text
                n.append(len(text))
                gone.append(removed)
                spans.append(count)
                hashes.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(hashes, pa.string()), pa.array(texts, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, most: int = SORTED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): ``kept`` holds the bytes that are left."""
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("id"))
    spark = docs.sparkSession
    texts = rows.select("id", "text")
    n = partitions(spark)
    known = (
        texts.mapInArrow(_anchor_rows(length, gram), _ANCHOR).repartition(n, "route").sortWithinPartitions("route", "around")
        .mapInArrow(_class_rows(most), "kind int, anchor long, id long, place int, end int")
    )
    known = stored(known, "anchors")
    open_ = known.where(F.col("kind").isin(SORT, SPLIT)).groupBy("id").agg(F.collect_set(F.struct("kind", "anchor", "place")).alias("open"))
    around = texts.join(open_, "id").select("id", "text", "open").mapInArrow(_around_rows(length, gram), _AROUND)
    around = stored(around, "around")
    by_sort = (
        around.where("context is not null").select("anchor", "second", "id", "place", "context").repartition(n, "anchor").sortWithinPartitions("anchor")
        .mapInArrow(_sorted_rows(length, gram), "id long, begin long, end long")
    )
    strings = around.where("context is null and n > 0").select("anchor", "second", "id", "place", "end", "n")
    repeated = strings.groupBy("anchor", "second").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "second")
    by_count = strings.join(repeated, ["anchor", "second"], "left_semi").select("id", F.col("place").alias("begin"), "end")
    begin = F.when(F.col("kind") == RANGE, F.col("place")).otherwise(F.greatest(F.lit(0), F.col("place") - (length - gram)))
    whole = known.where(F.col("kind").isin(WHOLE, RANGE)).select("id", begin.alias("begin"), "end")
    ranges = whole.union(around.where("n = 0").select("id", F.col("place").alias("begin"), "end")).union(by_count)
    ranges = ranges.select("id", F.col("begin").cast("long"), F.col("end").cast("long")).union(by_sort)
    ranges = ranges.groupBy("id").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    size = F.octet_length("text").cast("long")
    cut = rows.join(ranges, "id", "left").select(
        "doc_id", "text", F.transform("ranges", lambda r: F.struct(r["begin"].alias("begin"), F.least(r["end"], size).alias("end"))).alias("ranges")
    )
    return cut.mapInArrow(_cut_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
