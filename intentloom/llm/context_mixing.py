"""Bits per byte by online logistic context mixing.

Three predictors of the next bit each look up a hashed context (the last two bytes, the last
four, the word so far) together with the bits already known of the byte. Gated weights, one set
for each bit position and kind of the last byte, mix their log-odds; a last stage maps the mixed
log-odds, by what is known of the byte, to what happened in training, and is averaged in. While a text
is read the weights go on learning, run of bytes by run of bytes, from the weights of training.

The predictors' counts come from every training text and are kept by full context, told apart by a hash
of 56 bits, so what is gathered grows with the input: texts are dealt into blocks of about ``BLOCK`` bytes, each
block sends its contexts with its own counts, these are summed by context and sent back to every block that has
the context, and a block is scored with the counts of its contexts only. No table of all contexts lies in one place.
What is sent is packed, a row for each block and range of contexts: codes as differences, compressed, and never more
rows than contexts. A context that was seen once in all is not sent back to the training text that has it, and those
that half of the blocks have are sent once to each executor, not with each block; there are at most twice as many of
them as contexts in a block. Texts are packed too, and blocks of texts and counts are dealt once, for fitting and scoring.
Mixing weights and the last stage are fitted on all training texts: a block's texts are read one after the other with
weights that begin anew in each block, the weights that blocks end with are averaged by bytes, and what each block
adds to the last stage is summed. A second pass scores every text.

Contexts with the same counts share one row of log-odds, so a block's table has far fewer rows than contexts.

A token score needs the words' counts: words too rare to be among the ``FREQUENT`` most frequent
are joined, one row for each task and word.

Null and empty texts: only the end, which is coded as a zero byte. Without training texts every bit
has probability 1/2. Repeated rows get equal scores; texts are read whole. Other columns are unused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from intentloom.llm import kernel
from intentloom.llm.runtime import partitions, stored

#: Predictors, and bytes of text in a block.
ORDERS, BLOCK = 3, 1 << 24
FREQUENT = 100_000
_SLICE = 1 << 12
#: Bytes of packed texts in a row, of texts whose contexts are looked up at once, and of texts whose contexts are summed at once.
_ROW, _CHUNK, _PART = 1 << 20, 1 << 16, 1 << 23
#: Places of the last stage: nodes by mixed log-odds.
LAST = 256 * 33
#: Where the predictors' log-odds begin in a table without context hashes; 256 places a context.
_STARTS = np.arange(ORDERS + 1) << 16
_RUN = 2048
_RATE = 0.02 / 256
_LN10, _LOG2 = float(np.log(10)), float(np.log10(2))

_BYTES = np.arange(256)
_NODE = np.stack([(1 << j) | (_BYTES >> (8 - j)) for j in range(8)], 1).astype(np.int64)
_BIT = np.stack([(_BYTES >> (7 - j)) & 1 for j in range(8)], 1).astype(np.float32)
_SIGN = (2 * _BIT - 1).astype(np.float32)
#: Twice the last stage's place of each bit, and the bit.
_PLACE = _NODE * 66 + _BIT.astype(np.int64)
_KIND = np.zeros(256, np.intp)
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[33:65] = 2
_KIND[128:] = 3
_PACKED = "block long, texts boolean, part int, data binary"
_OPENED = "block long, key long, seen binary, n binary, id long, doc_id long, learn boolean, text string"


def _ended(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts one after the other, each with a zero byte as its end."""
    return np.insert(data, at[1:], 0), at + np.arange(len(at))


def _contexts(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Context hashes of 56 bits, by predictor, for each byte of texts that end with a zero byte."""
    n = len(text)
    wide = np.zeros(n + 4, np.uint64)
    wide[4:] = text
    last = [wide[4 - k : n + 4 - k] for k in range(1, 5)]
    two = last[0] | last[1] << np.uint64(8)
    four = two | last[2] << np.uint64(16) | last[3] << np.uint64(24)
    for k in range(4):  # nothing lies before a text
        first = at[:-1] + k
        first = first[first < n]
        two[first] &= np.uint64((1 << 8 * k) - 1)
        four[first] &= np.uint64((1 << 8 * k) - 1)
    here = np.arange(n)
    cut = _KIND[text] == 1
    cut[at[1:] - 1] = True
    begin = np.zeros(n, np.int64)
    begin[1:] = np.maximum.accumulate(np.where(cut, here + 1, 0))[:-1]
    word = kernel.span_hashes(kernel.prefix_hashes(kernel.lower(text)), begin, here) + (here - begin).astype(np.uint64)
    return kernel.mix(np.stack([two + np.uint64(1 << 40), four + np.uint64(2 << 40), kernel.mix(word)])) >> np.uint64(8)


def contexts(text: np.ndarray) -> np.ndarray:
    """Context hashes of 56 bits, by predictor, for each byte of a text that ends with a zero byte."""
    return _contexts(text, np.array([0, len(text)]))


def _boxed(held: list[pa.RecordBatch]) -> Iterator[bytes]:
    """Packed rows of texts in the order of their ids, about ``_ROW`` bytes in each."""
    table = pa.Table.from_batches(held).combine_chunks()
    table = table.take(pa.array(np.argsort(table.column("id").to_numpy(), kind="stable")))
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    for batch in table.combine_chunks().to_batches():
        for row, last, _, _ in kernel.chunks(batch.column("text"), _ROW):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, batch.schema, options=options) as stream:
                stream.write_batch(batch.slice(row, last - row))
            yield out.getvalue().to_pybytes()


def _rows(blocks: list[int], texts: bool, parts: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array([texts] * len(blocks), pa.bool_()), pa.array(parts, pa.int32()), pa.array(data, pa.binary())],
        names=["block", "texts", "part", "data"],
    )


def _each(batch: pa.RecordBatch) -> Iterator[dict]:
    """Packed rows, one in Python's memory at a time."""
    for r in range(batch.num_rows):
        yield batch.slice(r, 1).to_pylist()[0]


def _dealt(most: int):
    """Rows (id, doc_id, learn, text) packed by the block that they fall into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, now = TaskContext.get().partitionId() << 32, 0, None
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            _, at = kernel.bytes_of(batch.column(3))
            step = size + at[1:]
            own = block + step // most
            cut = np.flatnonzero(own[1:] != own[:-1]) + 1
            for s, e in zip([0, *cut], [*cut, len(own)], strict=True):
                if held and own[s] != now:
                    for k, data in enumerate(_boxed(held)):
                        yield _rows([now], True, [k], [data])
                    held = []
                now = int(own[s])
                held.append(batch.slice(int(s), int(e - s)))
            size = int(step[-1])
        if held:
            for k, data in enumerate(_boxed(held)):
                yield _rows([now], True, [k], [data])

    return run


def _squeezed(code: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted codes and their numbers, compressed as differences, the highest bytes of all of them first."""
    gap = np.diff(code, prepend=np.uint64(0))
    planes = [x.astype(">u8").view(np.uint8).reshape(-1, 8).T.ravel() for x in (gap, n)]
    return len(code).to_bytes(8, "little") + pa.compress(np.concatenate(planes), "zstd", asbytes=True)


def _loosened(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 16 * size, "zstd"), np.uint8).reshape(2, 8, size)
    gap, n = (np.ascontiguousarray(x.T).view(">u8").ravel().astype(np.uint64) for x in planes)
    return np.cumsum(gap, dtype=np.uint64), n


def _summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sum of each."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, int)
    return code[cut], np.add.reduceat(n[order], cut) if len(cut) else np.zeros(0)


def _packed(key: np.ndarray, code: np.ndarray, n: np.ndarray) -> list[pa.Array]:
    """(key, bytes seen, their counts) for sorted keys from sorted codes of context and byte."""
    ends = np.searchsorted(code >> np.uint64(8), key, "right").astype(np.int32)
    at = np.concatenate([np.searchsorted(code >> np.uint64(8), key[:1]), ends]).astype(np.int32)
    seen, count = (code & np.uint64(255)).astype(np.uint8), n.astype(np.float32)
    return [
        pa.array(key.astype(np.int64)),
        pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(at), pa.py_buffer(seen)]),
        pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(at * np.int32(4)), pa.py_buffer(count)]),
    ]


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each row, and codes of context and byte with their counts."""

    def data(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
        _, offsets, values = column.buffers()
        wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1]
        values = np.frombuffer(values, np.uint8)[at[0] : at[-1]] if values is not None else np.zeros(0, np.uint8)
        return np.frombuffer(values.tobytes(), kind), np.diff(at)

    key = batch.column("key").to_numpy(zero_copy_only=False).astype(np.uint64)
    seen, size = data(batch.column("seen"), np.uint8)
    n, _ = data(batch.column("n"), np.float32)
    return key, np.repeat(key, size) << np.uint64(8) | seen, n.astype(np.float64)


def _block_rows(parts: int):
    """Packed (code of context and byte, number) of a block's texts, a row for each range of contexts: twice the count in its training texts.

    A context that a text which is not learnt from has is marked by one more, for byte zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        raw: list[np.ndarray] = []
        wanted: list[np.ndarray] = []
        codes: list[tuple[np.ndarray, np.ndarray]] = []

        def settle():
            if raw:
                code = np.sort(np.concatenate(raw))
                cut = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1], [True]]))
                codes.append((code[cut[:-1]], np.diff(cut) * 2))
            raw.clear()

        def done():
            settle()
            if wanted:
                key = np.unique(np.concatenate(wanted))
                codes.append((key << np.uint64(8), np.ones(len(key), np.int64)))
            code, n = _summed(*(np.concatenate(x) for x in zip(*codes, strict=True)))
            codes.clear()
            wanted.clear()
            part = (code >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            data = [_squeezed(code[s:e], n[s:e]) for s, e in zip(cut[:-1], cut[1:], strict=True)]
            return _rows([now] * len(data), False, part[cut[:-1]].astype(int).tolist(), data)

        for batch in batches:
            for row in _each(batch):
                if row["block"] != now:
                    if now is not None:
                        yield done()
                    now = row["block"]
                for part in pa.ipc.open_stream(row["data"]):
                    learn = part.column("learn")
                    for _, _, data, at in kernel.chunks(part.filter(learn).column("text"), _CHUNK):
                        text, at = _ended(data, at)
                        raw.append((_contexts(text, at) << np.uint64(8) | text).ravel())
                        if sum(len(x) for x in raw) >= 3 << 20:
                            settle()
                    for _, _, data, at in kernel.chunks(part.filter(pc.invert(learn)).column("text"), _CHUNK):
                        key = np.sort(_contexts(*_ended(data, at)).ravel())
                        wanted.append(key[np.concatenate([[True], key[1:] != key[:-1]])])
        if now is not None:
            yield done()

    return run


def _sum_rows(batches: Iterator[pa.RecordBatch], many: int) -> Iterator[pa.RecordBatch]:
    """Packed (code, count) with the counts of all blocks, from rows in the order of ranges.

    Left out are contexts never seen, and for the block that has it in training texts only, a context seen once.
    Contexts that ``many`` blocks have are in one row with a block below zero.
    """
    now, blocks, sent = None, [], []

    def done() -> pa.RecordBatch:
        code, number = (np.concatenate(x) for x in zip(*sent, strict=True))
        own = number >> np.uint64(1)
        row = np.repeat(np.arange(len(sent)), [len(x) for x, _ in sent])
        key = code >> np.uint64(8)
        begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])]))
        mine, marked = np.add.reduceat(own, begin), np.bitwise_or.reduceat(number & np.uint64(1), begin) > 0
        key, row = key[begin], row[begin]
        code, n = _summed(code, own)
        code, n = code[n > 0], n[n > 0]
        known = code >> np.uint64(8)
        head = np.flatnonzero(np.concatenate([[True], known[1:] != known[:-1]])) if len(known) else np.zeros(0, int)
        known, size = known[head], np.diff(np.append(head, len(code)))
        if not len(known):
            return _rows([], False, [], [])
        place = np.minimum(np.searchsorted(known, key), len(known) - 1)
        alone = (size[place] == 1) & (n[head[place]] == 1) & (mine == 1) & ~marked
        some = known[place] == key
        common = np.bincount(place[some], minlength=len(known)) >= many
        some &= ~alone & ~common[place]
        place, row = place[some], row[some]
        size = size[place]
        end = np.cumsum(size)
        at = np.repeat(head[place] - (end - size), size) + np.arange(end[-1] if len(end) else 0)
        cut = np.append(0, end)[np.searchsorted(row, np.arange(len(sent) + 1))]
        found = [(blocks[r], _squeezed(code[at[cut[r] : cut[r + 1]]], n[at[cut[r] : cut[r + 1]]])) for r in np.flatnonzero(np.diff(cut))]
        if common.any():
            of_all = np.repeat(common, np.diff(np.append(head, len(code))))
            found.append((-1 - now, _squeezed(code[of_all], n[of_all])))
        return _rows([b for b, _ in found], False, [now] * len(found), [x for _, x in found])

    for batch in batches:
        for row in _each(batch):
            if row["part"] != now:
                if sent:
                    yield done()
                now, blocks, sent = row["part"], [], []
            blocks.append(row["block"])
            sent.append(_loosened(row["data"]))
    if sent:
        yield done()


def _opened(batches: Iterator[pa.RecordBatch], whole: Common | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of contexts, then of texts, of packed blocks. ``whole``: with those of the block's contexts that were not sent with it."""

    def keys(block: int, cells: list[tuple[np.ndarray, np.ndarray]], parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        code, n = (np.concatenate(x) for x in zip(*cells, strict=True)) if cells else (np.zeros(0, np.uint64),) * 2
        code, one = np.unique(code, return_index=True)
        n = n[one]
        if whole is not None:
            raw, mine = [], []
            for part in parts:
                learn = part.column("learn").to_numpy(zero_copy_only=False)
                for row, last, data, at in kernel.chunks(part.column("text"), _CHUNK):
                    text, at = _ended(data, at)
                    raw.append((_contexts(text, at) << np.uint64(8) | text).ravel())
                    mine.append(np.tile(np.repeat(learn[row:last], np.diff(at)), ORDERS))
            raw, mine = np.concatenate(raw), np.concatenate(mine)
            every, count = whole.counts()
            own = np.isin(every >> np.uint64(8), raw >> np.uint64(8))
            code, n = np.concatenate([code, every[own]]), np.concatenate([n, count[own]])
            alone = np.setdiff1d(raw[mine], code)
            code, n = _summed(np.concatenate([code, alone]), np.concatenate([n, np.ones(len(alone), np.uint64)]))
        key = code >> np.uint64(8)
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        columns = [pa.array(np.full(len(key), block)), *_packed(key, code, n)]
        nulls = [pa.nulls(len(key), t) for t in (pa.int64(), pa.int64(), pa.bool_(), pa.string())]
        return pa.RecordBatch.from_arrays([*columns, *nulls], names=["block", "key", "seen", "n", "id", "doc_id", "learn", "text"])

    def texts(block: int, part: pa.RecordBatch) -> pa.RecordBatch:
        size = part.num_rows
        columns = [pa.array(np.full(size, block)), *(pa.nulls(size, t) for t in (pa.int64(), pa.binary(), pa.binary())), *part.columns]
        return pa.RecordBatch.from_arrays(columns, names=["block", "key", "seen", "n", *part.schema.names])

    now, cells, held, sent = None, [], [], False
    for batch in batches:
        if "key" in batch.schema.names:
            yield batch
            continue
        for row in _each(batch):
            if row["block"] < 0:
                continue
            if row["block"] != now:
                if held:
                    yield keys(now, cells, held)
                    yield from (texts(now, x) for x in held)
                now, cells, held, sent = row["block"], [], [], False
            if not row["texts"]:
                cells.append(_loosened(row["data"]))
                continue
            for part in pa.ipc.open_stream(row["data"]):
                if whole is not None:
                    held.append(part)
                    continue
                if not sent:
                    yield keys(now, cells, [])
                    cells, sent = [], True
                yield texts(now, part)
    if held:
        yield keys(now, cells, held)
        yield from (texts(now, x) for x in held)


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Sixteenths of the log-odds of a one at each of 255 nodes, from byte counts by context."""
    level = counts.reshape(-1, 256).astype(np.float32)
    out = np.zeros(level.shape, np.int8)
    for j in range(7, -1, -1):
        zero, one = level[:, 0::2], level[:, 1::2]
        odds = np.log((one + np.float32(0.05)) / (zero + np.float32(0.05))) * np.float32(16)
        out[:, 1 << j : 2 << j] = np.clip(np.rint(odds), -127, 127)
        level = zero + one
    return out.ravel()


class Table(tuple):
    """(log-odds, keys, starts) of a block, with log-odds along the bits of each byte that was seen after a context; ``lean``: no others are kept."""

    codes: np.ndarray
    paths: np.ndarray
    first: np.ndarray
    shift: np.uint64

    def __new__(cls, code: np.ndarray, n: np.ndarray, lean: bool = False):
        order = np.argsort(code, kind="stable")
        order = order[np.concatenate([[True], np.diff(code[order]) > 0])] if len(code) else order
        code, n = code[order], n[order]
        key = code >> np.uint64(8)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        size = np.diff(np.append(first, len(key)))
        byte = (code & np.uint64(255)).astype(np.uint8)

        def slices(contexts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            """(first, places of the bytes, log-odds) of runs of contexts."""
            for s in range(0, len(contexts), _SLICE):
                some = contexts[s : s + _SLICE]
                at = np.repeat(first[some] - np.cumsum(size[some]) + size[some], size[some]) + np.arange(size[some].sum())
                dense = np.zeros((len(some), 256), np.float32)
                dense[np.repeat(np.arange(len(some)), size[some]), byte[at]] = n[at]
                yield s, at, log_odds(dense)

        if lean:
            n = n.astype(np.float32)
            self = super().__new__(cls, (None, key[first], None))
            paths = np.zeros(len(code), np.uint64)
            for s, at, part in slices(np.arange(len(first))):
                paths[at] = _along(part, np.repeat(np.arange(len(part) // 256) * 256, size[s : s + _SLICE]), byte[at].astype(np.intp))
        else:
            kind = kernel.mix(byte.astype(np.uint64) << np.uint64(48) | n.astype(np.uint64))
            kind = np.add.reduceat(kind, first) if len(first) else kind
            _, one, row = np.unique(kind, return_index=True, return_inverse=True)  # equal counts, one row
            odds = np.zeros((len(one) + 1, 256), np.int8)  # the last is that of contexts never seen
            for s, _, part in slices(one):
                odds[s : s + _SLICE][: len(part) // 256] = part.reshape(-1, 256)
            odds, starts = odds.ravel(), np.append(row, len(one)) * 256
            self = super().__new__(cls, (odds, key[first], starts))
            paths = _along(odds, np.repeat(starts[:-1], size), byte.astype(np.intp))
        self.slices = slices
        spread = code * np.uint64(kernel.BASES[0])
        order = np.argsort(spread)
        bits = max(len(code), 1).bit_length()
        self.shift = np.uint64(64 - bits)
        self.first = np.append(0, np.cumsum(np.bincount((spread >> self.shift).astype(np.intp), minlength=1 << bits))).astype(np.int32)
        self.codes, self.paths = np.append(spread[order], np.uint64(0)), np.append(paths[order], np.uint64(0))
        return self

    def find(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds along the bits of each code, and whether it is there."""
        spread = code * np.uint64(kernel.BASES[0])
        slot = (spread >> self.shift).astype(np.intp)
        place = self.first.take(slot).astype(np.intp)
        there = self.codes.take(place) == spread
        there &= place < len(self.codes) - 1
        todo = np.flatnonzero(~there)
        end = self.first.take(slot[todo] + 1)
        while len(todo):
            more = place[todo] + 1 < end
            todo, end = todo[more], end[more]
            place[todo] += 1
            hit = self.codes.take(place[todo]) == spread[todo]
            there[todo] = hit
            todo, end = todo[~hit], end[~hit]
        return self.paths.take(place), there


    def unseen(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds along the bits of each code whose context was seen, and whether it was."""
        odds, keys, starts = self
        place = np.minimum(np.searchsorted(keys, code >> np.uint64(8)), len(keys) - 1)
        hit = keys[place] == code >> np.uint64(8)
        byte = (code[hit] & np.uint64(255)).astype(np.intp)
        if starts is not None:
            return _along(odds, starts[place[hit]], byte), hit
        some, row = np.unique(place[hit], return_inverse=True)
        odds = np.concatenate([part for _, _, part in self.slices(some)]) if len(some) else np.zeros(0, np.int8)
        return _along(odds, row * 256, byte), hit


def _along(table: np.ndarray, start: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """The log-odds at the eight nodes of bytes in rows of a table, eight of them in one number."""
    out = np.empty((len(start), 8), np.int8)
    for s in range(0, len(start), 1 << 16):
        out[s : s + (1 << 16)] = table.take(_NODE.take(byte[s : s + (1 << 16)], 0) + start[s : s + (1 << 16), None])
    return out.view(np.uint64).ravel()


#: Log-odds along the bits of each byte, after contexts that were seen once, before this byte.
_ALONE = _along(log_odds(np.eye(256)), np.arange(256) * 256, _BYTES)


#: The table of common contexts that a Python worker has made last, and its name.
_made: dict[str, Table] = {}


class Common:
    """The contexts that many blocks have, with their counts, for every task."""

    def __init__(self, sent: Broadcast):
        self.sent, self.name = sent, uuid.uuid4().hex

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        rows = [_loosened(x) for x in self.sent.value]
        return tuple(np.concatenate(x) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.uint64),) * 2

    def table(self) -> Table:
        if self.name not in _made:
            _made.clear()
            _made[self.name] = Table(*self.counts(), lean=True)
        return _made[self.name]


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Table]]:
    """(rows of texts, log-odds, keys and starts of their block), where a block's contexts come before its texts."""
    now, held, table = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        context = batch.column("key").is_valid().to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((block[1:] != block[:-1]) | (context[1:] != context[:-1])) + 1
        for s, e in zip([0, *cut], [*cut, len(block)], strict=True):
            part = batch.slice(int(s), int(e - s))
            if block[s] != now:
                now, held, table = block[s], [], None
            if context[s]:
                held.append(_unpacked(part)[1:])
            else:
                if table is None:
                    table = Table(*(np.concatenate(x) for x in zip(*held, strict=True))) if held else Table(np.zeros(0, np.uint64), np.zeros(0))
                held = []
                yield part, table


class Model:
    def __init__(self, table: np.ndarray | Table, common: Table | None = None):
        """The log-odds of a block, and of contexts that many blocks have; a table without keys has contexts dealt over it."""
        self.table, self.common = table, common
        self.weights = np.full((ORDERS, 4, 8), 0.45 / 16, np.float32)  # by predictor, kind of the last byte, bit
        self.last = None  # by node and mixed log-odds: probability of a one

    def paths(self, text: np.ndarray, at: np.ndarray, learnt: np.ndarray) -> np.ndarray:
        """The predictors' log-odds along the bits of each byte of texts that end with a zero byte; ``learnt``: training texts."""
        key = _contexts(text, at)
        if not isinstance(self.table, Table):
            size = int(_STARTS[1]) // 256
            rows = (key % np.uint64(size)).astype(np.int64) * 256 + _STARTS[:-1, None]
            return _along(self.table, rows.ravel(), np.tile(text, ORDERS)).reshape(ORDERS, -1)
        code = (key << np.uint64(8) | text).ravel()
        tables = [x for x in (self.common, self.table) if x is not None and len(x.codes) > 1]
        path, gone = np.zeros(len(code), np.uint64), np.arange(len(code))
        for k, table in enumerate(tables):
            found, there = table.find(code[gone] if k else code)
            if k:
                path[gone] = found
            else:
                path = found
            gone = gone[~there]
        byte = text[gone % len(text)].astype(np.intp)
        path[gone] = _ALONE[byte]
        other = ~np.repeat(learnt, np.diff(at))[gone % len(text)]
        gone = gone[other]
        path[gone] = 0
        for table in tables if len(gone) else ():
            found, hit = table.unseen(code[gone])
            path[gone[hit]] = found
        return path.reshape(ORDERS, -1)

    @staticmethod
    def _run(weights: np.ndarray, text: np.ndarray, kind: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, ...]:
        """(predictors' log-odds, mixed ones, signs of the bits, probabilities of the bits) of a run of bytes."""
        x = np.ascontiguousarray(path).view(np.int8).reshape(ORDERS, len(text), 8).astype(np.float32)
        z = weights[0].take(kind, 0)
        z *= x[0]
        for o in range(1, ORDERS):
            y = weights[o].take(kind, 0)
            y *= x[o]
            z += y
        np.minimum(np.maximum(z, -12, out=z), 11.99, out=z)
        sign = _SIGN.take(text, 0)
        p = z * sign
        np.exp(np.negative(p, out=p), out=p)
        p += 1
        np.reciprocal(p, out=p)
        return x, z, sign, p

    @staticmethod
    def _step(weights: np.ndarray, kind: np.ndarray, x: np.ndarray, sign: np.ndarray, p: np.ndarray) -> None:
        """Weights after a run of bytes."""
        miss = 1 - p
        miss *= sign
        x *= miss
        gate = (kind == np.arange(4)[:, None]).astype(np.float32) * np.float32(_RATE / max(1.0, len(kind) / 256))
        for o in range(ORDERS):
            weights[o] += gate @ x[o]

    def fit(self, text: np.ndarray, at: np.ndarray, path: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read training texts one after the other and keep the weights; bits and ones by node and bucket."""
        kind = _KIND[np.concatenate([[32], text[:-1]])]
        kind[at[:-1]] = 1
        place = np.empty((len(text), 8), np.int64)
        for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            for s in range(begin, end, _RUN):
                e = min(s + _RUN, end)
                x, z, sign, p = self._run(self.weights, text[s:e], kind[s:e], path[:, s:e])
                z += 12
                z *= np.float32(32 / 24)
                place[s:e] = z
                self._step(self.weights, kind[s:e], x, sign, p)
        place <<= 1
        place += _PLACE.take(text, 0)
        counts = np.bincount(place.ravel(), minlength=2 * LAST).reshape(-1, 2)
        return counts.sum(1), counts[:, 1]

    @staticmethod
    def _logs(last: np.ndarray | None, text: np.ndarray, z: np.ndarray, p: np.ndarray) -> np.ndarray:
        """log10 probability of each byte of a run; ``last``: the last stage's probabilities of a zero and a one by place."""
        size = 0.0
        if last is not None:
            z += 12
            z *= np.float32(32 / 24)
            place = z.astype(np.int64)
            place <<= 1
            place += _PLACE.take(text, 0)
            p += last.take(place)
            size = 8 * _LOG2
        p = p[:, :4] * p[:, 4:]
        p = (p[:, :2] * p[:, 2:]).astype(np.float64)
        return np.log(p[:, 0] * p[:, 1]) / _LN10 - size

    def scores(self, text: np.ndarray, at: np.ndarray, path: np.ndarray) -> np.ndarray:
        """log10 probability of each of texts that end with a zero byte."""
        kind = _KIND[np.concatenate([[32], text[:-1]])]
        kind[at[:-1]] = 1
        size = np.diff(at)
        long = size > _RUN
        logs = np.empty(len(text))
        last = None if self.last is None else np.stack([1 - self.last, self.last], 1)
        short = np.flatnonzero(np.repeat(~long, size))
        for s in range(0, len(short), _RUN):
            some = short[s : s + _RUN]
            _, z, _, p = self._run(self.weights, text[some], kind[some], path[:, some])
            logs[some] = self._logs(last, text[some], z, p)
        for t in np.flatnonzero(long):
            weights = self.weights.copy()
            for s in range(at[t], at[t + 1], _RUN):
                e = min(s + _RUN, at[t + 1])
                x, z, sign, p = self._run(weights, text[s:e], kind[s:e], path[:, s:e])
                if e < at[t + 1]:
                    self._step(weights, kind[s:e], x, sign, p)
                logs[s:e] = self._logs(last, text[s:e], z, p)
        return np.add.reduceat(logs, at[:-1])

    def score(self, text: np.ndarray) -> float:
        """log10 probability of a text with its end."""
        at = np.array([0, len(text)])
        return float(self.scores(text, at, self.paths(text, at, np.zeros(1, bool)))[0])


def _fit_rows(batches: Iterator[pa.RecordBatch], common: Common | None = None) -> Iterator[pa.RecordBatch]:
    """(place, a, b) of a task's training texts: bits and ones of the last stage's places, after these the weights times bytes, and bytes."""
    counts = np.zeros(LAST), np.zeros(LAST)
    weights, size = np.zeros(ORDERS * 32), 0
    model, table, read = None, None, 0
    for part, own in _by_block(_opened(batches)):
        if own is not table:
            if model is not None:
                weights, size = weights + model.weights.ravel() * float(read), size + read
            table, model, read = own, Model(own, common and common.table()), 0
        for _, _, data, at in kernel.chunks(part.filter(part.column("learn")).column("text"), _CHUNK):
            text, at = _ended(data, at)
            bits, ones = model.fit(text, at, model.paths(text, at, np.ones(len(at) - 1, bool)))
            counts[0][:] += bits
            counts[1][:] += ones
            read += len(text)
    if model is not None:
        weights, size = weights + model.weights.ravel() * float(read), size + read
    if size:
        a, b = np.append(counts[0], weights), np.append(counts[1], np.full(len(weights), float(size)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(a), dtype=np.int32)), pa.array(a), pa.array(b)], names=["place", "a", "b"])


def _fitted(blocks: DataFrame, common: Common) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and last stage from all training texts; a row for each place reaches the driver, whatever the input."""
    sums = blocks.mapInArrow(lambda batches: _fit_rows(batches, common), "place int, a double, b double").groupBy("place").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    sums = sums.toPandas().sort_values("place")
    if not len(sums):
        return None
    a, b = sums["a"].to_numpy(), sums["b"].to_numpy()
    middle = 1 / (1 + np.exp(-(np.tile((np.arange(33) + 0.5) * 24 / 32 - 12, 256))))
    last = (b[:LAST] + 8 * middle) / (a[:LAST] + 8)
    return (a[LAST:] / b[LAST:]).astype(np.float32).reshape(ORDERS, 4, 8), last.astype(np.float32)


def _blocks(rows: DataFrame, block_bytes: int) -> tuple[DataFrame, Common]:
    """Packed texts of each block after the packed sums of its contexts, kept on disk where they lie, and common contexts, of (id, doc_id, learn, text)."""
    spark = rows.sparkSession
    tasks = partitions(spark)
    rows = rows.select("id", "doc_id", "learn", "text")
    texts = stored(rows.mapInArrow(_dealt(block_bytes), _PACKED), "blocks")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = texts.select("block").distinct().count()
    many = max(3, dealt / 2)
    sent = texts.mapInArrow(_block_rows(max(2 * tasks, size // _PART)), _PACKED)
    summed = sent.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(lambda batches: _sum_rows(batches, many), _PACKED)
    blocks = summed.unionByName(texts).repartition(max(tasks, 2 * dealt), "block").sortWithinPartitions("block", "texts", "part").persist(StorageLevel.DISK_ONLY)
    return blocks, Common(spark.sparkContext.broadcast([bytes(x.data) for x in blocks.where("block < 0").select("data").collect()]))


def gathered(rows: DataFrame, block_bytes: int = BLOCK) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray] | None]:
    """(texts of each block after the summed counts of its contexts, fitted weights and last stage) of (id, doc_id, learn, text)."""
    blocks, common = _blocks(rows, block_bytes)
    return blocks.mapInArrow(lambda batches: _opened(batches, common), _OPENED), _fitted(blocks, common)


def _score_rows(fitted: tuple[np.ndarray, np.ndarray] | None, frequent: np.ndarray, logs: np.ndarray, common: Common | None = None):
    """Rows with their words, known words and log10 counts of frequent words, and the model's score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = None, None
        for batch, own in _by_block(_opened(batches)):
            if own is not table:
                table, model = own, Model(own, common and common.table())
                if fitted is not None:
                    model.weights, model.last = fitted
            learn = batch.column("learn").to_numpy(zero_copy_only=False)
            n, size, known, sums, scores = (np.zeros(batch.num_rows, t) for t in (np.int64, np.int64, np.int64, float, float))
            for row, last, data, at in kernel.chunks(batch.column("text"), _CHUNK):
                hashes, first = kernel.word_hashes(data, at)
                place, hit = _lookup(frequent, hashes)
                k, v = np.concatenate([[0], np.cumsum(hit)]), np.concatenate([[0.0], np.cumsum(np.where(hit, logs[place], 0.0) if len(logs) else np.zeros(len(hit)))])
                n[row:last] = np.diff(first)
                size[row:last] = np.diff(at)
                known[row:last] = np.diff(k[first])
                sums[row:last] = np.diff(v[first])
                text, at = _ended(data, at)
                scores[row:last] = model.scores(text, at, model.paths(text, at, learn[row:last]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("doc_id"), batch.column("learn"), *(pa.array(x) for x in (n, size, known, sums, scores))],
                names=["id", "doc_id", "learn", "n", "n_bytes", "known", "logs", "score"],
            )

    return run


def _lookup(ordered: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ordered):
        return np.zeros(len(hashes), np.intp), np.zeros(len(hashes), bool)
    place = np.minimum(np.searchsorted(ordered, hashes), len(ordered) - 1)
    return place, ordered[place] == hashes


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word hash, count) of a batch."""
    for batch in batches:
        seen = [kernel.word_hashes(data, at)[0] for _, _, data, at in kernel.chunks(batch.column(0))]
        if seen:
            word, count = np.unique(np.concatenate(seen), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count.astype(np.int64))], names=["word", "n"])


def _rare_rows(frequent: np.ndarray):
    """(word hash, ids): a batch's rare words with the documents of each occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            words, owners = [], []
            for row, _, data, at in kernel.chunks(batch.column(1)):
                hashes, first = kernel.word_hashes(data, at)
                rare = ~_lookup(frequent, hashes)[1]
                words.append(hashes[rare])
                owners.append(ids[row + np.repeat(np.arange(len(first) - 1), np.diff(first))[rare]])
            if not words:
                continue
            word, owner = np.concatenate(words), np.concatenate(owners).astype(np.int64)
            order = np.argsort(word, kind="stable")
            word, owner = word[order], owner[order]
            cut = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, int)
            lists = pa.ListArray.from_arrays(pa.array(np.append(cut, len(word)).astype(np.int32)), pa.array(owner))
            yield pa.RecordBatch.from_arrays([pa.array(word[cut].view(np.int64)), lists], names=["word", "ids"])

    return run


def _rare_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, known, logs) summed over a batch of (ids, n)."""
    for batch in batches:
        lists = batch.column(0)
        n = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        ids, at = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        each = np.repeat(n, size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids.astype(np.int64)), pa.array(np.bincount(at, each > 0, len(ids)).astype(np.int64)), pa.array(np.bincount(at, np.log10(each + 0.1), len(ids)))],
            names=["id", "known", "logs"],
        )


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte)."""
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(
        F.xxhash64(F.col(id_col), text).alias("id"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.coalesce(learn, F.lit(True)).alias("learn")
    )
    texts = rows.select("id", "text")
    blocks, common = _blocks(rows, BLOCK)
    fitted = _fitted(blocks, common)
    counts = rows.where("learn").select("text").mapInArrow(_word_rows, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(counts, "words")
    ends = rows.where("learn").count()
    size = counts.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = (size[0] or 0) + ends, size[1] + (ends > 0)
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toPandas()
    order = np.argsort(top["word"].to_numpy(np.int64).view(np.uint64))
    frequent = top["word"].to_numpy(np.int64).view(np.uint64)[order]
    logs = np.log10(top["n"].to_numpy(float)[order] + 0.1)
    rare = texts.mapInArrow(_rare_rows(frequent), "word long, ids array<long>").join(counts, "word", "left")
    rare = rare.select("ids", F.coalesce("n", F.lit(0).cast("long")).alias("n")).mapInArrow(_rare_sums, "id long, known long, logs double")
    rare = rare.groupBy("id").agg(F.sum("known").alias("rare_known"), F.sum("logs").alias("rare_logs"))
    scored = blocks.mapInArrow(
        _score_rows(fitted, frequent, logs, common), "id long, doc_id long, learn boolean, n long, n_bytes long, known long, logs double, score double"
    )
    scored = stored(scored, "scored")
    blocks.unpersist()
    # equal rows have one id: each has its share of what the words of all of them add up to
    twins = scored.groupBy("id").agg(F.count("*").alias("twins"))
    rare = rare.join(twins, "id").select("id", (F.col("rare_known") / F.col("twins")).alias("rare_known"), (F.col("rare_logs") / F.col("twins")).alias("rare_logs"))
    whole = scored.join(rare, "id", "left")
    norm = float(np.log10(tokens + 0.1 * (distinct + 1)))
    return whole.select(
        "doc_id", (~F.col("learn")).alias("held_out"), (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce(F.round("rare_known"), F.lit(0.0)) + int(ends > 0)).cast("long").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) + float(np.log10(ends + 0.1)) - (F.col("n") + 1) * norm).alias("base_score"), "score",
        (-F.col("score") / np.log10(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
