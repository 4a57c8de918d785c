"""Model stages: the calls themselves are injected.

A factory runs once per Python task and returns the callable, so a client is
built once and used for all batches of that task.

* generator: ``Series[str] -> Series[str]`` or a frame with ``text`` and, where
  known, ``input_tokens``, ``output_tokens``, ``latency_s``.
* embedder: ``Series[str] -> sequence of vectors``.

A batch is a part of an Arrow batch: at most ``CALL_TEXTS`` texts of ``CALL_BYTES`` in all, or one
longer text, so that what a call holds doesn't grow with the Arrow batch. A batch that raises is
halved until only the texts that fail alone are left out. Where single texts go on failing and so do others spread over the batch, it is an outage: the
rest has the error ``not_called``, which says that a later pass has to call these rows;
the generator's own attempts do so while there are any left.
"""

from __future__ import annotations

import tempfile
import math
import time
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from intentloom.functions.answers_json import resolve
from intentloom.functions.text import col, strip
from intentloom.functions.vectors import as_lists, sizes_of, unit
from intentloom.params import JobParams

Factory = Callable[[], Callable[[pd.Series], Any]]

_CALL = (
    T.StructType()
    .add("attempt", T.IntegerType())
    .add("input_tokens", T.LongType())
    .add("output_tokens", T.LongType())
    .add("latency_s", T.DoubleType())
)
CALLS = T.ArrayType(_CALL)
_GENERATED = (
    T.StructType()
    .add("raw", T.StringType())
    .add("error", T.StringType())
    .add("calls", CALLS)
)
_ARROW_GENERATED = to_arrow_type(_GENERATED)
_VECTOR = T.ArrayType(T.FloatType())
_EMBEDDED_ONE = T.StructType().add("vector", _VECTOR).add("error", T.StringType())
_EMBEDDED = T.StructType().add("vectors", T.ArrayType(_VECTOR)).add("error", T.StringType())


def _int(value: object) -> int | None:
    try:
        return int(value)  # type: ignore[call-overload]
    except (TypeError, ValueError, OverflowError):
        return None


def _seconds(value: object) -> float | None:
    """A finite number of seconds, else null."""
    try:
        seconds = float(value)  # type: ignore[arg-type]
    except (TypeError, ValueError):
        return None
    return seconds if math.isfinite(seconds) else None


def _reply_text(told: Any) -> str:
    """The text of a reply; raises where it has none that can be stored."""
    text = told.get("text") if isinstance(told, dict) else None
    if not isinstance(text, str):
        raise ValueError(f"bad_reply: text is {type(text).__name__}")
    text.encode("utf-8")
    return text


#: After so many single failures in a row with one and the same error as many texts spread over the rest are tried; only
#: if these fail with it too are the others left uncalled.
OUTAGE = 8
NOT_CALLED = "not_called"
#: The most texts of a call, and the most bytes of them; a longer text is called alone.
CALL_TEXTS, CALL_BYTES = 1024, 4 << 20


def _calls(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive parts of a string column, each small enough for a call."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + CALL_BYTES, "right"))
        stop = min(max(stop, start + 1), start + CALL_TEXTS)
        yield texts.slice(start, stop - start)
        start = stop


def _row_parts(lists: pa.Array) -> Iterator[pa.Array]:
    """Consecutive rows with at most ``CALL_TEXTS`` texts, or one row with more."""
    ends = np.cumsum(sizes_of(lists), dtype=np.int64)
    start = 0
    while start < len(lists):
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + CALL_TEXTS, "right"))
        stop = min(max(stop, start + 1), start + CALL_TEXTS)
        yield lists.slice(start, stop - start)
        start = stop


def _each(call: Callable[[list[str]], list], texts: list[str], uncalled: set[int] | None = None) -> list[tuple[Any, str | None]]:
    """(result, error) per text, with failures narrowed down to single texts. ``uncalled`` takes the places of
    texts that an outage left uncalled; they bear its error."""
    made: dict[int, tuple[Any, str | None]] = {}
    failed: list[str] = []

    def tried(at: list[int]) -> bool:
        """Whether the call went through or ended at a single text."""
        try:
            results = call([texts[i] for i in at])
            if len(results) != len(at):
                raise ValueError(f"{len(results)} results for {len(at)} texts")
            made.update((i, (result, None)) for i, result in zip(at, results, strict=True))
            failed.clear()
        except Exception as failure:  # noqa: BLE001 - whatever an injected call raises
            if len(at) > 1:
                return False
            error = f"{type(failure).__name__}: {failure}"
            if failed and failed[-1] != error:
                failed.clear()
            failed.append(error)
            made[at[0]] = (None, error)
        return True

    todo = [list(range(len(texts)))]
    while todo:
        at = [i for i in todo.pop() if i not in made]
        if not at:
            continue
        if not tried(at):
            half = len(at) // 2
            todo += [at[half:], at[:half]]
        if len(failed) < OUTAGE:
            continue
        rest = sorted({i for some in todo for i in some} - made.keys())
        error = failed[-1]
        down = True
        for k in range(min(OUTAGE, len(rest))):
            tried([rest[(2 * k + 1) * len(rest) // (2 * min(OUTAGE, len(rest)))]])
            if not failed or failed[-1] != error:
                down = False
                break
        if not down:
            failed.clear()
            continue
        for i in rest:
            if i not in made:
                made[i] = (None, error)
                if uncalled is not None:
                    uncalled.add(i)
        break
    return [made[i] for i in range(len(texts))]


def _ask(call: Callable[[pd.Series], Any], prompts: list[str]) -> list[dict]:
    started = time.perf_counter()
    reply = call(pd.Series(prompts, dtype=object))
    share = (time.perf_counter() - started) / len(prompts)
    if not isinstance(reply, pd.DataFrame):
        reply = pd.DataFrame({"text": reply})
    return [{"latency_s": share, **told} for told in reply.to_dict("records")]


def generate(prompt: Column | str, factory: Factory, retry_limit: int) -> Column:
    """Call the generator; rows whose answer holds no JSON object, and rows
    that an outage left uncalled, are asked again, up to ``retry_limit`` more times. Every attempt is listed in ``calls``."""

    @F.arrow_udf(_GENERATED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        call = factory()
        for prompts in (part.to_pylist() for batch in batches for part in _calls(batch)):
            rows: list[dict] = [{"raw": None, "error": None, "calls": []} for _ in prompts]
            todo = [i for i, p in enumerate(prompts) if p is not None]
            for attempt in range(1, retry_limit + 2):
                again = []
                uncalled: set[int] = set()
                replies = _each(lambda some: _ask(call, some), [prompts[i] for i in todo], uncalled)
                for at, (i, (told, error)) in enumerate(zip(todo, replies, strict=True)):
                    if at in uncalled:
                        error = f"{NOT_CALLED}: {error}"
                        again.append(i)
                    rows[i]["error"] = error
                    if error is not None:
                        continue  # only unreadable answers and uncalled rows are asked again
                    try:
                        text = _reply_text(told)
                    except ValueError as odd:
                        rows[i]["error"] = str(odd)
                        continue
                    rows[i]["raw"] = text
                    rows[i]["calls"].append(
                        {
                            "attempt": attempt,
                            "input_tokens": _int(told.get("input_tokens")),
                            "output_tokens": _int(told.get("output_tokens")),
                            "latency_s": _seconds(told.get("latency_s")),
                        }
                    )
                    if resolve([text], text)[0] is None:
                        again.append(i)
                todo = again
            yield pa.array(rows, _ARROW_GENERATED)

    return run.asNondeterministic()(col(prompt))


def generate_answers(prompts: DataFrame, factory: Factory, params: JobParams) -> DataFrame:
    """Add ``raw``, ``call_error`` and ``calls``. ``model_tasks`` caps how many
    tasks, and so callers, run at once."""
    if params.model_tasks:
        prompts = prompts.repartition(params.model_tasks)
    made = prompts.withColumn("_g", generate("prompt", factory, params.retry_limit))
    return made.select(
        *prompts.columns,
        F.col("_g.raw").alias("raw"),
        F.col("_g.error").alias("call_error"),
        F.col("_g.calls").alias("calls"),
    )


def _vectors_of(call: Callable[[pd.Series], Any], texts: pa.Array, dim: int) -> tuple[pa.Array, list[str | None]]:
    """:func:`_vectors` of a column of any size."""
    parts = [_vectors(call, part.to_pylist(), dim) for part in _calls(texts)]
    vectors = pa.concat_arrays([v for v, _ in parts]) if parts else pa.array([], pa.list_(pa.float32()))
    return vectors, [e for _, errors in parts for e in errors]


def _vectors(
    call: Callable[[pd.Series], Any], texts: list[str], dim: int
) -> tuple[pa.Array, list[str | None]]:
    """(unit vectors cut to ``dim``, errors) of a batch; a failed text has an empty vector."""
    rows, errors = [], []
    uncalled: set[int] = set()
    for at, (vector, error) in enumerate(_each(lambda some: list(call(pd.Series(some, dtype=object))), texts, uncalled)):
        if at in uncalled:
            error = f"{NOT_CALLED}: {error}"
        try:
            whole = np.zeros(0, np.float32) if error else np.asarray(vector, dtype=np.float32).reshape(-1)
            if not np.isfinite(whole).all():
                raise ValueError("a vector must be finite")
            row = whole[:dim]
        except (TypeError, ValueError):
            row, error = np.zeros(0, np.float32), "bad_vector"
        if not error and len(row) < dim:
            row, error = row[:0], f"embedding dim below {dim}"
        rows.append(row)
        errors.append(error)
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.float32)
    return as_lists(pa.array(unit(flat, sizes)), sizes), errors


def embed(text: Column | str, factory: Factory, dim: int) -> Column:
    """struct(vector, error) of each text; a blank text is embedded as one space."""

    @F.arrow_udf(_EMBEDDED_ONE)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        call = factory()
        for texts in (part for batch in batches for part in _calls(batch)):
            vectors, errors = _vectors(call, texts.to_pylist(), dim)
            yield pa.StructArray.from_arrays([vectors, pa.array(errors, pa.string())], ["vector", "error"])

    stripped = strip(F.coalesce(col(text), F.lit("")))
    return run.asNondeterministic()(F.when(stripped == "", " ").otherwise(stripped))


def embed_lists(texts: Column, factory: Factory, dim: int) -> Column:
    """struct(vectors, error) for an array of texts per row, in one call per batch.

    Vectors come back beside their texts, so no row is exploded and regrouped. They
    are cut and scaled in the same pass. A row's error is that of its first failing
    text; such a row has no vectors, nor has one without an array.
    """

    @F.arrow_udf(_EMBEDDED)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        call = factory()
        for lists in (part for batch in batches for part in _row_parts(batch)):
            sizes = sizes_of(lists)
            vectors, errors = _vectors_of(call, lists.flatten(), dim)
            first = [
                next((e for e in errors[end - size : end] if e is not None), None)
                for size, end in zip(sizes, np.cumsum(sizes), strict=True)
            ]
            null = np.array([e is not None for e in first], dtype=bool)
            null |= lists.is_null().to_numpy(zero_copy_only=False)
            yield pa.StructArray.from_arrays(
                [as_lists(vectors, sizes, null), pa.array(first, pa.string())], ["vectors", "error"]
            )

    blank_safe = F.transform(
        texts, lambda t: F.coalesce(F.nullif(strip(F.coalesce(t, F.lit(""))), F.lit("")), F.lit(" "))
    )
    return run.asNondeterministic()(blank_safe)


def embed_texts(df: DataFrame, text: str, factory: Factory, dim: int) -> DataFrame:
    """Add ``vector``, cut to ``dim`` and then of unit length, and ``embed_error`` of texts
    that failed or came back too short. Documents and queries differ only in the
    factory that is passed."""
    made = df.withColumn("_e", embed(text, factory, dim))
    vector = F.when(F.col("_e.error").isNull(), F.col("_e.vector"))
    return made.withColumns({"vector": vector, "embed_error": F.col("_e.error")}).drop("_e")


def materialize(df: DataFrame) -> DataFrame:
    """Write an expensive or non-repeatable stage once and go on from the files.

    The table lies in the folder the cluster names in ``spark.checkpoint.dir``: lost
    executors re-read files and call no model again, and each consumer reads
    only the columns it needs.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession) -> str:
    """A folder of its own among the tables that a job stores on the way."""
    return f"{_checkpoint_dir(spark).rstrip('/')}/intentloom-{uuid.uuid4().hex}"


def _checkpoint_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="intentloom-checkpoint-")
