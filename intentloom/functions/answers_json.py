"""Finding and repairing one JSON object in model output, as Arrow UDFs.

Nesting is not a regular language, so no built-in expression can do this. The
helpers look only at quotes, brackets and backslashes and read a text once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F, types as T

_MARKS = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_CLOSER = {"{": "}", "[": "]"}
_RESOLVED = T.StructType().add("answer", T.StringType()).add("resolution", T.StringType())


def _brackets(text: str, start: int = 0) -> Iterator[tuple[str, int]]:
    """Brackets outside strings, each with the position after it.

    A backslash escapes only inside a string. If a string is still open at the
    end, a last ``"`` says so.
    """
    quoted = False
    for mark in _MARKS.finditer(text, start):
        token = mark.group() if quoted else mark.group()[-1]
        if token == '"':
            quoted = not quoted
        elif not quoted and token in "{}[]":
            yield token, mark.end()
    if quoted:
        yield '"', len(text)


def first_object(text: str | None) -> str | None:
    """The first balanced ``{...}``; null when there is none."""
    start = (text or "").find("{")
    if start < 0:
        return None
    depth = 0
    for token, end in _brackets(text, start):
        depth += {"{": 1, "}": -1}.get(token, 0)
        if token == "}" and depth == 0:
            return text[start:end]
    return None


def close_object(text: str | None) -> str | None:
    """Append what a cut-off object still has open; null when that is unsafe."""
    body = (text or "").strip()
    if not body.startswith("{"):
        return None
    still_open: list[str] = []
    for token, _ in _brackets(body):
        if token == '"':
            return None
        if token in _CLOSER:
            still_open.append(_CLOSER[token])
        elif still_open and still_open[-1] == token:
            still_open.pop()
    return body + "".join(reversed(still_open))


def _loads(text: str | None) -> object:
    """Parsed value, or None when it is no JSON (a JSON null is of no use either)."""
    if text is None:
        return None
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return None


def resolve(parts: list[str], text: str | None) -> tuple[str | None, str]:
    """(object text, how it was found) in the order parts, then whole text."""
    for part in parts:
        raw = (part or "").strip()
        if not raw:
            continue
        value = _loads(raw)
        if isinstance(value, dict):
            return raw, "direct"
        if value is not None or raw == "null":
            break  # valid JSON but no object: only the whole text may still help
        for found, how in ((first_object(raw), "first_object"), (close_object(raw), "auto_close")):
            if isinstance(_loads(found), dict):
                return found, how
    whole = (text or "").strip()
    found = first_object(whole)
    if isinstance(_loads(found), dict):
        return found, "text_first_object"
    found = close_object(whole)
    if isinstance(_loads(found), dict):
        return found, "text_auto_close"
    return None, "failed"


@F.pandas_udf(T.StringType())
def extract_json(text: pd.Series) -> pd.Series:
    return text.map(first_object)


@F.pandas_udf(T.StringType())
def autoclose_json(text: pd.Series) -> pd.Series:
    return text.map(close_object)


@F.arrow_udf(_RESOLVED)
def resolve_answer(parts: pa.Array, text: pa.Array) -> pa.Array:
    found = [resolve(p or [], t) for p, t in zip(parts.to_pylist(), text.to_pylist(), strict=True)]
    answers, how = zip(*found, strict=True) if found else ((), ())
    return pa.StructArray.from_arrays(
        [pa.array(answers, pa.string()), pa.array(how, pa.string())], ["answer", "resolution"]
    )
