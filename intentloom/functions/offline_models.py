"""Deterministic offline stand-ins for the text generator and the embedder.

Real services are injected as factories with the same shape (operators.models).
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

# What the offline generator writes before the profile line, per slot.
LEADS = {
    "en": {
        "Q1": "practical learning guides and advice for",
        "Q2": "career options and first steps in",
        "Q3": "hands on projects to practise for",
        "Q4": "new technology topics worth exploring around",
        "Q5": "unexpected neighbouring fields that suit",
    },
    "th": {
        "Q1": "แนวทางการเรียนรู้และคำแนะนำ",
        "Q2": "เส้นทางอาชีพและก้าวแรกของสาย",
        "Q3": "โครงงานฝึกปฏิบัติจริงสำหรับสาย",
        "Q4": "หัวข้อเทคโนโลยีใหม่ที่น่าสำรวจ",
        "Q5": "สาขาใกล้เคียงที่น่าสนใจสำหรับสาย",
    },
}
FOCUS_WORDS = 4
FOCUS_CHARS = 30

_LANGUAGE = re.compile(r"^Answer language: (\w+)$", re.MULTILINE)
_SLOT = re.compile(r"^(Q\d) \| (\w+) \| ([\d.]+)$", re.MULTILINE)
_PROFILE = re.compile(r"^Profile:\n[^:\n]*: ([^\n]*)$", re.MULTILINE)
_NOT_ALNUM = re.compile(r"[^A-Za-z0-9]+")


def _answer(prompt: str) -> str:
    language = _LANGUAGE.search(prompt)
    language = language.group(1) if language else "th"
    profile = _PROFILE.search(prompt)
    words = _NOT_ALNUM.sub(" ", profile.group(1) if profile else "").split()
    if language == "en":
        focus = " ".join(words[:FOCUS_WORDS])
    else:
        focus = " ".join(words)[:FOCUS_CHARS].strip()
    queries = [
        {
            "query_id": slot,
            "query_text": f"{LEADS[language][slot]} {focus}".strip(),
            "weight": float(weight),
            "intent_label": label,
        }
        for slot, label, weight in _SLOT.findall(prompt)
    ]
    return json.dumps({"output_language": language, "queries": queries}, ensure_ascii=False)


def template_generator():
    """Factory: prompts to raw answers."""
    return lambda prompts: prompts.map(_answer)


def _place(token: str, dim: int) -> int:
    """Signed bucket, counted from 1: from the first eight and the ninth hex digit of the MD5."""
    digest = hashlib.md5(token.encode()).hexdigest()
    place = int(digest[:8], 16) % dim + 1
    return place if digest[8] < "8" else -place


def hashing_embedder(dim: int = 768):
    """Factory maker: texts to signed token-count vectors of ``dim`` values.

    A batch is split and encoded by Arrow, so that Python sees each distinct
    token once.
    """

    def build():
        def embed(texts: pd.Series) -> np.ndarray:
            lists = pc.split_pattern_regex(pc.utf8_lower(pa.array(texts, pa.string())), r"[ \t\r\n]+")
            rows, tokens = pc.list_parent_indices(lists), lists.flatten()
            filled = pc.greater(pc.binary_length(tokens), 0)
            rows = rows.filter(filled).to_numpy(zero_copy_only=False)
            coded = tokens.filter(filled).dictionary_encode()
            places = np.array([_place(t, dim) for t in coded.dictionary.to_pylist()], dtype=np.int64)
            signed = places[coded.indices.to_numpy()]
            cells = rows.astype(np.int64) * dim + np.abs(signed) - 1
            sums = np.bincount(cells, np.sign(signed), minlength=len(texts) * dim)
            return sums.reshape(-1, dim).astype(np.float32)

        return embed

    return build
