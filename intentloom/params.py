"""Job parameters and fixed values."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# ---------------------------------------------------------------------------
# Results depend on these exact constants, labels and formats.
# ---------------------------------------------------------------------------

LANGUAGES = ("th", "en")
DEFAULT_LANGUAGE = "th"
NOT_SPECIFIED = "ไม่ระบุ"

CONTEXT_FORMAT = {
    # major, roles, skills, onboarding group, onboarding description
    "th": "นักศึกษา: %s\nเป้าหมายอาชีพ: %s\nทักษะ: %s\nกลุ่มผู้ใช้: %s (%s)\nภาษา: ไทย",
    "en": "Student major: %s.\nTarget roles: %s.\nSkills: %s.\nOnboard group: %s (%s).\nLanguage: English.",
}

HISTORY_FORMAT = {
    # posts, tags, categories, search words, recent titles
    "th": (
        "พฤติกรรมผู้ใช้ในจากการ Interactive 20 ครั้งล่าสุด \n"
        "โพสต์ที่เคยดู: %s. \n"
        "แท็กที่สนใจ: %s. \n"
        "หมวดหมู่ที่สนใจ: %s. \n"
        "คำค้นหาที่ใช้ล่าสุด: %s. \n"
        "โพสต์ล่าสุดที่สนใจ: %s."
    ),
    # the same five after the number of days
    "en": (
        "User activity in last %d days. Posts interacted: %s. Tags: %s. "
        "Categories: %s. Search keywords: %s. Recent feeds: %s."
    ),
}

RECENT_BLOCK_HEADER = {
    "th": "ฟีดล่าสุดที่มีปฏิสัมพันธ์ (ตัดสั้น):",
    "en": "Recent interacted feeds (truncated):",
}

THEME_SUMMARY_FORMAT = {
    # head: days, events; line: theme, score, events, likes, clicks, dwell
    "th": {
        "head": "สรุปพฤติกรรม %d วันล่าสุด (รวม %d เหตุการณ์):",
        "top": "ธีมที่มีการมีส่วนร่วมสูง:",
        "line": "- %s: คะแนน=%s, เหตุการณ์=%d, ไลก์=%d, คลิก=%d, dwell สูงสุด=%dms",
        "weak": "ธีมที่มีการมีส่วนร่วมน้อย: %s",
    },
    "en": {
        "head": "Summary of last %d days (total %d events):",
        "top": "Highest engagement themes:",
        "line": "- %s: score=%s, events=%d, likes=%d, clicks=%d, max_dwell_ms=%d",
        "weak": "Lower engagement themes: %s",
    },
}

EVENT_WEIGHTS = {
    "view": Decimal("1.0"),
    "click": Decimal("1.2"),
    "like": Decimal("1.5"),
    "search": Decimal("1.0"),
    "share": Decimal("1.6"),
    "comment": Decimal("1.6"),
    "bookmark": Decimal("2.0"),
}
OTHER_EVENT_WEIGHT = Decimal("1.0")

# (at least this many milliseconds, boost), longest first
DWELL_BOOSTS = (
    (60000, Decimal("0.6")),
    (30000, Decimal("0.4")),
    (10000, Decimal("0.2")),
)

THEME_PREFIXES = (
    ("TH_F", "data_career"),
    ("EN_F", "data_career"),
    ("TH_BIO", "biotech"),
    ("TH_SCH", "scholarship"),
    ("TH_UNI", "university"),
)
OTHER_THEME = "other"

WEAK_MIN_EVENTS = 2
WEAK_MAX_SCORE = Decimal("2.1")
WEAK_MAX_DWELL_MS = 8000
WEAK_THEMES = 2

WORDS_EN = (6, 12)
CHARS_TH = (25, 70)

SLOTS = 5
LAST_N = 20

# template -> (slot, intent label, weight)
SLOT_PLANS = {
    "profile": (
        ("Q1", "profile_based", 1.0),
        ("Q2", "profile_based", 1.0),
        ("Q3", "profile_based", 1.0),
        ("Q4", "ai_exploration", 0.6),
        ("Q5", "ai_exploration", 0.6),
    ),
    "interaction": (
        ("Q1", "interaction_primary", 1.0),
        ("Q2", "interaction_secondary", 1.0),
        ("Q3", "profile_based", 0.8),
        ("Q4", "ai_exploration", 0.6),
        ("Q5", "ai_exploration", 0.6),
    ),
    "mixed": (
        ("Q1", "role_or_skill", 1.0),
        ("Q2", "history_aligned", 1.0),
        ("Q3", "practical", 1.0),
        ("Q4", "exploratory", 0.6),
        ("Q5", "exploratory", 0.6),
    ),
    "history": (
        ("Q1", "history_aligned", 1.0),
        ("Q2", "history_aligned", 1.0),
        ("Q3", "practical", 1.0),
        ("Q4", "exploratory", 0.6),
        ("Q5", "exploratory", 0.6),
    ),
    "starter": (
        ("Q1", "role_or_skill", 1.0),
        ("Q2", "role_or_skill", 1.0),
        ("Q3", "practical", 1.0),
        ("Q4", "exploratory", 0.6),
        ("Q5", "exploratory", 0.6),
    ),
}

LLM_RATE_IN_PER_1K = 0.0001
LLM_RATE_OUT_PER_1K = 0.0002
EMBEDDING_RATE_PER_1K_CHARS = 0.00005

SLOW_CALL_S = 30.0
SLOW_CALL_S_BATCH = 20.0
UNIQUE_RATIO_MIN = 0.85
SIGNATURE_DECIMALS = 8

# metadata rebuilt from the profile when a stored bundle has none
FALLBACK_METADATA = {
    "timezone": "UTC",
    "max_output_tokens": 1024,
    "feed_text_max_chars": 872,
    "temperature": 0.1,
}

# ---------------------------------------------------------------------------
# Templates (own wording; a deployment passes its own table)
# ---------------------------------------------------------------------------

LANGUAGE_MARK = "{{preferred_language}}"
CONTEXT_MARK = "{{UserContextText}}"
HISTORY_MARK = "{{HistorySummaryText}}"

_GOALS = {
    "profile": "The reader is new here. Work from the profile alone.",
    "interaction": "Let the recent activity lead; the profile only fills gaps.",
    "mixed": "Blend the profile with whatever little activity is known.",
    "history": "Stay close to the themes of the recent activity.",
    "starter": "Offer broad starting points that suit the profile.",
}
_WITH_HISTORY = ("interaction", "mixed", "history")


def _template(key: str) -> str:
    slots = "\n".join(f"{slot} | {label} | {weight}" for slot, label, weight in SLOT_PLANS[key])
    text = (
        f"Write five short search phrases for one reader's feed. {_GOALS[key]}\n"
        f"Answer language: {LANGUAGE_MARK}\n"
        "Use 6 to 12 words each in English, 25 to 70 characters each in Thai, "
        "and no punctuation.\n"
        "Reply with one JSON object holding output_language and a list named queries; "
        "each entry has query_id, query_text, weight and intent_label.\n"
        f"Slots:\n{slots}\n"
        f"Profile:\n{CONTEXT_MARK}\n"
    )
    if key in _WITH_HISTORY:
        text += f"Activity:\n{HISTORY_MARK}\n"
    return text


TEMPLATES = {key: _template(key) for key in SLOT_PLANS}


@dataclass(frozen=True)
class JobParams:
    """Typed parameters of a run; out-of-range numbers are clamped."""

    history_threshold: int = 20
    legacy_history_threshold: int = 5
    recent_k: int = 5
    feed_text_max_chars: int = 240
    include_recent: bool = True
    window_days: int = 30
    top_themes: int = 4
    timezone: str = "UTC"
    model_name: str = "offline-template"
    embedding_model: str = "offline-hashing"
    max_output_tokens: int = 2048
    temperature: float = 0.2
    slow_s: float = SLOW_CALL_S
    output_dim: int = 768
    retry_limit: int = 2
    answer_field: str = "queries"
    # Most events of one user kept inside that user's bundle; users with more
    # keep all of theirs as rows of the side table (operators.bundle).
    inline_events: int = 500
    # Tasks that may call the model at once; None leaves it to the scan.
    model_tasks: int | None = None
    llm_rates: dict[str, tuple[float, float]] = field(default_factory=dict)
    embedding_rates: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        def clamp(name: str, low: int, high: int | None = None) -> None:
            value = max(low, getattr(self, name))
            object.__setattr__(self, name, value if high is None else min(value, high))

        clamp("history_threshold", 1)
        clamp("legacy_history_threshold", 1)
        clamp("recent_k", 0, 10)
        clamp("feed_text_max_chars", 0, 2000)
        clamp("retry_limit", 0)
        clamp("inline_events", 1, 999)  # one more is ranked; Spark limits early up to 1000
        if self.output_dim <= 0:
            raise ValueError(f"output_dim must be positive, got {self.output_dim}")
