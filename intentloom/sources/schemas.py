"""Canonical tables and one early check per job."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
TS, F32 = T.TimestampNTZType(), T.FloatType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


USERS = _struct(
    user_id=S, preferred_language=S, current_status=S, student_year=S, faculty_name=S,
    curriculum_name=S, university_name=S, target_roles=S, skill=S, interests=S,
    onboard_grp=S, onboard_grp_description=S,
)
EVENTS = _struct(user_id=S, item_id=S, ts=TS, event_type=S, dwell_ms=L)
ITEMS = _struct(
    post_id=S, post_status=S, is_valid=B, post_created_at=TS, post_topic=S,
    post_content_body=S, post_tags=S, post_target_group=S, post_category=S,
    num_click=L, num_like=L, num_comment=L, num_share=L, num_bookmark=L,
)
LAST20 = _struct(
    user_id=S, recent_post_interaction=S, recent_tag_interaction=S,
    recent_category_interaction=S, recent_keyword_search=S,
)
QUERY = _struct(query_id=S, query_text=S, weight=D, intent_label=S)
ARTEFACTS = _struct(user_id=S, kind=S, name=S, text=S, vector=T.ArrayType(F32))
LEDGER = _struct(
    event_type=S, user_id=S, model_name=S, input_tokens=L, output_tokens=L,
    num_texts=L, total_chars=L, latency_s=D, estimated_cost_usd=D, logged_at=TS,
)


def require_columns(df: DataFrame, schema: T.StructType, what: str) -> DataFrame:
    """Fail at planning time, naming all missing or mistyped columns at once."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name} ({'missing' if f.name not in have else have[f.name].simpleString()},"
        f" expected {f.dataType.simpleString()})"
        for f in schema.fields
        if have.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError(f"{what}: {'; '.join(wrong)}")
    return df
