"""Costs, call ledger, slow calls and the run report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from intentloom.functions.text import col, run_name
from intentloom.params import (
    EMBEDDING_RATE_PER_1K_CHARS,
    LLM_RATE_IN_PER_1K,
    LLM_RATE_OUT_PER_1K,
    SLOW_CALL_S,
)


def _rate(model: Column, rates: Mapping[str, float], default: float) -> Column:
    """A model's rate; the rates are part of the job's parameters."""
    out = F.lit(default)
    for name, rate in sorted(rates.items()):
        out = F.when(model == name, F.lit(rate)).otherwise(out)
    return out


def llm_cost_usd(
    input_tokens: Column | str,
    output_tokens: Column | str,
    model: Column | str,
    rates: Mapping[str, tuple[float, float]] = {},
) -> Column:
    def part(tokens: Column | str, place: int, default: float) -> Column:
        rate = _rate(col(model), {m: r[place] for m, r in rates.items()}, default)
        return F.coalesce(col(tokens), F.lit(0)) / F.lit(1000.0) * rate

    return part(input_tokens, 0, LLM_RATE_IN_PER_1K) + part(output_tokens, 1, LLM_RATE_OUT_PER_1K)


def embedding_cost_usd(
    chars: Column, model: Column | str, rates: Mapping[str, float] = {}
) -> Column:
    return chars / F.lit(1000.0) * _rate(col(model), rates, EMBEDDING_RATE_PER_1K_CHARS)


def token_usage(usage: Column | str, field: str) -> Column:
    """Token count from usage JSON; unreadable or missing is null."""
    return F.get_json_object(col(usage), f"$.{field}").try_cast("bigint")


def llm_cost(calls: DataFrame, rates: Mapping[str, tuple[float, float]] = {}) -> DataFrame:
    """Calls, tokens and cost per model. Costs are summed per token, not per call,
    so that the sum does not depend on the order of rows."""
    totals = calls.groupBy("model_name").agg(
        F.count("*").alias("n_calls"),
        F.sum(F.coalesce("input_tokens", F.lit(0))).alias("input_tokens"),
        F.sum(F.coalesce("output_tokens", F.lit(0))).alias("output_tokens"),
    )
    return totals.withColumn(
        "estimated_cost_usd", llm_cost_usd("input_tokens", "output_tokens", "model_name", rates)
    )


def embedding_cost(
    texts: DataFrame, key: str, rates: Mapping[str, float] = {}
) -> DataFrame:
    """Texts, characters and cost per key and model; a null text counts no characters."""
    totals = texts.groupBy(key, "model_name").agg(
        F.count("*").alias("num_texts"),
        F.sum(F.length(F.coalesce("text", F.lit("")))).alias("total_chars"),
    )
    return totals.withColumn(
        "estimated_cost_usd", embedding_cost_usd(F.col("total_chars"), "model_name", rates)
    )


def ledger_union(*records: DataFrame) -> DataFrame:
    """Rows of all ledgers; columns a ledger lacks are null."""
    out = records[0]
    for more in records[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def stage_times(records: DataFrame, stages: Sequence[str], logged_at: datetime) -> DataFrame:
    """One row per user of the timing ledger: milliseconds of each stage as text, their sum and the time of logging.

    ``records``: user_id, stage, seconds, error; a stage may have several, which add up. A stage that failed,
    was not reached or has no finite time is ``-``; ``total_ms`` sums the others. Rows without a user are one user's.
    """
    known = F.when(F.col("error").isNull() & ~F.isnan("seconds"), F.col("seconds") * 1000)

    def at(stage: str) -> Column:
        here = F.col("stage") == stage
        bad = F.count_if(here & known.isNull()) + F.when(F.count_if(here) == 0, 1).otherwise(0)
        return F.when(bad == 0, F.sum(F.when(here, known)))

    ms = records.groupBy("user_id").agg(*[at(s).alias(s) for s in stages])
    total = sum((F.coalesce(s, F.lit(0.0)) for s in stages), F.lit(0.0))
    moment = F.lit(logged_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    shown = [F.coalesce(F.round(s).cast("bigint").cast("string"), F.lit("-")).alias(s) for s in stages]
    return ms.select("user_id", *shown, F.round(total).cast("bigint").alias("total_ms"), moment.alias("logged_at"))


def slow_calls(calls: DataFrame, limit_s: float = SLOW_CALL_S) -> DataFrame:
    return calls.where((F.col("latency_s") > limit_s) & ~F.isnan("latency_s"))


def run_report(statuses: DataFrame, generated_at: datetime, total_time_sec: float) -> DataFrame:
    """Run counters as one row. Slow users count as updated; only failures do not.

    The per-user lists of a run (all, failed, slow) stay tables, see
    ``intentloom.sources.sinks.write_report``.
    """
    moment = F.lit(generated_at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    failed = F.count_if(F.col("status") != "Complete")
    return statuses.agg(
        F.count("*").alias("total_users"),
        (F.count("*") - failed).alias("updated_count"),
        failed.alias("failed_count"),
        F.count_if("slow").alias("slow_count"),
    ).select(
        F.concat(F.lit("report_"), run_name(moment)).alias("run_name"),
        F.date_format(F.from_utc_timestamp(moment, "+07:00"), "yyyy-MM-dd'T'HH:mm:ss'+07:00'").alias(
            "generated_at"
        ),
        "total_users",
        "updated_count",
        "failed_count",
        "slow_count",
        F.lit(round(total_time_sec, 2)).alias("total_time_sec"),
    )
