"""Answers kept between runs: a table by content, so that no prompt is paid for twice.

An answer's key is the hash of its prompt, its template's name, the model and its settings. A run calls the model once for each
key that the table lacks, however many users share the prompt, and in waves: each wave is appended
before the next one is called, and before anything is embedded. A run that dies goes on after its
last wave. Only readable answers are kept, so failures are asked again by the next run.

The table has columns key, raw, run, saved_at and is only appended to. Two runs at a time may store one key twice;
readers take one of them, always the same.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from intentloom.operators.answers import resolve_answers
from intentloom.operators.models import CALLS, Factory, generate_answers, materialize
from intentloom.params import JobParams

SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("raw", T.StringType()), T.StructField("run", T.StringType()),
     T.StructField("saved_at", T.TimestampNTZType())]
)


@dataclass(frozen=True)
class AnswerStore:
    """Where answers are kept; ``run`` and ``now`` name this run's rows, and a wave has about ``wave_rows`` prompts."""

    path: str
    run: str
    now: datetime
    wave_rows: int = 1_000_000

    def read(self, spark: SparkSession) -> DataFrame:
        """(key, raw): one answer of each key."""
        # an empty frame first, as the path need not exist before the first answer
        spark.createDataFrame([], SCHEMA).write.mode("append").parquet(self.path)
        rows = spark.read.schema(SCHEMA).parquet(self.path)
        return rows.groupBy("key").agg(F.min(F.struct("saved_at", "run", "raw")).alias("a")).select("key", "a.raw")

    def append(self, answers: DataFrame) -> None:
        moment = F.lit(self.now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
        answers.select("key", "raw", F.lit(self.run).alias("run"), moment.alias("saved_at")).write.mode("append").parquet(self.path)


def answer_key(params: JobParams, prompt: str = "prompt", template: str | None = None) -> Column:
    """Hash of all that an answer depends on; null without a prompt. Lengths keep neighbouring parts apart."""
    parts = [
        F.lit(f"{params.model_name}\n{params.max_output_tokens}\n{params.temperature}\n{params.answer_field}"),
        F.lit("") if template is None else F.coalesce(template, F.lit("")),
        F.col(prompt),
    ]
    text = F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)])
    return F.sha2(text, 256)


def stored_answers(prompts: DataFrame, factory: Factory, params: JobParams, store: AnswerStore, template: str | None = None) -> DataFrame:
    """As :func:`generate_answers`, through the store: adds ``raw``, ``call_error``, ``calls`` and ``reused``.

    ``prompts`` has user_id, prompt and any other columns; ``template`` names one of them. The calls of a shared prompt are listed with its
    smallest user, so that sums over ``calls`` are what was paid. ``reused`` says that the answer was there before.
    """
    spark = prompts.sparkSession
    asked = materialize(prompts.withColumn("_key", answer_key(params, template=template)))
    keyed = asked.where("_key is not null")
    before = materialize(store.read(spark).join(keyed.select(F.col("_key").alias("key")).distinct(), "key", "left_semi"))
    todo = keyed.groupBy("_key").agg(F.min("prompt").alias("prompt"), F.min("user_id").alias("payer")).withColumnRenamed("_key", "key")
    todo = materialize(todo.join(before, "key", "left_anti"))
    waves = math.ceil(todo.count() / store.wave_rows)  # none if all is known: then the model isn't even started
    empty = F.array().cast(CALLS)
    answers = before.select(
        "key", "raw", F.lit(None).cast("string").alias("call_error"), empty.alias("calls"),
        F.lit(None).cast("string").alias("payer"), F.lit(True).alias("reused"),
    )
    for wave in range(waves):
        now = todo.where(F.pmod(F.xxhash64("key"), F.lit(waves)) == wave)
        told = materialize(generate_answers(now, factory, params).drop("prompt"))
        readable = resolve_answers(told.where("call_error is null and raw is not null"), text="raw").where("answer is not null")
        store.append(readable)
        answers = answers.unionByName(told.withColumn("reused", F.lit(False)))
    joined = keyed.join(answers.withColumnRenamed("key", "_key"), "_key", "left")
    mine = F.when(F.col("payer") == F.col("user_id"), F.col("calls")).otherwise(empty)
    out = joined.select(*prompts.columns, "raw", "call_error", mine.alias("calls"), "reused")
    # rows without a prompt stay out of the join, where their null keys would meet in one task
    without = asked.where("_key is null").select(
        *prompts.columns, F.lit(None).cast("string").alias("raw"), F.lit(None).cast("string").alias("call_error"),
        empty.alias("calls"), F.lit(False).alias("reused"),
    )
    return out.unionByName(without)
