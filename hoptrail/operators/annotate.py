"""A text model's guess at the cause of each stuck trace."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail import schemas, wire

Model = Callable[[list[str]], list[str]]

# Tasks that ask the model at the same time.
PARALLELISM = 64


def prompt() -> Column:
    """The facts of one alert in one line; null if any of them is unknown."""
    parts = []
    for label, name in wire.PROMPT_FACTS.items():
        parts += [F.lit(f" {label}=" if parts else f"{label}="), F.col(name).cast("string")]
    return F.concat(*parts)


def prompts(alerts: DataFrame) -> DataFrame:
    return alerts.select("trace_id", "pipeline", "last_service", "last_topic", "stuck_for_ms", prompt().alias("prompt"))


def answers(alerts: DataFrame, open_model: Callable[[], Model], parallelism: int = PARALLELISM) -> DataFrame:
    """One model call per alert, as answered. ``open_model`` runs once per task and
    returns a function from a batch of prompts to as many answers; an alert without a
    prompt keeps a null answer. The alerts are few and small, so they are dealt to
    ``parallelism`` tasks, which bound the calls made at the same time. Works on
    static and streaming alerts."""

    def annotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = open_model()
        for batch in batches:
            asked = batch["prompt"].notna()
            found = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            if asked.any():
                found[asked] = model(batch.loc[asked, "prompt"].tolist())
            yield batch.drop(columns="prompt").assign(root_cause=found)

    dealt = prompts(alerts).repartition(parallelism, "trace_id")
    return dealt.mapInPandas(annotate, schemas.REPORTS["trace_rca_1m"])


# How long one alert may keep its task: attempts, and seconds before the second one,
# doubled each time.
ATTEMPTS, FIRST_WAIT = 3, 1.0
ASKED_AT_ONCE = 16
TRIED = "root_cause string, failure string"


def patiently(model: Model, asked: list[str], attempts: int, first_wait: float) -> tuple[list, str | None]:
    """Answers, or none and the last error after so many attempts."""
    for attempt in range(attempts):
        try:
            found = model(asked)
            if len(found) != len(asked):
                raise ValueError(f"{len(found)} answers to {len(asked)} prompts")
            return list(found), None
        except Exception as error:  # whatever a model client raises
            failure = f"{type(error).__name__}: {error}"
            if attempt + 1 < attempts:
                time.sleep(first_wait * 2**attempt)
    return [None] * len(asked), failure


def tried(
    alerts: DataFrame,
    open_model: Callable[[], Model],
    parallelism: int = PARALLELISM,
    attempts: int = ATTEMPTS,
    first_wait: float = FIRST_WAIT,
    at_once: int = ASKED_AT_ONCE,
) -> DataFrame:
    """Every alert with its ``root_cause`` or, if the model failed for it again and
    again, the ``failure``; the job goes on. Alerts with the same prompt meet in one
    task, and a batch asks each prompt once, ``at_once`` of them together; a group
    that fails is asked again one by one, so one bad prompt fails alone."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in alerts.schema)

    def annotate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = open_model()
        for batch in batches:
            answer, failure = {}, {}
            waiting = batch["_prompt"].dropna().unique().tolist()
            for first in range(0, len(waiting), at_once):
                part = waiting[first : first + at_once]
                found, error = patiently(model, part, attempts, first_wait)
                for prompt, one in zip(part, found):
                    if error is not None and len(part) > 1:
                        (one,), failure[prompt] = patiently(model, [prompt], attempts, first_wait)
                    elif error is not None:
                        failure[prompt] = error
                    answer[prompt] = one
            yield batch.drop(columns="_prompt").assign(
                root_cause=batch["_prompt"].map(answer).astype(object).where(batch["_prompt"].notna(), None),
                failure=batch["_prompt"].map(failure).astype(object).where(batch["_prompt"].notna(), None),
            )

    dealt = alerts.withColumn("_prompt", prompt()).repartition(parallelism, F.coalesce("_prompt", "trace_id"))
    return dealt.mapInPandas(annotate, f"{schema}, {TRIED}")


def answered(rows: DataFrame) -> DataFrame:
    """The report of the alerts that were tried without a failure."""
    columns = schemas.REPORTS["trace_rca_1m"].names
    return rows.where("failure is null").withColumn(
        "root_cause", F.when(acceptable(), F.col("root_cause"))
    ).select(columns)


def failed(rows: DataFrame) -> DataFrame:
    """The alerts still without an answer, as alerts, with what went wrong."""
    return rows.where("failure is not null").drop("root_cause")


def root_causes(alerts: DataFrame, open_model: Callable[[], Model], parallelism: int = PARALLELISM) -> DataFrame:
    """The answers that keep to the requested form; the others become null."""
    return answers(alerts, open_model, parallelism).withColumn(
        "root_cause", F.when(acceptable(), F.col("root_cause"))
    )


def answer_counts(answered: DataFrame) -> DataFrame:
    """Per pipeline: alerts, answers, and answers that break the form."""
    return answered.groupBy("pipeline").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.count("root_cause").alias("answers"),
        F.count_if(~acceptable()).alias("rejected"),
    )


def acceptable(answer: str = "root_cause") -> Column:
    """Whether an answer keeps to the requested form."""
    sentences = F.size(F.filter(F.split(answer, r"[.!?](?:\s+|$)"), lambda s: F.trim(s) != ""))
    return (F.length(answer) < wire.MAX_ANSWER) & (sentences == 2)
