from __future__ import annotations

from pyspark.sql import functions as F

from hoptrail import schemas
from hoptrail.operators import annotate

ALERT = ("id", "intake", "orders", "svc", "topic", 2, 10, 60_000)


def alerts(spark, *rows):
    return spark.createDataFrame(rows, schemas.REPORTS["stuck_trace_alerts_1m"])


def test_prompt(spark):
    row = annotate.prompts(alerts(spark, ALERT)).first()
    assert row.prompt == "pipeline=orders trace_id=id last_service=svc last_topic=topic hop_count=2 idle_ms=60000"


def test_model_is_asked_once_per_known_alert(spark):
    unknown = ALERT[:2] + (None,) + ALERT[3:]

    def open_model():
        return lambda asked: [f"Asked in {len(p)} characters. Look there." for p in asked]

    frame = alerts(spark, ALERT, unknown).coalesce(1)
    result = annotate.root_causes(frame, open_model)
    schemas.conform(result, schemas.REPORTS["trace_rca_1m"])
    assert sorted(r.root_cause is None for r in result.collect()) == [False, True]


def test_answers_that_break_the_form_are_dropped_and_counted(spark):
    def open_model():
        return lambda asked: ["Only one."] * len(asked)

    frame = alerts(spark, ALERT)
    assert annotate.root_causes(frame, open_model).first().root_cause is None
    counts = annotate.answer_counts(annotate.answers(frame, open_model)).first()
    assert (counts.alerts, counts.answers, counts.rejected) == (1, 1, 1)


def test_calls_are_dealt_to_many_tasks(spark):
    rows = [(f"id{i}", *ALERT[1:]) for i in range(200)]
    asked = annotate.answers(alerts(spark, *rows), lambda: lambda p: ["A. B."] * len(p), parallelism=16)
    assert asked.rdd.getNumPartitions() == 16


def test_acceptable(spark):
    answers = ["One. Two.", "Only one.", "A. B. C.", "x" * 400 + ". Two.", "It hit v1.2 limits. Restart it."]
    df = spark.createDataFrame([(a,) for a in answers], "root_cause string")
    assert [r.ok for r in df.select(annotate.acceptable().alias("ok")).collect()] == [True, False, False, False, True]
    assert df.where(annotate.acceptable()).select(F.length("root_cause")).count() == 2
