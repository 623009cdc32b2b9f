"""Answers that survive from batch to batch.

The log gets one row per batch that had a reading. The answer is the top row
of the log, so it is right in whatever order batches are written, and day,
temperature and region can never come from different batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.operators.extremes import top_reading
from obslake.operators.measure import Measure
from obslake.plans.lake import Lake, Load, write_load
from obslake.schema import QUESTION_DATE, QUESTION_REGION, QUESTION_TEMPERATURE


def record_answers(spark: SparkSession, lake: Lake, rows: DataFrame, load: Load) -> None:
    """Put the hottest of a load's rows into the log, as the load's only entry.

    A load without any reading adds nothing.
    """
    measure = Measure()
    hottest = top_reading(rows, measure).select(
        F.lit(load.batch_id).alias("batch_id"),
        F.col(measure.value).alias("temperature"),
        F.col(measure.when).alias("observed_at"),
        F.col(measure.place).alias("region"),
        F.col(measure.country).alias("country"),
    )
    write_load(spark, lake, "answer_log", hottest, load)


def answers_sql(log: str, initial: float | None = 0.0) -> str:
    """The three questions and their answers, from the top row of a log table.

    Among equal temperatures the earlier load keeps the answer. A temperature
    must be above ``initial`` to be one; None lets any count.
    """
    counts = "temperature IS NOT NULL" if initial is None else f"temperature > {initial!r}D"
    return f"""
        SELECT inline(array(
            named_struct('question', '{QUESTION_DATE}', 'answer',
                         date_format(observed_at, 'yyyy-MM-dd')),
            named_struct('question', '{QUESTION_TEMPERATURE}', 'answer',
                         printf('%.2f', temperature)),
            named_struct('question', '{QUESTION_REGION}', 'answer', region)
        ))
        FROM (
            SELECT * FROM {log} WHERE {counts}
            ORDER BY temperature DESC, load_dt, batch_id,
                     observed_at NULLS LAST, region NULLS LAST
            LIMIT 1
        )
    """


def current_answers(log: DataFrame, initial: float | None = 0.0) -> DataFrame:
    """``answers_sql`` over a log; no rows if there is no answer yet."""
    return log.sparkSession.sql(answers_sql("{log}", initial), log=log)


def publish_answers(spark: SparkSession, lake: Lake, initial: float | None = 0.0) -> None:
    """Put the answers into the catalog as the view ``answers``, always up to date."""
    log = answers_sql(lake.table("answer_log"), initial)
    spark.sql(f"CREATE OR REPLACE VIEW {lake.table('answers')} AS {log}")


def answer_or_default(answers: DataFrame, question: str, default: str) -> DataFrame:
    """One row: the answer to one question, or the default if it has none.

    A failing read fails; it is not taken for a missing answer.
    """
    answer = F.max(F.when(F.col("question") == question, F.col("answer")))
    return answers.agg(F.coalesce(answer, F.lit(default)).alias("answer"))
