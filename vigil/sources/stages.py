"""Stages of a run with a record of their flow: rows in and out, time and status, counted while they run."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from vigil.sources.storage import read, there, write

#: number: of the attempt, from 1.
STAGE = "run_id string, stage string, number int, status string, milliseconds long, input_rows long, output_rows long, error string"


def rows() -> Column:
    return F.count(F.lit(1)).alias("rows")


def stage_log(spark: SparkSession, log: str) -> DataFrame:
    """All attempts of all stages."""
    return read(spark, log, STAGE) if there(spark, log) else spark.createDataFrame([], STAGE)


def stage_metrics(spark: SparkSession, log: str) -> DataFrame:
    """One row for each run and stage, of its last attempt."""
    last = Window.partitionBy("run_id", "stage").orderBy(F.desc("number"))
    return stage_log(spark, log).withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")


def run_stage(log: str, run_id: str, stage: str, inputs: Sequence[DataFrame], work: Callable[..., DataFrame], target: str, partitions: Sequence[str] = (), known_rows: int | None = None) -> DataFrame:
    """work(*inputs) written to target and read again; what it took goes to the log, also where it fails, and the error is raised.

    Rows of inputs and output are observed on their way, so nothing is read twice.
    known_rows: of all inputs, as an earlier stage's record has them; that is what a
    stage that fails is told to have read, null without. An input that the plan need
    not read counts as 0.
    """
    spark = inputs[0].sparkSession
    read_, made, began = [Observation() for _ in inputs], Observation(), time.perf_counter()

    def record(status: str, input_rows: int | None, output_rows: int, error: str | None = None) -> None:
        number = stage_log(spark, log).filter((F.col("run_id") == run_id) & (F.col("stage") == stage)).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
        row = (run_id, stage, number, status, round((time.perf_counter() - began) * 1000), input_rows, output_rows, error)
        write(spark.createDataFrame([row], STAGE).coalesce(1), log, mode="append")

    try:
        out = work(*(df.observe(o, rows()) for df, o in zip(inputs, read_, strict=True)))
        write(out.observe(made, rows()), target, partitions, mode="overwrite")  # what a failed attempt left
    except Exception as error:
        record("failed", known_rows, 0, str(error).split("\n", 1)[0][:500])
        raise
    record("success", sum(o.get.get("rows", 0) for o in read_), made.get["rows"])
    return read(spark, target, out.schema)
