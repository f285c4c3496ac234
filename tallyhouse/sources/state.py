"""Watermark state and the run log, both append-only Parquet logs."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.loads import last_write

STATE_SCHEMA = "site_code string, entity string, watermark timestamp, updated_at timestamp"
RUN_SCHEMA = (
    "run_id string, pipeline_name string, site_code string, start_ts timestamp, end_ts timestamp, "
    "status string, rows_out bigint, error_text string, logged_at timestamp"
)


def advance_watermark(marks: DataFrame, path: str, entity: str) -> None:
    """Append the watermarks of one finished load; call it after the data write.

    ``marks`` comes from ``next_watermark``: an empty batch has no row and moves
    nothing.
    """
    rows = marks.select(
        "site_code", F.lit(entity).alias("entity"), "watermark", F.current_timestamp().alias("updated_at")
    )
    rows.write.mode("append").parquet(path)


def read_watermarks(spark: SparkSession, path: str) -> DataFrame:
    log = spark.read.schema(STATE_SCHEMA).parquet(path)
    return last_write(log, ["site_code", "entity"], F.col("updated_at"))


def compact_watermarks(spark: SparkSession, path: str, target: str) -> None:
    """The newest mark per site and entity, into a new log folder."""
    read_watermarks(spark, path).write.mode("overwrite").parquet(target)


def log_run(
    spark: SparkSession, path: str, run_id: str, pipeline: str, site: str, status: str,
    rows: int | None = None, error: str | None = None,
) -> None:
    """Append one state of a run: ``running``, ``success`` or ``failed``."""
    now = F.current_timestamp()
    finished = status != "running"
    row = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(site).alias("site_code"),
        (F.lit(None) if finished else now).cast("timestamp").alias("start_ts"),
        (now if finished else F.lit(None)).cast("timestamp").alias("end_ts"),
        F.lit(status).alias("status"),
        F.lit(rows).cast("bigint").alias("rows_out"),
        F.lit(error).cast("string").alias("error_text"),
        now.alias("logged_at"),
    )
    row.write.mode("append").parquet(path)


def log_runs(runs: DataFrame, path: str) -> None:
    """Append a state of many runs at once: ``run_id``, ``pipeline_name``, ``site_code``,
    ``status``, ``rows_out``, ``error_text``."""
    now, finished = F.current_timestamp(), F.col("status") != "running"
    runs.select(
        "run_id", "pipeline_name", "site_code",
        F.when(~finished, now).alias("start_ts"), F.when(finished, now).alias("end_ts"),
        "status", F.col("rows_out").cast("bigint").alias("rows_out"), F.col("error_text").cast("string").alias("error_text"),
        now.alias("logged_at"),
    ).write.mode("append").parquet(path)


@contextmanager
def logged_run(spark: SparkSession, path: str, pipeline: str, site: str):
    """Log the start, then success or failure; a failure is raised again."""
    run = {"run_id": str(uuid.uuid4()), "rows": 0}
    log_run(spark, path, run["run_id"], pipeline, site, "running")
    try:
        yield run
    except Exception as error:
        log_run(spark, path, run["run_id"], pipeline, site, "failed", run["rows"], repr(error))
        raise
    log_run(spark, path, run["run_id"], pipeline, site, "success", run["rows"])


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per run with its last state."""
    log = spark.read.schema(RUN_SCHEMA).parquet(path)
    late = F.struct(F.col("logged_at"), F.col("status") != "running")
    return log.groupBy("run_id").agg(
        F.max("pipeline_name").alias("pipeline_name"),
        F.max("site_code").alias("site_code"),
        F.min("start_ts").alias("start_ts"),
        F.max("end_ts").alias("end_ts"),
        F.max_by("status", late).alias("status"),
        F.max_by("rows_out", late).alias("rows_out"),
        F.max_by("error_text", late).alias("error_text"),
    )
