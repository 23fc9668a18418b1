"""Run logs: one process row per run, one overview row per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.operators.rows import conform


def process_context(config: DataFrame) -> DataFrame:
    """(dataset_id, source_database_name, load_type, last_process_timestamp) of configured datasets.

    Logs have no stage: of several stages the first in text order gives the database and the load type. The
    timestamp is the latest watermark of all of them.
    """
    latest = F.array_max(F.map_values("last_process_datetime"))
    stage = F.coalesce("stage", F.lit(""))
    return config.groupBy("dataset_id").agg(
        F.min_by("source_database_name", stage).alias("source_database_name"),
        F.min_by("load_type", stage).alias("load_type"),
        F.max(latest).alias("last_process_timestamp"),
    )


def process_rollup(events: DataFrame, config: DataFrame | None = None) -> DataFrame:
    """Event rows to process rows.

    The tables name these columns but nothing defines how they follow from the events; the rule is
    ours: least start, greatest end, FAILED when any event failed, sum of the record counts, run
    time in whole seconds, and the message of the earliest failed event. A process belongs to one
    dataset. ``config`` gives the database, the load type and the last timestamp of each dataset; without it they are NULL.
    """
    failed = F.col("event_status") == "FAILED"
    start, end = F.col("event_start_datetime").cast("timestamp"), F.col("event_end_datetime").cast("timestamp")
    rolled = events.groupBy("process_load_id", "dataset_id").agg(
        F.min(start).alias("start_timestamp"),
        F.max(end).alias("end_timestamp"),
        F.max(failed).alias("any_failed"),
        F.sum("record_count").alias("record_count"),
        F.min_by(
            F.when(failed, F.col("event_message")),
            F.when(failed, F.struct("event_start_datetime", "event_load_id")),
        ).alias("error_message"),
    )
    if config is not None:
        rolled = rolled.join(process_context(config), "dataset_id", "left")
    seconds = F.expr("(unix_micros(end_timestamp) - unix_micros(start_timestamp)) DIV 1000000")
    return conform(
        rolled.withColumns(
            {
                "status": F.when(F.col("any_failed"), "FAILED").otherwise("SUCCESS"),
                "job_run_duration": seconds.cast("string"),
            }
        ),
        S.PROCESS_LOG,
    )


def dataset_overview(config: DataFrame, fields: DataFrame, process: DataFrame, event: DataFrame) -> DataFrame:
    """Fields, runs, failed runs and events per configured dataset.

    Each side is counted before it is joined, so no side multiplies another.
    """
    def counted(df: DataFrame, **counts) -> DataFrame:
        return df.groupBy("dataset_id").agg(*[c.alias(n) for n, c in counts.items()])

    one = F.count(F.lit(1))
    sides = [
        counted(fields, n_fields=one),
        counted(process, n_runs=one, n_failed_runs=F.count_if(F.col("status") == "FAILED")),
        counted(event, n_events=one),
    ]
    out = config.select("dataset_id").distinct()
    for side in sides:
        out = out.join(side, "dataset_id", "left")
    names = ["n_fields", "n_runs", "n_failed_runs", "n_events"]
    return out.select("dataset_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names])
