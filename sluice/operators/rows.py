"""Rows of the control tables (B1, B2, K5, K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sluice import messages as M
from sluice import schemas as S
from sluice.functions.text import is_blank, message, text_or_null, to_bool
from sluice.operators.rules import is_provisioning, normalise_enums
from sluice.operators.skew import never_broadcast
from sluice.operators.watermarks import watermark_maps

BLOCK = 100_000


def config_rows(
    params: DataFrame, names: DataFrame, resolved: DataFrame, watermarks: DataFrame
) -> DataFrame:
    """B1: the 20 typed columns of the dataset table.

    ``names`` is (dataset_id, dataset_name), ``resolved`` is (dataset_id, resolved) of J4 and
    ``watermarks`` the rows of A1. A provisioning dataset has no load settings. A missing
    'Is Enabled' is stored as true. All sides are as long as the datasets are many, so none is broadcast.
    """
    p = normalise_enums(params)
    named = names.select("dataset_id", text_or_null("dataset_name").alias("__name"))
    joined = (
        p.join(never_broadcast(named), "dataset_id", "left")
        .join(never_broadcast(resolved.select("dataset_id", "resolved")), "dataset_id", "left")
        .join(never_broadcast(watermark_maps(watermarks)), ["dataset_id", "stage"], "left")
    )
    active = ~is_provisioning("stage")

    def given(c: str) -> Column:
        return text_or_null(c)

    def loading(c: Column) -> Column:
        return F.when(active, c)

    # The columns in table order.
    columns = {
        "dataset_id": F.col("dataset_id"),
        "dataset_name": F.coalesce("__name", "dataset_id"),
        "source_database_name": given("database_name"),
        "load_type": loading(F.col("load_type")),
        "is_enabled": F.when(is_blank("is_enabled"), F.lit(True)).otherwise(to_bool("is_enabled")),
        "pet_dataset_id": given("pet_dataset_id"),
        "incremental_timestamp_method": loading(F.col("incremental_timestamp_method")),
        "incremental_timestamp_field": loading(F.coalesce("resolved", given("incremental_timestamp_field"))),
        "incremental_header_to_tables_link_field": loading(given("incremental_header_to_tables_link_field")),
        "schedule": loading(given("schedule")),
        "week_days": loading(given("week_days")),
        "dates_of_month": loading(given("dates_of_month")),
        "dataset_owner": given("dataset_owner"),
        "modified_date": F.current_timestamp(),
        "dataset_modified_by_user": F.current_user(),
        "last_run_time": F.lit(None),
        "next_run_due_time": F.lit(None),
        "last_process_datetime": F.coalesce("last_process_datetime", F.create_map()),
        "stage": F.col("stage"),
        "comments": given("comments") if "comments" in params.columns else F.lit(None),
    }
    return joined.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in S.DATASET_CONFIG.fields]
    )


def input_field_rows(fields: DataFrame, stages: DataFrame) -> DataFrame:
    """B2: rows of the field table without their id; ``row_no`` carries the sheet order."""
    return fields.join(stages.select("dataset_id", "stage"), "dataset_id").select(
        "dataset_id", "database_name", "table_name", F.col("column_name").alias("field_name"),
        "stage", F.lit(None).cast("string").alias("comments"), "row_no",
    )


def assign_field_ids(rows: DataFrame, max_id: int | Column = 0, block: int = BLOCK) -> DataFrame:
    """K5: adds field_id 1, 2, 3, ... after ``max_id``: sheet order within a dataset.

    Datasets follow one another by a hash prefix of their id, then the id. No row is ever sorted
    with all others: a row's number is its place in a block of at most ``block`` row numbers, plus
    the rows of earlier blocks, plus the rows of earlier hash groups. So one huge dataset spreads
    over many tasks.
    """
    # Keys that are never NULL add no filter of their own below the joins, so both uses of the
    # counts share one scan and one shuffle.
    owner = F.coalesce("dataset_id", F.lit(""))
    at = rows.withColumns(
        {
            "__group": F.coalesce(F.substring(F.md5(owner), 1, 3), F.lit("")),
            "__owner": owner,
            "__block": F.coalesce(F.floor(F.col("row_no") / F.lit(block)).cast("long"), F.lit(0)),
        }
    )
    keys = ["__group", "__owner", "__block"]
    counts = at.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    groups = counts.groupBy("__group").agg(F.sum("__n").alias("__n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # At most 4096 groups exist, so this window without a partition stays that small.
    group_start = groups.select(
        "__group", F.coalesce(F.sum("__n").over(before.orderBy("__group")), F.lit(0)).alias("__group_start")
    )
    block_start = counts.select(
        *keys,
        F.coalesce(
            F.sum("__n").over(before.partitionBy("__group").orderBy("__owner", "__block")), F.lit(0)
        ).alias("__block_start"),
    )
    starts = block_start.join(group_start, "__group").select(
        *keys, (F.col("__block_start") + F.col("__group_start")).alias("__start")
    )
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("row_no"))
    base = F.lit(max_id) if isinstance(max_id, int) else max_id
    numbered = at.withColumn("__place", place).join(starts, keys)
    field_id = (base + F.col("__start") + F.col("__place")).cast("long")
    return numbered.select(field_id.alias("field_id"), *rows.columns)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """K6: the columns of ``schema`` in order and type; others are dropped, absent ones are NULL."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """K6: one violation row per NULL in a required column."""
    nulls = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    row_no = F.col("row_no") if "row_no" in df.columns else F.lit(0)
    return df.select("dataset_id", row_no.alias("row_no"), F.explode(nulls).alias("column")).select(
        "dataset_id",
        F.lit(80).cast("int").alias("rule_no"),
        F.col("row_no").cast("long").alias("row_no"),
        F.lit("not_null").alias("rule"),
        message(M.NULL_REQUIRED, column=F.col("column")).alias("message"),
    )
