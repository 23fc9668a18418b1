"""Watermarks per (dataset, stage, source table): seed, merge, advance.

Watermarks travel as rows (dataset_id, stage, table_name, last_ts). The MAP column of the control
table is made at the very end by `watermark_maps`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import messages as M
from sluice.functions.stamps import parse_start_date
from sluice.functions.text import message
from sluice.operators.rules import is_active, is_incremental, normalise_enums, violations
from sluice.operators.skew import existence_join, never_broadcast

KEYS = ("dataset_id", "stage", "table_name")


def watermark_rows(config: DataFrame) -> DataFrame:
    """Explode `last_process_datetime`; a NULL map has no rows."""
    return config.select(
        "dataset_id", "stage", F.explode("last_process_datetime").alias("table_name", "last_ts")
    )


def watermark_maps(rows: DataFrame) -> DataFrame:
    """(dataset_id, stage, last_process_datetime): the MAP value the control table stores.

    Its size is the number of source tables of one dataset, all of them tables of the catalog.
    """
    entries = F.sort_array(F.collect_list(F.struct(F.col("table_name").alias("key"), F.col("last_ts").alias("value"))))
    return rows.groupBy("dataset_id", "stage").agg(F.map_from_entries(entries).alias("last_process_datetime"))


def start_dates(params: DataFrame) -> DataFrame:
    """(dataset_id, stage, start_ts, needs_start); provisioning datasets start nothing."""
    p = normalise_enums(params)
    return p.select(
        "dataset_id",
        "stage",
        F.when(is_active(), parse_start_date("start_process_from_date")).alias("start_ts"),
        is_incremental().alias("needs_start"),
    )


def build_watermarks(existing: DataFrame, declared: DataFrame, starts: DataFrame) -> DataFrame:
    """A1: existing entries of the datasets in ``starts``, plus the start date for each declared
    table without one.

    Existing and seeded rows meet in one aggregation instead of a full outer join: it combines
    before the shuffle and needs no sort. No side of the joins before it is broadcast, as all grow with the datasets.
    """
    kept = existence_join(existing.select(*KEYS, "last_ts"), starts, ["dataset_id", "stage"], "left_semi", many=True)
    seeds = (
        declared.select("dataset_id", "table_name")
        .join(never_broadcast(starts.filter(F.col("start_ts").isNotNull())), "dataset_id")
        .select(*KEYS, F.col("start_ts").alias("last_ts"))
    )
    rows = kept.withColumn("old", F.lit(True)).unionByName(seeds.withColumn("old", F.lit(False)))
    last = F.when(F.max("old"), F.max(F.when(F.col("old"), F.col("last_ts")))).otherwise(F.max("last_ts"))
    return rows.groupBy(*KEYS).agg(last.alias("last_ts"))


def check_first_run(starts: DataFrame, existing: DataFrame) -> DataFrame:
    """Rule 72: an incremental dataset without watermarks needs a start date."""
    unset = starts.filter(F.col("needs_start") & F.col("start_ts").isNull())
    first = existence_join(unset, existing, ["dataset_id", "stage"], "left_anti", salts=1)
    return violations(first, 72, "first_run", message(M.NO_START_DATE, dataset_id=F.col("dataset_id")))


def merge_watermarks(existing: Column | str, new: Column | str) -> Column:
    """A2: union of two maps, the right-hand value wins; a NULL map counts as empty."""
    empty = F.create_map().cast("map<string,timestamp>")
    left = F.coalesce(F.col(existing) if isinstance(existing, str) else existing, empty)
    right = F.coalesce(F.col(new) if isinstance(new, str) else new, empty)
    return F.map_zip_with(left, right, lambda k, x, y: F.when(F.map_contains_key(right, k), y).otherwise(x))


def advance_watermarks(
    fetched: DataFrame, ts_path: str, watermarks: DataFrame, on: Sequence[str] = ("table_name",)
) -> DataFrame:
    """The greatest fetched timestamp per key; keys without fetched rows keep their value."""
    stamp_type = watermarks.schema["last_ts"].dataType
    newest = fetched.groupBy(*on).agg(F.max(ts_path).cast(stamp_type).alias("__newest"))
    joined = watermarks.join(newest, list(on), "left")
    return joined.select(
        *[F.greatest("__newest", "last_ts").alias(c) if c == "last_ts" else F.col(c) for c in watermarks.columns]
    )


def raise_watermark(watermarks: DataFrame, table_name: str, newest: DataFrame) -> DataFrame:
    """A6 for one table: its entry moves to the one value of ``newest``, never back.

    The value is a scalar subquery, so no join is needed.
    """
    stamp_type = watermarks.schema["last_ts"].dataType
    value = newest.toDF("__newest").select(F.col("__newest").cast(stamp_type)).scalar()
    moved = F.when(F.col("table_name") == table_name, F.greatest(value, "last_ts")).otherwise(F.col("last_ts"))
    return watermarks.select(*[moved.alias(c) if c == "last_ts" else F.col(c) for c in watermarks.columns])


def advance_by_header(
    fetched: DataFrame, header: DataFrame, link: str, ts_path: str, watermarks: DataFrame,
    table_name: str, data_link: str | None = None,
) -> DataFrame:
    """A6 for the header method: the greatest header timestamp among the headers of fetched rows.

    Only the entry of ``table_name`` moves. The fetched keys are de-duplicated before they move,
    so a header with very many data rows costs one row; headers that are not new cannot raise the
    watermark and are not read.
    """
    stamp_type = header.select(F.col(ts_path)).schema[0].dataType
    mark = watermarks.filter(F.col("table_name") == table_name).select(F.col("last_ts").cast(stamp_type))
    fresh = header.filter(F.col(ts_path) > mark.scalar()).select(F.col(link).alias("__link"), F.col(ts_path).alias("__ts"))
    keys = fetched.select(F.col(data_link or link).alias("__link"))
    # Header keys are unique, so there is no hot one to spread.
    newest = existence_join(fresh, keys, ["__link"], "left_semi", salts=1).select(F.max("__ts"))
    return raise_watermark(watermarks, table_name, newest)
