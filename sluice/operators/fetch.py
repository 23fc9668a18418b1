"""Fetch of new rows and of declared columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources.catalog import canonical_path


# Ranges of tables whose scans have a bound of their own.
RANGES = 32


def _type_of(df: DataFrame, path: str) -> T.DataType:
    return df.select(F.col(path)).schema[0].dataType


def newer_than(data: DataFrame, ts_path: str, last_ts: datetime) -> DataFrame:
    """A3 for one table: a literal bound, which reaches the scan as a pushed filter.

    The bound takes the type of the column; a cast on the column would keep the filter in Spark.
    """
    return data.filter(F.col(ts_path) > F.lit(last_ts).cast(_type_of(data, ts_path)))


def table_bounds(watermarks: DataFrame, most: int = RANGES) -> list[tuple[str, str, datetime]]:
    """(first table, last table, least watermark) of at most ``most`` disjoint ranges of table names.

    A small job while the fetch is planned: tables are dealt to ranges by name, and only the ranges reach the driver.
    With no more tables than ranges, nearly each has its own bound.
    """
    least = watermarks.groupBy("table_name").agg(F.min("last_ts").alias("least")).where(F.col("least").isNotNull())
    # Each task gets one range, and gives one row.
    ranges = least.repartitionByRange(most, "table_name").groupBy(F.spark_partition_id().alias("range")).agg(
        F.min("table_name").alias("first"), F.max("table_name").alias("last"), F.min("least").alias("least")
    )
    return sorted((r["first"], r["last"], r["least"]) for r in ranges.collect())


def _beyond(bounds: Sequence[tuple[str, str, datetime]], table_col: str, ts_path: str, stamp_type: T.DataType) -> Column:
    """Rows later than the bound of their range of tables; literals only, so all of it reaches the scan."""
    table, out = F.col(table_col), F.lit(False)
    for first, last, least in bounds:
        inside = table == first if first == last else (table >= first) & (table <= last)
        out |= inside & (F.col(ts_path) > F.lit(least).cast(stamp_type))
    if not bounds:
        return out
    return (F.col(ts_path) > F.lit(min(b[2] for b in bounds)).cast(stamp_type)) & out


def incremental_by_table(
    data: DataFrame, ts_path: str, watermarks: DataFrame, table_col: str = "table_name",
    bounds: Sequence[tuple[str, str, datetime]] | None = None,
) -> DataFrame:
    """A3: rows strictly later than the watermark of their table; tables without one give nothing.

    ``watermarks`` may hold several datasets: a row then appears once per (dataset_id, stage) that
    has not seen it. The least watermark bounds the scan of all tables at once; with ``bounds`` of `table_bounds` each
    range of tables has its own, so one table with an old watermark does not widen the scan of the others.
    """
    owners = [c for c in ("dataset_id", "stage") if c in watermarks.columns]
    stamp_type = _type_of(data, ts_path)
    marks = watermarks.select(
        *owners, F.col("table_name").alias(table_col), F.col("last_ts").cast(stamp_type).alias("__last")
    )
    if bounds is None:
        recent = data.filter(F.col(ts_path) > marks.select(F.min("__last")).scalar())
    else:
        recent = data.filter(_beyond(bounds, table_col, ts_path, stamp_type))
    fresh = recent.join(marks, table_col).filter(F.col(ts_path) > F.col("__last"))
    return fresh.select(*owners, *data.columns)


def key_range(fresh: DataFrame, key: str) -> tuple | None:
    """Least and greatest key of the new headers, one row for the driver; None without any."""
    row = fresh.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    return None if row["low"] is None else (row["low"], row["high"])


def incremental_by_header(
    data: DataFrame, header: DataFrame, link: str, ts_path: str, watermarks: DataFrame,
    table_name: str, data_link: str | None = None, between: tuple | None = None,
) -> DataFrame:
    """Data rows whose header row is later than the watermark of the data table.

    ``watermarks`` holds one dataset, so at most one row of ``table_name``; without one nothing is
    fetched. The header side is cut to new rows and one column before the join. It is not
    aggregated: the plain semi join lets AQE split a header that owns a third of the data. ``between``, the `key_range` of the
    new headers, goes to the scan of the data where both keys have one type: row groups of older keys are not read.
    """
    stamp_type = _type_of(header, ts_path)
    mark = watermarks.filter(F.col("table_name") == table_name).select(F.col("last_ts").cast(stamp_type))
    fresh = header.filter(F.col(ts_path) > mark.scalar()).select(F.col(link).alias("__link"))
    key = data_link or link
    if between is not None and _type_of(data, key) == _type_of(header, link):
        kind = _type_of(data, key)
        data = data.filter((F.col(key) >= F.lit(between[0]).cast(kind)) & (F.col(key) <= F.lit(between[1]).cast(kind)))
    return data.join(fresh, F.col(key) == F.col("__link"), "left_semi")


def full_fetch(data: DataFrame) -> DataFrame:
    """A4: all rows, no watermark."""
    return data


def project_declared(data: DataFrame, paths: Sequence[str], *more: Column) -> DataFrame:
    """A5: exactly the declared columns, in sheet order, then ``more``; 'struct.leaf' becomes struct_leaf.

    A path declared twice counts once. Where two paths give the same name, the later one gets a
    number.
    """
    exact = list(dict.fromkeys(canonical_path(data.schema, p) for p in paths))
    taken: set[str] = set()
    out = []
    for path in exact:
        plain = name = path.replace(".", "_")
        number = 1
        while name.lower() in taken:
            number += 1
            name = f"{plain}_{number}"
        taken.add(name.lower())
        out.append(F.col(".".join(f"`{part}`" for part in path.split("."))).alias(name))
    return data.select(*out, *more)
