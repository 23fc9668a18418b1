"""Incremental fetch of one configured dataset: new rows of its tables, then new watermarks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice import messages as M
from sluice import schemas as S
from sluice.operators import fetch as ops
from sluice.operators.watermarks import (
    advance_by_header, merge_watermarks, raise_watermark, watermark_maps, watermark_rows,
)
from sluice.session import cut_lineage
from sluice.sources.catalog import walk_schema


@dataclass(frozen=True)
class Fetched:
    """New rows by table, in the declared columns, the watermarks after them, and the tables left out.

    ``faults`` is (table_name, message): a declared table without a watermark (fetched as empty), without the timestamp or
    the link column or any declared column, or not among the sources; and declared columns that are gone, without which
    their table is fetched.
    """

    tables: dict[str, DataFrame]
    watermarks: DataFrame
    faults: DataFrame


def _declared(fields: DataFrame) -> dict[str, list[str]]:
    """Declared paths by table, in sheet order.

    Column names are what a plan is made of, so the driver needs them. Distinct paths of one
    dataset are at most the columns of its source tables.
    """
    paths = fields.groupBy("table_name", "field_name").agg(F.min("field_id").alias("at")).orderBy("at").collect()
    out: dict[str, list[str]] = {}
    for r in paths:
        out.setdefault(r["table_name"], []).append(r["field_name"])
    return out


def _paths(data: DataFrame) -> set[str]:
    return {".".join(path).lower() for path, _ in walk_schema(data.schema)}


def _header_of(link: str, tables: Mapping[str, DataFrame], declared: Iterable[str]) -> tuple[str, str]:
    """(header table, key): the prefix of the link field, else the first declared table with the field."""
    head, _, key = link.partition(".")
    if key and head in tables:
        return head, key
    for table in declared:
        if table in tables and link.lower() in _paths(tables[table]):
            return table, link
    raise ValueError(f"no table holds the link field '{link}'")


def incremental_fetch(
    config: DataFrame, fields: DataFrame, tables: Mapping[str, DataFrame],
    dataset_id: str, stage: str, data_links: Mapping[str, str] | None = None,
) -> Fetched:
    """Fetch what is new for (dataset_id, stage) since its watermarks.

    FULL load: all rows. Data method: rows later than the watermark of their table. Header method:
    rows whose header row is; ``data_links`` names the link column of a data table where it differs
    from the header's key. New rows are written once, with their timestamp, and both the rows and the
    watermarks are read from there: rows that reach the source meanwhile wait for the next run.
    """
    own = (F.col("dataset_id") == dataset_id) & (F.col("stage") == stage)
    row = config.filter(own).first()
    if row is None:
        raise ValueError(f"dataset {dataset_id} (stage {stage}) is not configured")
    marks = watermark_rows(config.filter(own))
    # The MAP of one config row: the literal bounds of the scans.
    last = row["last_process_datetime"] or {}
    stamp, link = row["incremental_timestamp_field"], row["incremental_header_to_tables_link_field"]
    declared = _declared(fields.filter(own))
    by_header = row["load_type"] != S.FULL and row["incremental_timestamp_method"] == S.HEADER_METHOD
    header_table, key = _header_of(link, tables, declared) if by_header else (None, None)
    least = min((last[t] for t in declared if last.get(t)), default=None)
    keys = None
    if by_header and least is not None:
        fresh = ops.newer_than(tables[header_table], stamp, least)
        new_headers = cut_lineage(fresh.select(F.col(key), F.col(stamp).alias("__stamp")))
        keys = ops.key_range(new_headers, key)
    out: dict[str, DataFrame] = {}
    faults: list[tuple[str, str]] = []
    after = marks
    for table, named in declared.items():
        if table not in tables:
            faults.append((table, M.NO_TABLE.format(table=table)))
            continue
        data = tables[table]
        there = _paths(data)
        paths = [p for p in named if p.lower() in there]
        faults += [(table, M.NO_DECLARED_COLUMN.format(table=table, field=p)) for p in named if p.lower() not in there]
        if not paths:
            continue
        if row["load_type"] == S.FULL:
            out[table] = ops.project_declared(ops.full_fetch(data), paths)
            continue
        if last.get(table) is None:
            out[table] = ops.project_declared(data.limit(0), paths)
            faults.append((table, M.NO_WATERMARK.format(table=table)))
            continue
        if by_header and table != header_table:
            data_link = (data_links or {}).get(table) or key
            if data_link.lower() not in there:
                faults.append((table, M.NO_LINK_COLUMN.format(table=table, field=data_link)))
                continue
            rows = ops.incremental_by_header(data, new_headers, key, "__stamp", marks, table, data_link, keys)
            staged = cut_lineage(ops.project_declared(rows, paths, F.col(data_link).alias("__link")))
            after = advance_by_header(staged, new_headers, key, "__stamp", after, table, "__link")
        elif stamp.lower() not in there:
            faults.append((table, M.NO_TIMESTAMP_COLUMN.format(table=table, field=stamp)))
            continue
        else:
            rows = ops.newer_than(data, stamp, last[table])
            staged = cut_lineage(ops.project_declared(rows, paths, F.col(stamp).alias("__stamp")))
            after = raise_watermark(after, table, staged.select(F.max("__stamp")))
        out[table] = staged.drop("__link", "__stamp")
    return Fetched(out, after, config.sparkSession.createDataFrame(faults, "table_name string, message string"))


def with_watermarks(config: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Config rows of the given (dataset_id, stage) scopes with their new MAP, ready for the upsert."""
    new = watermark_maps(watermarks).withColumnRenamed("last_process_datetime", "__new")
    return config.join(new, list(S.SCOPE)).select(
        *[
            merge_watermarks("last_process_datetime", "__new").alias(c) if c == "last_process_datetime" else F.col(c)
            for c in config.columns
        ]
    )
