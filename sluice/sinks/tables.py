"""Thin writers over the pure forms in `sluice.operators.merge`.

Control tables change through `sluice.sinks.manifest`: a write touches only the buckets of its scopes, and what one
call writes, in however many tables, becomes visible with one commit. Log tables can only grow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice import schemas as S
from sluice.operators import merge
from sluice.operators.rows import assign_field_ids, conform
from sluice.session import cut_lineage, scratch
from sluice.sinks import manifest
from sluice.sinks.manifest import Write, commit

LOG_PARTITION = "dataset_id"
FIELD_ID = "field_id"


def create_control_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Create the table from its fixed schema when it is missing."""
    manifest.create(spark, table, schema)


def create_log_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    manifest.create(spark, table, schema)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the newest commit."""
    return manifest.snapshot(spark, [table])[0]


def replaced_scope(table: str, incoming: DataFrame, keys: Sequence[str] = S.SCOPE) -> Write:
    """K1 as a write. No incoming rows: nothing is deleted."""
    return Write(table, incoming, lambda target: merge.replace_scope(target, incoming, keys), keys)


def upserted(
    table: str, incoming: DataFrame, keys: Sequence[str] = S.SCOPE, keep: Sequence[str] = S.RUN_TIMES
) -> Write:
    """K2 as a write; run times of known datasets stay."""
    return Write(table, incoming, lambda target: merge.upsert(target, incoming, keys, keep), keys)


def input_fields(spark: SparkSession, table: str, rows: DataFrame) -> Write:
    """K1 and K5 for the field table: replace the scope, number the new rows from a range reserved for them."""
    rows = cut_lineage(rows)
    db = manifest.database_of(spark, table)
    count = rows.count()
    last = manifest.reserve(spark, db, f"{table.rpartition('.')[2]}.{FIELD_ID}", count) if count else 0
    return replaced_scope(table, conform(assign_field_ids(rows, last), S.INPUT_FIELDS))


def write_replaced_scope(spark: SparkSession, table: str, incoming: DataFrame, keys: Sequence[str] = S.SCOPE) -> None:
    """K1 against a table."""
    commit(spark, [replaced_scope(table, incoming, keys)])


def write_upsert(
    spark: SparkSession, table: str, incoming: DataFrame, keys: Sequence[str] = S.SCOPE,
    keep: Sequence[str] = S.RUN_TIMES,
) -> None:
    """K2 against a table."""
    commit(spark, [upserted(table, incoming, keys, keep)])


def write_input_fields(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """K1 and K5 against the field table."""
    with scratch(spark):
        commit(spark, [input_fields(spark, table, rows)])


def write_append(table: str, rows: DataFrame, schema: T.StructType) -> None:
    """K3 for the log tables; no other way to write them is offered. Files are sorted by dataset, so a query for one reads few."""
    manifest.append(rows.sparkSession, table, conform(rows, schema), [LOG_PARTITION])


def compact_log(spark: SparkSession, table: str) -> None:
    """Merges the small portions of a log table; its rows stay."""
    manifest.compact(spark, table, [LOG_PARTITION])


def write_removed(spark: SparkSession, config_table: str, fields_table: str, ids: DataFrame) -> DataFrame:
    """K4 against both tables in one commit; returns the ids that were configured.

    Buckets hash the whole scope, so the scopes of the ids are looked up first.
    """
    config, fields = manifest.snapshot(spark, [config_table, fields_table])
    existed = cut_lineage(merge.remove_datasets(config, fields, ids)[2])

    def without(table: str, content: DataFrame) -> Write:
        scopes = merge.existence_join(content.select(*S.SCOPE), ids, ["dataset_id"], "left_semi").distinct()
        return Write(table, cut_lineage(scopes), lambda target: merge.existence_join(target, ids, ["dataset_id"], "left_anti"), S.SCOPE)

    commit(spark, [without(config_table, config), without(fields_table, fields)])
    return existed


def overwrite_table(table: str, rows: DataFrame) -> None:
    """K7: replace a whole derived table. Not for control tables: it drops other datasets' rows."""
    rows.write.mode("overwrite").format("parquet").saveAsTable(table)
