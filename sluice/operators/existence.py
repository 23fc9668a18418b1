"""Set-based existence checks against the catalog and the control table.

A catalog is a DataFrame (db, table_name, path, top, leaf, depth), see `sluice.sources.catalog`.
Databases and columns match in any case, tables exactly; paths reach one struct level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice import messages as M
from sluice.functions.text import is_blank, message, strip
from sluice.operators.rules import database_name_rule, explode_faults, violations
from sluice.operators.skew import existence_join, flag_existing


def catalog_databases(catalog: DataFrame) -> DataFrame:
    return catalog.select(F.lower("db").alias("db_key"))


def catalog_paths(catalog: DataFrame) -> DataFrame:
    """Match keys of the catalog: top-level columns and leaves of one struct."""
    return catalog.filter(F.col("depth") <= 2).select(
        F.lower("db").alias("db_key"), "table_name", F.lower("path").alias("path_key")
    )


def _keyed(fields: DataFrame) -> DataFrame:
    return fields.withColumns(
        {"db_key": F.lower("database_name"), "path_key": F.lower("column_name")}
    )


# Databases are few and each has very many catalog rows, so they meet as distinct names. Columns are joined as
# they are: an anti join needs no distinct keys, and without an aggregation below it AQE can split a column
# that a third of the rows declare.


def missing_databases(fields: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows whose database is not in the catalog, in any case."""
    keyed = fields.withColumn("db_key", F.lower("database_name"))
    return existence_join(keyed, catalog_databases(catalog), ["db_key"], "left_anti").select(*fields.columns)


def missing_fields(fields: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows whose database, table and column path are not in the catalog."""
    on = ["db_key", "table_name", "path_key"]
    return _keyed(fields).join(catalog_paths(catalog), on, "left_anti").select(*fields.columns)


def check_database_known(params: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rule 32 over (dataset_id, database_name)."""
    named = params.select("dataset_id", strip("database_name").alias("database_name"))
    unknown = missing_databases(named.filter(~is_blank("database_name")), catalog)
    return violations(unknown, 32, "database", message(M.UNKNOWN_DATABASE, db=F.col("database_name")))


def check_databases(params: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rules 31 and 32 over (dataset_id, database_name)."""
    blank = explode_faults(params, [database_name_rule()])
    return blank.unionByName(check_database_known(params, catalog))


def check_fields(fields: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rule 41: the first fault of each cleaned row.

    A row with a blank is never in the catalog, so one anti join over all rows leaves exactly the
    faulty ones; only those are told apart.
    """
    absent = missing_fields(fields, catalog).withColumn("db_key", F.lower("database_name"))
    flagged = flag_existing(absent, catalog_databases(catalog), ["db_key"], "db_known")
    db, table, column = F.col("database_name"), F.col("table_name"), F.col("column_name")
    row = F.col("row_no")
    text = (
        F.when(db == "", message(M.ROW_NO_DATABASE, row=row))
        .when(table == "", message(M.ROW_NO_TABLE, row=row))
        .when(column == "", message(M.ROW_NO_COLUMN, row=row))
        .when(~F.col("db_known"), message(M.ROW_UNKNOWN_DATABASE, row=row, db=db))
        .otherwise(message(M.ROW_NOT_FOUND, row=row, db=db, table=table, column=column))
    )
    return violations(flagged, 41, "input_field", text, row)


def dataset_conflicts(incoming: DataFrame, config: DataFrame, overwrite: bool = False) -> DataFrame:
    """(dataset_id, status, message) of incoming datasets that may not be loaded as they are.

    SKIPPED when the id is configured and may not be overwritten; FAILED when the dataset name
    belongs to another id as well. Names compare as written. Names and ids are as many as the datasets, so neither is
    broadcast.
    """
    named = incoming.select("dataset_id", "dataset_name")
    owners = (
        named.unionByName(config.select("dataset_id", "dataset_name"))
        .groupBy("dataset_name")
        .agg(F.min("dataset_id").alias("least"), F.max("dataset_id").alias("greatest"))
    )
    shared = owners.filter(F.col("least") != F.col("greatest"))
    taken = existence_join(named, shared, ["dataset_name"], "left_semi", many=True).select(
        "dataset_id",
        F.lit("FAILED").alias("status"),
        message(M.NAME_TAKEN, name=F.col("dataset_name")).alias("message"),
    )
    if overwrite:
        return taken.distinct()
    known = existence_join(named, config, ["dataset_id"], "left_semi", many=True).select(
        "dataset_id", F.lit("SKIPPED").alias("status"), F.lit(M.SKIPPED).alias("message")
    )
    return known.unionByName(taken).distinct()
