"""Sheet shaping: key/value folding, key lookup and input-field rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import norm_key, strip, text_or_empty, text_or_null
from sluice.schemas import FIELD_HEADERS, PARAM_KEYS, column_of


def sheet_pairs(cells: DataFrame, sheet: str, header_rows: int = 1) -> DataFrame:
    """Columns 1 and 2 of a sheet as (dataset_id, row_no, key, value); row 1 is the header."""
    body = cells.filter((F.col("sheet") == sheet) & (F.col("row_no") > header_rows) & (F.col("col_no") <= 2))
    return body.groupBy("dataset_id", "row_no").agg(
        F.max(F.when(F.col("col_no") == 1, F.col("value"))).alias("key"),
        F.max(F.when(F.col("col_no") == 2, F.col("value"))).alias("value"),
    )


def _fold(clean: DataFrame) -> DataFrame:
    return clean.groupBy("dataset_id", "key").agg(
        F.min("row_no").alias("pos"), F.max_by("value", "row_no").alias("value")
    )


def fold_pairs(pairs: DataFrame) -> DataFrame:
    """One row per exact key: the last value wins, the first position stays.

    Returns (dataset_id, key, pos, value). Keys are trimmed and blank keys dropped; a blank value
    is NULL.
    """
    clean = pairs.select("dataset_id", "row_no", strip("key").alias("key"), text_or_null("value").alias("value"))
    return _fold(clean.filter(F.col("key") != ""))


def param_map(pairs: DataFrame) -> DataFrame:
    """(dataset_id, params MAP) with the entries in sheet order.

    The map is a single value of a row, so it suits one sheet (at most 1,048,576 rows in the file
    format). Operators of this package use the rows of `fold_pairs` and `param_columns` instead.
    """
    entries = F.array_sort(F.collect_list(F.struct("pos", "key", "value")))
    pair = F.transform(entries, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))
    return fold_pairs(pairs).groupBy("dataset_id").agg(F.map_from_entries(pair).alias("params"))


def _first_alike(key: str) -> Column:
    """Value of the first key that normalises to ``key``."""
    hit = F.col("__norm") == F.lit("".join(key.lower().split()))
    return F.min_by("value", F.when(hit, F.col("pos")))


def param_get(pairs: DataFrame, key: str, out: str = "value") -> DataFrame:
    """S3: (dataset_id, value) of one key, ignoring case and all spaces."""
    folded = fold_pairs(pairs).withColumn("__norm", norm_key("key"))
    return folded.groupBy("dataset_id").agg(_first_alike(key).alias(out))


def param_columns(pairs: DataFrame, keys: Sequence[str] = PARAM_KEYS) -> DataFrame:
    """S3 for all keys at once: one row per dataset, one column per key.

    Keys nobody asks for (blank ones too) collapse into one group per dataset before the first
    shuffle, so a sheet full of them costs nothing but stays visible as a dataset.
    """
    wanted = ["".join(k.lower().split()) for k in keys]
    key = strip("key")
    known = F.when(norm_key(key).isin(*wanted), key).otherwise("")
    clean = pairs.select("dataset_id", "row_no", known.alias("key"), text_or_null("value").alias("value"))
    folded = _fold(clean).withColumn("__norm", norm_key("key"))
    return folded.groupBy("dataset_id").agg(*[_first_alike(k).alias(column_of(k)) for k in keys])


def input_schema_rows(cells: DataFrame, sheet: str = "Input Schema") -> DataFrame:
    """First three columns of the sheet by their trimmed header name; further columns are cut.

    Returns (dataset_id, row_no, database_name, table_name, column_name).
    """
    first_three = cells.filter((F.col("sheet") == sheet) & (F.col("col_no") <= 3))
    header = first_three.filter(F.col("row_no") == 1).select(
        "dataset_id", "col_no", strip("value").alias("header")
    )
    body = first_three.filter(F.col("row_no") > 1).join(header, ["dataset_id", "col_no"])
    return body.groupBy("dataset_id", "row_no").agg(
        *[F.max(F.when(F.col("header") == h, F.col("value"))).alias(column_of(h)) for h in FIELD_HEADERS]
    )


def clean_input_fields(rows: DataFrame, default_db: DataFrame | str | None = None) -> DataFrame:
    """Trimmed rows without fully blank ones; a blank database takes the default.

    ``default_db`` is one name, or (dataset_id, database_name) rows. Row numbers are those of the
    sheet, before the drop; rows carry their order in ``row_no``, so nothing is sorted here.
    """
    names = [column_of(h) for h in FIELD_HEADERS]
    clean = rows.select("dataset_id", "row_no", *[text_or_empty(n).alias(n) for n in names])
    kept = clean.filter(~((F.col(names[0]) == "") & (F.col(names[1]) == "") & (F.col(names[2]) == "")))
    if isinstance(default_db, DataFrame):
        defaults = default_db.select("dataset_id", F.col("database_name").alias("__default"))
        kept = kept.join(defaults, "dataset_id", "left")
        default: Column = F.col("__default")
    else:
        default = F.lit(default_db)
    named = F.coalesce(F.nullif(F.col("database_name"), F.lit("")), default, F.lit(""))
    return kept.select("dataset_id", "row_no", named.alias("database_name"), "table_name", "column_name")


def declared_tables(fields: DataFrame) -> DataFrame:
    """Distinct (dataset_id, database_name, table_name) with the first row that names them."""
    return fields.groupBy("dataset_id", "database_name", "table_name").agg(F.min("row_no").alias("first_row"))


def candidate_tables(rows: DataFrame) -> DataFrame:
    """Distinct non-blank table names per dataset, whatever their database.

    ``rows`` are field rows, raw or cleaned, or the much fewer rows of `declared_tables`.
    """
    at = "first_row" if "first_row" in rows.columns else "row_no"
    return (
        rows.select("dataset_id", at, strip("table_name").alias("table_name"))
        .filter(F.col("table_name") != "")
        .groupBy("dataset_id", "table_name")
        .agg(F.min(at).alias("first_row"))
    )
