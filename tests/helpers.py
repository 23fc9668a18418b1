from __future__ import annotations

from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.sources.catalog import schema_rows

PARAM_COLUMNS = [S.column_of(k) for k in S.PARAM_KEYS]


def wide_params(spark, *rows):
    """Wide parameter rows from dicts keyed by sheet key; dataset_id defaults to ds1, ds2, ..."""
    data = []
    for i, row in enumerate(rows, start=1):
        row = dict(row)
        data.append((row.pop("dataset_id", f"ds{i}"), *[row.get(k) for k in S.PARAM_KEYS]))
    schema = "dataset_id string, " + ", ".join(f"{c} string" for c in PARAM_COLUMNS)
    return spark.createDataFrame(data, schema)


def catalog(spark, db, **tables):
    """Catalog snapshot of tables given as DDL schemas."""
    from pyspark.sql.types import StructType

    rows = [r for name, ddl in tables.items() for r in schema_rows(db, name, StructType.fromDDL(ddl))]
    from sluice.sources.catalog import CATALOG

    return spark.createDataFrame(rows, CATALOG)


def field_rows(spark, *rows, dataset="ds1", first=2):
    data = [(dataset, first + i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "dataset_id string, row_no long, database_name string, table_name string, column_name string"
    )


def messages(df):
    return [r["message"] for r in df.orderBy("rule_no", "row_no", "message").collect()]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def literal(spark, **values):
    """One-row DataFrame of string values."""
    return spark.range(1).select(*[F.lit(v).cast("string").alias(k) for k, v in values.items()])
