"""Catalog snapshot (S4): one row per column and per struct leaf of every table."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Requests to the metastore at once, and lines of its answers that change without the table.
THREADS = 16
VOLATILE = ("Last Access", "Statistics")

CATALOG = T.StructType(
    [
        T.StructField("db", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("top", T.StringType()),
        T.StructField("leaf", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("depth", T.IntegerType()),
        T.StructField("type", T.StringType()),
    ]
)

# A catalog with the version of each table, to be stored and refreshed.
SNAPSHOT = T.StructType([*CATALOG.fields, T.StructField("version", T.StringType())])


def walk_schema(schema: T.StructType, parents: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    for field in schema.fields:
        path = (*parents, field.name)
        yield path, field.dataType
        if isinstance(field.dataType, T.StructType):
            yield from walk_schema(field.dataType, path)


def schema_rows(db: str, table: str, schema: T.StructType) -> Iterator[tuple]:
    """Rows of one table; ``ordinal`` is that of the top-level column."""
    ordinal = {name: i for i, name in enumerate(schema.names, start=1)}
    for path, dtype in walk_schema(schema):
        yield db, table, ordinal[path[0]], path[0], path[-1], ".".join(path), len(path), dtype.simpleString()


def canonical_path(schema: T.StructType, path: str) -> str:
    """The path in the spelling of the schema, any depth, ignoring case."""
    wanted = [p.strip().lower() for p in path.split(".") if p.strip()]
    for found, _ in walk_schema(schema):
        if [p.lower() for p in found] == wanted:
            return ".".join(found)
    raise ValueError(f"no column '{path}' in {schema.simpleString()}")


def catalog_of(spark: SparkSession, db: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Snapshot of DataFrames given by name; only their schemas are read."""
    rows = [r for name, df in tables.items() for r in schema_rows(db, name, df.schema)]
    return spark.createDataFrame(rows, CATALOG)


def _read_schema(spark: SparkSession, db: str, table: str) -> T.StructType | None:
    """The schema of a table, None if it went meanwhile; any other failure is raised, as it would turn into false faults."""
    try:
        return spark.table(f"`{db}`.`{table}`").schema
    except AnalysisException as error:
        if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
            raise
        return None


def _read_all(spark: SparkSession, names: Sequence[tuple[str, str]]) -> list[tuple]:
    """Catalog rows of the tables, read side by side: each is a wait for the metastore."""
    with ThreadPoolExecutor(THREADS) as pool:
        schemas = list(pool.map(lambda name: _read_schema(spark, *name), names))
    return [r for (db, table), schema in zip(names, schemas, strict=True) if schema is not None for r in schema_rows(db, table, schema)]


def _databases(spark: SparkSession, dbs: Iterable[str] | None) -> list[str]:
    return list(dbs) if dbs is not None else [d.name for d in spark.catalog.listDatabases()]


def catalog_columns(spark: SparkSession, dbs: Iterable[str] | None = None) -> DataFrame:
    """Snapshot of the metastore, one pass over the tables of ``dbs`` (default: all).

    Schemas are metadata, so the driver reads them, each once.
    """
    names = [(db, t.name) for db in _databases(spark, dbs) for t in spark.catalog.listTables(db) if not t.isTemporary]
    return spark.createDataFrame(_read_all(spark, names), CATALOG)


def named_databases(spark: SparkSession, names: DataFrame) -> list[str]:
    """The databases of the catalog that the first column of ``names`` mentions, in any case.

    Sheets may name anything, so they meet the catalog's databases first; the driver gets no more than those.
    """
    known = spark.createDataFrame([(d.name,) for d in spark.catalog.listDatabases()], "db string")
    asked = names.select(F.lower(F.trim(names.columns[0])).alias("key"))
    return sorted(r["db"] for r in known.join(asked, F.lower("db") == F.col("key"), "left_semi").collect())


def table_versions(spark: SparkSession, dbs: Iterable[str] | None = None) -> list[tuple[str, str, str]]:
    """(db, table, version) by one listing for each database, side by side.

    The version is a digest of what the metastore says of the table, without what reading it changes.
    """
    def listed(db: str) -> list[tuple[str, str, str]]:
        rows = spark.sql(f"SHOW TABLE EXTENDED IN `{db}` LIKE '*'").where("NOT isTemporary").collect()
        facts = [[x for x in r["information"].splitlines() if not x.startswith(VOLATILE)] for r in rows]
        return [(db, r["tableName"], hashlib.md5("\n".join(f).encode()).hexdigest()) for r, f in zip(rows, facts, strict=True)]

    with ThreadPoolExecutor(THREADS) as pool:
        return [row for rows in pool.map(listed, _databases(spark, dbs)) for row in rows]


def refreshed_catalog(spark: SparkSession, stored: DataFrame | None, dbs: Iterable[str] | None = None) -> DataFrame:
    """S4 from a stored snapshot: the rows of SNAPSHOT, reading only tables that are new or changed since.

    ``stored`` is an earlier result, in a table of its own, or None. Tables that went, and databases that are not asked for, go.
    """
    now = table_versions(spark, dbs)
    held = set() if stored is None else {tuple(r) for r in stored.select("db", "table_name", "version").distinct().collect()}
    versions = spark.createDataFrame(now, "db string, table_name string, version string")
    fresh = [(db, table) for db, table, version in now if (db, table, version) not in held]
    read = spark.createDataFrame(_read_all(spark, fresh), CATALOG).join(versions, ["db", "table_name"])
    if stored is None:
        return read.select(*SNAPSHOT.names)
    kept = stored.join(versions, ["db", "table_name", "version"], "left_semi")
    return kept.select(*SNAPSHOT.names).unionByName(read.select(*SNAPSHOT.names))
