"""Joins whose sides grow with the datasets: the driver must not hold one of them, however small Spark takes it to be."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import existence, resolve, watermarks
from sluice.operators.rows import config_rows
from tests.helpers import catalog, wide_params

COUNT = 300


def _ran(df):
    """Rows of ``df``, and the plan that gave them once its sizes were known."""
    got = df.collect()
    return got, df._jdf.queryExecution().executedPlan().toString()


def _datasets(spark):
    return spark.range(COUNT).select(F.format_string("ds%d", "id").alias("dataset_id"), F.lit("A").alias("stage"), "id")


def test_watermarks_of_many_datasets(spark):
    """neither the starts, repeated for every salt, nor those with a date reach the driver."""
    ids = _datasets(spark)
    day = F.make_timestamp(F.lit(2025), F.lit(1), F.lit(1) + F.col("id") % 28, F.lit(0), F.lit(0), F.lit(0))
    existing = ids.where("id % 3 = 0").select("dataset_id", "stage", F.lit("t1").alias("table_name"), day.alias("last_ts"))
    declared = ids.select("dataset_id", F.explode(F.array(F.lit("t1"), F.lit("t2"))).alias("table_name"))
    date = F.to_timestamp(F.lit("2025-02-01 00:00:00"))
    starts = ids.where("id % 5 > 0").select(
        "dataset_id", "stage", F.when(F.col("id") % 2 == 0, date).alias("start_ts"), F.lit(True).alias("needs_start")
    )
    got, plan = _ran(watermarks.build_watermarks(existing, declared, starts))
    want = set()
    for i in range(COUNT):
        if i % 5 > 0 and i % 3 == 0:
            want.add((f"ds{i}", "t1", f"2025-01-{1 + i % 28:02d}"))
        if i % 5 > 0 and i % 2 == 0:
            want |= {(f"ds{i}", t, "2025-02-01") for t in (("t2",) if i % 3 == 0 else ("t1", "t2"))}
    rows = [(r.dataset_id, r.table_name, f"{r.last_ts:%Y-%m-%d}") for r in got]
    assert set(rows) == want and len(rows) == len(want)
    assert "Broadcast" not in plan


def test_config_rows_of_many_datasets(spark):
    """names, candidates, resolved fields and watermarks of all datasets do not reach the driver; the catalog may."""
    ids = _datasets(spark)
    keys = {"Stage": "A", "Load Type": "Incremental", "Database Name": "db", "Incremental Timestamp Method": "TIMESTAMP_DATA_TABLE"}
    params = wide_params(
        spark, *[keys | {"dataset_id": f"ds{i}", "Incremental Timestamp Field": "ts" if i % 2 else "nope"} for i in range(COUNT)]
    )
    names = ids.where("id % 3 > 0").select("dataset_id", F.concat(F.lit("Name "), "id").alias("dataset_name"))
    candidates = ids.where("id % 5 > 0").select("dataset_id", F.lit("t1").alias("table_name"), F.lit(2).cast("long").alias("first_row"))
    marks = ids.where("id % 7 > 0").select(
        "dataset_id", "stage", F.lit("t1").alias("table_name"), F.to_timestamp(F.lit("2025-02-01 00:00:00")).alias("last_ts")
    )
    known = catalog(spark, "db", t1="id int, meta struct<ts timestamp>")
    resolved = resolve.resolve_timestamp_field(resolve.timestamp_specs(params), candidates, known)
    got, plan = _ran(config_rows(params, names, resolved, marks).select("dataset_id", "dataset_name", "incremental_timestamp_field", "last_process_datetime"))
    rows = {r[0]: (r[1], r[2], set(r[3])) for r in got}
    assert len(got) == COUNT and rows == {
        f"ds{i}": (f"Name {i}" if i % 3 else f"ds{i}", "meta.ts" if i % 2 else "nope", {"t1"} if i % 7 else set()) for i in range(COUNT)
    }
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert [line for line in joins if "db_key" not in line] == []


def test_conflicts_of_many_datasets(spark):
    """neither the configured ids nor the shared names, repeated for every salt, reach the driver."""
    ids = _datasets(spark)
    config = ids.select("dataset_id", F.concat(F.lit("Name "), F.col("id") % 200).alias("dataset_name"))
    new = F.format_string("new%d", "id")
    incoming = ids.select(
        F.when(F.col("id") % 5 == 0, new).otherwise(F.col("dataset_id")).alias("dataset_id"),
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("Own "), "id")).otherwise(F.concat(F.lit("Name "), F.col("id") % 200)).alias("dataset_name"),
    )
    got, plan = _ran(existence.dataset_conflicts(incoming, config))
    owners: dict[str, set[str]] = {}
    named = [(f"new{i}" if i % 5 == 0 else f"ds{i}", f"Own {i}" if i % 4 == 0 else f"Name {i % 200}") for i in range(COUNT)]
    for key, name in [*named, *((f"ds{i}", f"Name {i % 200}") for i in range(COUNT))]:
        owners.setdefault(name, set()).add(key)
    want = {(key, "FAILED") for key, name in named if len(owners[name]) > 1} | {(f"ds{i}", "SKIPPED") for i in range(COUNT) if i % 5}
    assert {(r.dataset_id, r.status) for r in got} == want and len(got) == len(want)
    assert "Broadcast" not in plan
