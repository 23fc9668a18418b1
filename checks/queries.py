"""One registered query per operator; all read the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import frame, table
from checks.workbooks import param_workbooks
from sluice import schemas as S
from sluice.functions.stamps import parse_start_date
from sluice.functions.text import text_or_empty, to_bool
from sluice.operators import existence, fetch, merge, resolve, rows, rules, runlog, runs, schedule, sheets, watermarks
from sluice.plans import fetch as plan
from sluice.plans.onboard import Sheets, onboard
from sluice.sources.catalog import catalog_of
from sluice.sources.workbooks import parse_workbooks

AS_OF = datetime(2025, 1, 30, 2, 0, 0)
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    _registry[fn.__name__] = run
    return fn


def _params(spark: SparkSession, d: str) -> DataFrame:
    return sheets.param_columns(frame(spark, d, "fx_p"))


def _fields(spark: SparkSession, d: str) -> DataFrame:
    return sheets.clean_input_fields(frame(spark, d, "fx_i"), "src")


def _own_fields(spark: SparkSession, d: str, params: DataFrame) -> DataFrame:
    """Fields whose blank database is that of their own parameter sheet."""
    default = params.select("dataset_id", text_or_empty("database_name").alias("database_name"))
    return sheets.clean_input_fields(frame(spark, d, "fx_i"), default)


# --- sources and sheets -----------------------------------------------------------------------


@_query
def s1_scan_workbooks(spark, d):
    return parse_workbooks(param_workbooks(frame(spark, d, "fx_p")))


@_query
def s2_param_map(spark, d):
    return sheets.param_map(frame(spark, d, "fx_p")).select(
        "dataset_id", F.posexplode("params").alias("pos", "key", "value")
    ).withColumn("pos", F.col("pos").cast("long"))


@_query
def s3_param_get(spark, d):
    return sheets.param_get(frame(spark, d, "fx_p"), "Incremental Header To Tables  Link Field", "link_field")


@_query
def s3_param_columns(spark, d):
    return _params(spark, d).drop("comments")


@_query
def s4_catalog_columns(spark, d):
    catalog = catalog_of(spark, "main", {t: table(spark, d, t) for t in TABLES})
    key = F.col("o_orderkey") % 5
    declared = table(spark, d, "orders").select(
        F.when(key == 0, "orders").when(key == 1, "lineitem").when(key == 2, "customer").otherwise("events").alias("table_name"),
        F.when(key == 0, "O_CUSTKEY").when(key == 1, "l_shipdate").when(key == 2, "C_Name")
        .when(key == 3, "ts").otherwise("nope").alias("column_name"),
    )
    counts = declared.groupBy("table_name", F.lower("column_name").alias("path_key")).agg(
        F.count(F.lit(1)).alias("n")
    )
    listed = catalog.withColumn("path_key", F.lower("path")).join(counts, ["table_name", "path_key"], "left")
    return listed.select("table_name", "ordinal", "path", F.coalesce("n", F.lit(0)).alias("n_declared"))


@_query
def s5_clean_input_fields(spark, d):
    return _fields(spark, d)


@_query
def s6_declared_tables(spark, d):
    return sheets.declared_tables(_fields(spark, d))


@_query
def s6_candidate_tables(spark, d):
    return sheets.candidate_tables(frame(spark, d, "fx_i"))


# --- rules --------------------------------------------------------------------------------------


@_query
def p1_to_bool(spark, d):
    return _params(spark, d).select("dataset_id", to_bool("is_enabled").alias("is_enabled"))


@_query
def p2_enabled_only(spark, d):
    return rules.enabled_only(_params(spark, d)).select("dataset_id", "is_enabled")


@_query
def p3_parse_start_date(spark, d):
    return _params(spark, d).select("dataset_id", parse_start_date("start_process_from_date").alias("start_ts"))


@_query
def p4_normalise_enums(spark, d):
    return rules.normalise_enums(_params(spark, d)).select(
        "dataset_id", "stage", "stage_key", "load_type", "incremental_timestamp_method"
    )


@_query
def p5_check_sheets(spark, d):
    datasets = table(spark, d, "customer").select(F.concat(F.lit("DS_"), F.col("c_custkey")).alias("dataset_id"))
    return rules.check_sheets(frame(spark, d, "fx_t"), datasets)


@_query
def p6_check_spec_layout(spark, d):
    return rules.check_spec_layout(frame(spark, d, "fx_s"))


@_query
def p7_check_identity(spark, d):
    pairs = frame(spark, d, "fx_s").withColumnRenamed("label", "key")
    return rules.check_identity(sheets.param_columns(pairs, S.SPEC_KEYS), check_name=True)


@_query
def p8_check_schedule(spark, d):
    return rules.check_schedule(_params(spark, d))


@_query
def p9_check_calendar(spark, d):
    return rules.check_calendar(_params(spark, d))


@_query
def p10_check_params(spark, d):
    return rules.check_params(_params(spark, d))


def _onboarding(spark, d):
    params = _params(spark, d)
    names = sheets.param_get(frame(spark, d, "fx_s").withColumnRenamed("label", "key"), "Dataset Name", "dataset_name")
    sheet = Sheets(params.select("dataset_id"), params, names, _own_fields(spark, d, params))
    return onboard(sheet, frame(spark, d, "fx_c"), frame(spark, d, "fx_w"), stage=lambda df: df)


@_query
def p11_first_error(spark, d):
    results = _onboarding(spark, d).results
    return results.select("dataset_id", "status", F.array_join("errors", "; ").alias("errors"))


# --- joins ----------------------------------------------------------------------------------------


@_query
def j1_missing_databases(spark, d):
    return existence.missing_databases(_fields(spark, d), frame(spark, d, "fx_c"))


@_query
def j1_check_databases(spark, d):
    return existence.check_databases(_params(spark, d), frame(spark, d, "fx_c"))


@_query
def j2_missing_fields(spark, d):
    return existence.missing_fields(_fields(spark, d), frame(spark, d, "fx_c"))


@_query
def j2_check_fields(spark, d):
    return existence.check_fields(_fields(spark, d), frame(spark, d, "fx_c"))


@_query
def j3_locate_param_field(spark, d):
    lookups = resolve.field_lookups(_params(spark, d))
    return resolve.locate_param_field(lookups, sheets.declared_tables(_fields(spark, d)), frame(spark, d, "fx_c"))


@_query
def j3_check_param_fields(spark, d):
    declared = sheets.declared_tables(_fields(spark, d))
    return resolve.check_param_fields(_params(spark, d), declared, frame(spark, d, "fx_c"))


@_query
def j4_resolve_timestamp_field(spark, d):
    specs, catalog = resolve.timestamp_specs(_params(spark, d)), frame(spark, d, "fx_c")
    resolved = resolve.resolve_timestamp_field(specs, sheets.candidate_tables(frame(spark, d, "fx_i")), catalog)
    return resolved.withColumn("candidates", F.array_join("candidates", ","))


@_query
def j4_check_timestamp_field(spark, d):
    candidates = sheets.candidate_tables(frame(spark, d, "fx_i"))
    return resolve.check_timestamp_field(_params(spark, d), candidates, frame(spark, d, "fx_c"))


@_query
def j5_dataset_conflicts(spark, d):
    return existence.dataset_conflicts(frame(spark, d, "fx_j_incoming"), frame(spark, d, "fx_j_config"))


def _line_mark(spark, d):
    return frame(spark, d, "fx_line_mark")


@_query
def j6_incremental_by_header(spark, d):
    data, header = table(spark, d, "lineitem"), table(spark, d, "orders")
    fresh = fetch.incremental_by_header(
        data, header, "o_orderkey", "o_orderdate", _line_mark(spark, d), "lineitem", "l_orderkey"
    )
    return fresh.select("l_orderkey", "l_linenumber")


@_query
def j7_dataset_overview(spark, d):
    event = frame(spark, d, "fx_l")
    return runlog.dataset_overview(
        frame(spark, d, "fx_p"), _fields(spark, d), runlog.process_rollup(event), event
    )


# --- watermarks, fetch, schedule ------------------------------------------------------------------


@_query
def a1_build_watermarks(spark, d):
    params = _params(spark, d)
    declared = sheets.candidate_tables(frame(spark, d, "fx_i"))
    return watermarks.build_watermarks(frame(spark, d, "fx_w"), declared, watermarks.start_dates(params))


@_query
def a1_check_first_run(spark, d):
    return watermarks.check_first_run(watermarks.start_dates(_params(spark, d)), frame(spark, d, "fx_w"))


@_query
def a2_merge_watermarks(spark, d):
    stored = frame(spark, d, "fx_w_all")
    old = watermarks.watermark_maps(stored)
    moved = stored.filter("table_name = 't2'").withColumn("last_ts", F.expr("last_ts + INTERVAL 1 DAY"))
    fresh = stored.filter("table_name = 't1'").withColumn("table_name", F.lit("t3"))
    new = watermarks.watermark_maps(moved.unionByName(fresh)).withColumnRenamed("last_process_datetime", "new")
    both = old.join(new, ["dataset_id", "stage"], "full_outer")
    merged = both.withColumn("last_process_datetime", watermarks.merge_watermarks("last_process_datetime", "new"))
    return watermarks.watermark_rows(merged)


@_query
def a3_incremental_by_table(spark, d):
    marks = frame(spark, d, "fx_marks")
    fresh = fetch.incremental_by_table(table(spark, d, "events"), "ts", marks, "event_type", fetch.table_bounds(marks))
    return fresh.select("event_id", "event_type", "ts")


@_query
def a4_full_fetch(spark, d):
    return fetch.full_fetch(table(spark, d, "orders"))


@_query
def a5_project_declared(spark, d):
    wrapped = table(spark, d, "events").select(
        "event_id", F.struct(F.col("ts").alias("event_received_ts"), F.col("event_type").alias("src")).alias("meta"), "props"
    )
    return fetch.project_declared(wrapped, ["event_id", "meta.event_received_ts", "META.src"])


@_query
def a6_advance_watermarks(spark, d):
    marks = frame(spark, d, "fx_marks")
    fresh = fetch.incremental_by_table(table(spark, d, "events"), "ts", marks, "event_type")
    return watermarks.advance_watermarks(fresh.withColumnRenamed("event_type", "table_name"), "ts", marks)


@_query
def a6_advance_by_header(spark, d):
    data, header, mark = table(spark, d, "lineitem"), table(spark, d, "orders"), _line_mark(spark, d)
    fresh = fetch.incremental_by_header(data, header, "o_orderkey", "o_orderdate", mark, "lineitem", "l_orderkey")
    return watermarks.advance_by_header(fresh, header, "o_orderkey", "o_orderdate", mark, "lineitem", "l_orderkey")


@_query
def a7_process_rollup(spark, d):
    p = rules.normalise_enums(_params(spark, d)).withColumnRenamed("database_name", "source_database_name")
    marks = watermarks.watermark_maps(frame(spark, d, "fx_w"))
    config = p.join(marks, ["dataset_id", "stage"], "left")
    return runlog.process_rollup(frame(spark, d, "fx_l"), config).drop("target_file_name")


@_query
def a8_schedule_days(spark, d):
    return schedule.schedule_days(_params(spark, d)).drop("stage")


@_query
def a9_next_due(spark, d):
    return schedule.next_due(frame(spark, d, "fx_a"), AS_OF)


@_query
def record_run(spark, d):
    return runs.record_run(frame(spark, d, "fx_r_config"), frame(spark, d, "fx_r_states"), frame(spark, d, "fx_r_events"))


# --- rows and sinks -------------------------------------------------------------------------------


@_query
def b1_config_rows(spark, d):
    params = _params(spark, d)
    catalog = frame(spark, d, "fx_c")
    candidates = sheets.candidate_tables(frame(spark, d, "fx_i"))
    names = sheets.param_get(frame(spark, d, "fx_s").withColumnRenamed("label", "key"), "Dataset Name", "dataset_name")
    specs = resolve.timestamp_specs(params)
    resolved = resolve.resolve_timestamp_field(specs, candidates, catalog)
    marks = watermarks.build_watermarks(frame(spark, d, "fx_w"), candidates, watermarks.start_dates(params))
    built = rows.config_rows(params, names, resolved, marks)
    entries = F.transform(
        F.array_sort(F.map_entries("last_process_datetime")),
        lambda e: F.concat_ws("=", e["key"], F.date_format(e["value"], "yyyy-MM-dd HH:mm:ss")),
    )
    return built.withColumn("watermarks", F.array_join(entries, ",")).drop(
        "modified_date", "dataset_modified_by_user", "last_process_datetime", "last_run_time",
        "next_run_due_time", "comments",
    )


@_query
def b2_input_field_rows(spark, d):
    built = rows.input_field_rows(_fields(spark, d), _params(spark, d))
    return built.drop("comments")


@_query
def k1_replace_scope(spark, d):
    return merge.replace_scope(frame(spark, d, "fx_k_target"), frame(spark, d, "fx_k_incoming"))


@_query
def k2_upsert(spark, d):
    return merge.upsert(
        frame(spark, d, "fx_k_target"), frame(spark, d, "fx_k_incoming"), ["c_custkey"], keep=["last_run_time"]
    )


@_query
def k3_append(spark, d):
    return merge.append(frame(spark, d, "fx_k_target"), frame(spark, d, "fx_k_incoming"))


@_query
def k4_remove_datasets(spark, d):
    config, fields, removed = merge.remove_datasets(
        frame(spark, d, "fx_k_target"), _fields(spark, d), frame(spark, d, "fx_k_incoming")
    )
    return (
        config.select(F.lit("config").alias("part"), "dataset_id", F.col("c_custkey").alias("key"))
        .unionByName(fields.select(F.lit("fields").alias("part"), "dataset_id", F.col("row_no").alias("key")))
        .unionByName(removed.select(F.lit("removed").alias("part"), "dataset_id", F.lit(0).cast("long").alias("key")))
    )


@_query
def k5_assign_field_ids(spark, d):
    return rows.assign_field_ids(_fields(spark, d), 1000).select("field_id", "dataset_id", "row_no", "column_name")


@_query
def k6_conform(spark, d):
    loose = frame(spark, d, "fx_l").select(
        F.lit("extra").alias("date_formats"), F.col("record_count").cast("string").alias("record_count"), "dataset_id",
        "process_load_id", "event_load_id", "event_name", "event_start_datetime",
    )
    return rows.conform(loose, S.EVENT_LOG).select(
        "event_load_id", "process_load_id", "dataset_id", "event_name", "event_start_datetime", "event_status", "record_count"
    )


@_query
def k6_null_violations(spark, d):
    return rows.null_violations(_params(spark, d), ["stage", "pet_dataset_id", "database_name", "dataset_owner"])


@_query
def k7_overwrite(spark, d):
    return merge.overwrite(frame(spark, d, "fx_k_target"), frame(spark, d, "fx_k_incoming"))


# --- flagship -------------------------------------------------------------------------------------


@_query
def incremental_fetch(spark, d):
    """All three kinds of fetch, declared columns only, and the watermark each table moves to."""
    marks = frame(spark, d, "fx_marks")
    events = fetch.incremental_by_table(table(spark, d, "events"), "ts", marks, "event_type")
    orders, lines, line_mark = table(spark, d, "orders"), table(spark, d, "lineitem"), _line_mark(spark, d)
    fresh = fetch.incremental_by_header(lines, orders, "o_orderkey", "o_orderdate", line_mark, "lineitem", "l_orderkey")
    parts = [
        fetch.project_declared(events, ["event_type", "event_id"]).toDF("table_name", "row_key"),
        fetch.project_declared(fresh, ["l_orderkey"]).select(F.lit("lineitem").alias("table_name"), F.col("l_orderkey").alias("row_key")),
        fetch.project_declared(fetch.full_fetch(orders), ["o_orderkey"]).select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("row_key")),
    ]
    counts = rules.union_all(parts).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows_fetched"), F.sum("row_key").alias("key_sum")
    )
    moved = watermarks.advance_watermarks(events.withColumnRenamed("event_type", "table_name"), "ts", marks).unionByName(
        watermarks.advance_by_header(fresh, orders, "o_orderkey", "o_orderdate", line_mark, "lineitem", "l_orderkey")
    )
    return counts.join(moved, "table_name", "left").select("table_name", "rows_fetched", "key_sum", "last_ts")


@_query
def fetch_datasets(spark, d):
    """The packaged fetch of a dataset by data timestamps, one by header and one in full, counted by table."""
    config = spark.sql("""
SELECT * FROM VALUES
 ('DS_E', 'S', 'INCREMENTAL', 'TIMESTAMP_DATA_TABLE', 'ts', NULL, map('events', TIMESTAMP '2024-01-25 12:00:00')),
 ('DS_O', 'S', 'INCREMENTAL', 'TIMESTAMP_HEADER_TABLE', 'o_orderdate', 'orders.o_orderkey',
  map('orders', TIMESTAMP '1998-06-01 00:00:00', 'lineitem', TIMESTAMP '1998-01-01 00:00:00')),
 ('DS_F', 'S', 'FULL', NULL, NULL, NULL, map())
AS c(dataset_id, stage, load_type, incremental_timestamp_method, incremental_timestamp_field,
 incremental_header_to_tables_link_field, last_process_datetime)""")
    fields = spark.sql("""
SELECT dataset_id, 'S' AS stage, table_name, field_name, CAST(field_id AS BIGINT) AS field_id FROM VALUES
 ('DS_E', 'events', 'event_id', 1), ('DS_O', 'orders', 'o_orderkey', 2), ('DS_O', 'lineitem', 'l_orderkey', 3),
 ('DS_O', 'part', 'p_partkey', 4), ('DS_F', 'customer', 'c_custkey', 5), ('DS_F', 'customer', 'c_gone', 6) AS f(dataset_id, table_name, field_name, field_id)""")
    tables = {name: table(spark, d, name) for name in ("events", "orders", "lineitem", "part", "customer")}
    parts = []
    for dataset in ("DS_E", "DS_O", "DS_F"):
        got = plan.incremental_fetch(config, fields, tables, dataset, "S", {"lineitem": "l_orderkey"})
        for name, rows_ in got.tables.items():
            counts = rows_.agg(F.count(F.lit(1)).alias("rows_fetched"), F.sum(rows_.columns[0]).alias("key_sum"))
            if name == "part":  # fetched as empty, with a fault
                continue
            moved = counts.withColumn("table_name", F.lit(name)).join(got.watermarks, "table_name", "left")
            parts.append(moved.select("table_name", "rows_fetched", "key_sum", "last_ts", F.lit(None).cast("string").alias("message")))
        none = [F.lit(None).cast(t).alias(c) for c, t in (("rows_fetched", "long"), ("key_sum", "long"), ("last_ts", "timestamp"))]
        parts.append(got.faults.select("table_name", *none, "message"))
    return rules.union_all(parts)


@_query
def with_watermarks(spark, d):
    """Stored watermarks of all datasets, with those that a fetch moved."""
    stored = frame(spark, d, "fx_w_all")
    moved = frame(spark, d, "fx_w").withColumn("last_ts", F.expr("last_ts + INTERVAL 2 DAYS"))
    after = plan.with_watermarks(watermarks.watermark_maps(stored), moved)
    return watermarks.watermark_rows(after)


def queries() -> dict[str, Query]:
    return dict(_registry)
