"""Watermarks, fetch, schedule, control rows and the writers on real tables."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.operators import fetch, merge, schedule, watermarks
from sluice.operators import rows as control
from sluice.operators.skew import existence_join, flag_existing
from sluice.plans.fetch import incremental_fetch, with_watermarks
from sluice.session import cut_lineage
from sluice.sinks import tables as sinks
from tests.helpers import rows

JAN10, JAN11, SEED = datetime(2025, 1, 10), datetime(2025, 1, 11), datetime(2025, 1, 1, 12, 34, 56)
MARKS = "dataset_id string, stage string, table_name string, last_ts timestamp"
STARTS = "dataset_id string, stage string, start_ts timestamp, needs_start boolean"


def test_build_watermarks(spark):
    existing = spark.createDataFrame(
        [("x", "A", "t1", JAN10), ("x", "A", "t2", JAN11), ("y", "A", "t1", JAN10), ("x", "B", "t1", JAN11), ("n", "A", "t1", None)], MARKS
    )
    declared = spark.createDataFrame(
        [(d, t) for d in ("x", "y", "z", "w", "n") for t in ("t1", "t2", "t3")], "dataset_id string, table_name string"
    )
    starts = spark.createDataFrame(
        [("x", "A", SEED, True), ("y", "A", None, True), ("z", "A", SEED, True), ("w", "A", None, True), ("n", "A", SEED, True), ("p", "A", None, False)],
        STARTS,
    )
    built = watermarks.build_watermarks(existing, declared, starts)
    got = {}
    for r in built.collect():
        got.setdefault(r["dataset_id"], {})[r["table_name"]] = r["last_ts"]
    assert got == {
        "x": {"t1": JAN10, "t2": JAN11, "t3": SEED},
        "y": {"t1": JAN10},
        "z": {"t1": SEED, "t2": SEED, "t3": SEED},
        "n": {"t1": None, "t2": SEED, "t3": SEED},
    }
    assert rows(watermarks.check_first_run(starts, existing), "dataset_id", "rule_no") == [("w", 72)]


def test_merge_watermarks(spark):
    data = [(1, {"t1": JAN10, "t2": JAN10}, {"t2": JAN11, "t3": SEED}), (2, None, {"t1": SEED}), (3, {"t1": JAN10}, None)]
    df = spark.createDataFrame(data, "i int, a map<string,timestamp>, b map<string,timestamp>")
    got = {r["i"]: r["m"] for r in df.select("i", watermarks.merge_watermarks("a", "b").alias("m")).collect()}
    assert got == {1: {"t1": JAN10, "t2": JAN11, "t3": SEED}, 2: {"t1": SEED}, 3: {"t1": JAN10}}


def test_advance_keeps_tables_without_rows(spark):
    marks = spark.createDataFrame([("t1", JAN10), ("t2", JAN11)], "table_name string, last_ts timestamp")
    fetched = spark.createDataFrame([("t1", datetime(2025, 2, 1)), ("t1", JAN11)], "table_name string, ts timestamp")
    assert rows(watermarks.advance_watermarks(fetched, "ts", marks), "table_name", "last_ts") == [("t1", datetime(2025, 2, 1)), ("t2", JAN11)]


def test_fetch_is_strictly_later_and_per_dataset(spark):
    data = spark.createDataFrame(
        [(1, "t1", Row(ts=JAN10)), (2, "t1", Row(ts=JAN11)), (3, "t2", Row(ts=JAN11))], "id int, source string, meta struct<ts timestamp>"
    )
    marks = spark.createDataFrame([("x", "A", "t1", JAN10), ("y", "A", "t1", SEED), ("x", "A", "t9", SEED)], MARKS)
    fresh = fetch.incremental_by_table(data, "meta.ts", marks, "source")
    assert rows(fresh, "dataset_id", "id") == [("x", 2), ("y", 1), ("y", 2)]
    assert rows(fetch.newer_than(data, "meta.ts", JAN10), "id") == [(2,), (3,)]


def test_header_fetch_without_watermark_gives_nothing(spark):
    header = spark.createDataFrame([(1, JAN10), (2, JAN11)], "hdr_id int, ts timestamp")
    data = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "hdr_id int, v string")
    marks = spark.createDataFrame([("d", JAN10)], "table_name string, last_ts timestamp")
    assert rows(fetch.incremental_by_header(data, header, "hdr_id", "ts", marks, "d"), "v") == [("b",), ("c",)]
    assert fetch.incremental_by_header(data, header, "hdr_id", "ts", marks, "other").count() == 0
    moved = watermarks.advance_by_header(data.filter("hdr_id = 2"), header, "hdr_id", "ts", marks, "d")
    assert rows(moved, "table_name", "last_ts") == [("d", JAN11)]


def test_projection_order_case_and_clashes(spark):
    df = spark.createDataFrame([(1, Row(b=2, c=3), 4)], "id int, a struct<b int, c int>, a_b int")
    assert fetch.project_declared(df, ["a.b", "a_b"]).columns == ["a_b", "a_b_2"]
    out = fetch.project_declared(df, ["A.C", "id", "a.b", "ID"])
    assert out.columns == ["a_c", "id", "a_b"]
    assert fetch.project_declared(df, ["a_b", "a.b"]).columns == ["a_b", "a_b_2"]
    with pytest.raises(ValueError, match="no column"):
        fetch.project_declared(df, ["a.z"])


def test_next_due(spark):
    schema = (
        "dataset_id string, stage string, is_enabled boolean, schedule string, week_days string, dates_of_month string, "
        "last_run_time timestamp, next_run_due_time timestamp"
    )
    now = datetime(2025, 1, 31, 6, 30)
    data = [
        ("daily", "A", True, "DAILY", None, None, None, None),
        ("weekly", "A", True, "WEEKLY", "Friday, mon", None, JAN10, JAN11),
        ("same day", "A", True, "WEEKLY", "FRIDAY", None, JAN10, datetime(2025, 2, 1)),
        ("skips february", "A", True, "MONTHLY", None, "31", JAN10, None),
        ("nearest", "A", True, "MONTHLY", None, "1, 15, 31", JAN10, None),
        ("unknown day", "A", True, "WEEKLY", "Funday", None, JAN10, None),
        ("off", "A", False, "DAILY", None, None, None, None),
    ]
    got = {r["dataset_id"]: (r["is_due"], r["next_run_due_time"]) for r in schedule.next_due(spark.createDataFrame(data, schema), now).collect()}
    assert got == {
        "daily": (True, datetime(2025, 2, 1, 6, 30)),
        "weekly": (True, datetime(2025, 2, 3, 6, 30)),
        "same day": (False, datetime(2025, 2, 7, 6, 30)),
        "skips february": (False, datetime(2025, 3, 31, 6, 30)),
        "nearest": (False, datetime(2025, 2, 1, 6, 30)),
        "unknown day": (False, None),
    }


def test_field_ids_are_dense_and_in_sheet_order(spark):
    data = [("big", i) for i in range(1, 501)] + [(f"d{k}", i) for k in range(40) for i in (2, 7, 9)]
    df = spark.createDataFrame(data, "dataset_id string, row_no long").repartition(7)
    got = control.assign_field_ids(df, 10, block=50).orderBy("field_id").collect()
    assert [r["field_id"] for r in got] == list(range(11, 11 + len(data)))
    seen: dict[str, list[int]] = {}
    for r in got:
        seen.setdefault(r["dataset_id"], []).append(r["row_no"])
    assert all(v == sorted(v) for v in seen.values())
    ids = [r["dataset_id"] for r in got]
    assert all(ids.index(k) + len(v) - 1 == len(ids) - 1 - ids[::-1].index(k) for k, v in seen.items())


def test_upsert_rejects_duplicate_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    assert merge.duplicate_keys(twice, ["k"]).count() == 1
    with pytest.raises(Exception, match="duplicate key"):
        merge.upsert(target, twice, ["k"]).collect()


def test_existence_joins_with_a_hot_key_of_equal_rows(spark):
    left = spark.range(9000).select((F.col("id") % 3 % 2).alias("k"), F.lit("copy").alias("v"))
    keys = spark.createDataFrame([(0,), (0,), (5,)], "k long")
    assert existence_join(left, keys, ["k"], "left_semi").count() == 6000
    assert existence_join(left, keys, ["k"], "left_anti").count() == 3000
    flagged = flag_existing(left, keys, ["k"], "hit").groupBy("hit").count()
    assert rows(flagged, "hit", "count") == [(False, 3000), (True, 6000)]


def test_existence_join_with_nested_maps(spark):
    left = spark.createDataFrame([("a", (1, {"x": 2}), [{"y": 3}]), ("b", None, None)], "k string, s struct<i int, m map<string,int>>, l array<map<string,int>>")
    keys = spark.createDataFrame([("a",)], "k string")
    assert existence_join(left, keys, ["k"], "left_semi").collect()[0]["s"]["m"] == {"x": 2}
    assert rows(existence_join(left, keys, ["k"], "left_anti"), "k") == [("b",)]


def test_copies_of_one_row_spread(spark):
    left = spark.range(0, 8000, 1, 8).select(F.lit("hot").alias("k"), F.lit("copy").alias("v"))
    keys = spark.createDataFrame([("hot",)], "k string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = existence_join(left, keys, ["k"], "left_semi")
        assert kept.count() == 8000
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")
    assert "hashpartitioning(k" in plan and "__salt" in plan


def test_conform_cuts_extra_columns(spark):
    df = spark.createDataFrame([("d", "db", "t", "f", "A", "int", "iso")], "dataset_id string, database_name string, table_name string, field_name string, stage string, data_type string, date_formats string")
    out = control.conform(df, S.INPUT_FIELDS)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in S.INPUT_FIELDS.fields]
    assert messages_of(control.null_violations(out, ["field_id", "stage"])) == ["Column 'field_id' must not be null"]


def messages_of(df):
    return [r["message"] for r in df.collect()]


# --- writers ----------------------------------------------------------------------------------


@pytest.fixture()
def db(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS ctl")
    yield "ctl"
    spark.sql("DROP DATABASE ctl CASCADE")


def _config(spark, *entries):
    data = [
        Row(**{**dict.fromkeys(S.DATASET_CONFIG.names), "dataset_id": d, "stage": s, "comments": c, **more})
        for d, s, c, more in entries
    ]
    return spark.createDataFrame(data, S.DATASET_CONFIG)


def test_write_upsert_and_replace(spark, db):
    table = f"{db}.config"
    sinks.create_control_table(spark, table, S.DATASET_CONFIG)
    first = _config(spark, *[(f"d{i}", "A", "one", {"last_run_time": JAN10}) for i in range(20)])
    for _ in range(2):
        sinks.write_upsert(spark, table, first)
        assert spark.table(table).count() == 20
    second = _config(spark, ("d1", "A", None, {}), ("d1", "B", "new", {}), ("d99", "A", "new", {"last_process_datetime": {"t": JAN11}}))
    sinks.write_upsert(spark, table, second)
    got = {(r["dataset_id"], r["stage"]): r for r in sinks.read_table(spark, table).collect()}
    assert len(got) == 22
    assert got["d1", "A"]["comments"] is None and got["d1", "A"]["last_run_time"] == JAN10
    assert got["d2", "A"]["comments"] == "one"
    assert got["d99", "A"]["last_process_datetime"] == {"t": JAN11}
    sinks.write_replaced_scope(spark, table, second)
    assert {(r["dataset_id"], r["stage"]): r["last_run_time"] for r in spark.table(table).collect()}["d1", "A"] is None
    sinks.write_replaced_scope(spark, table, second.limit(0))
    assert spark.table(table).count() == 22


def test_write_fields_and_remove(spark, db):
    config, fields = f"{db}.config", f"{db}.fields"
    sinks.create_control_table(spark, config, S.DATASET_CONFIG)
    sinks.create_control_table(spark, fields, S.INPUT_FIELDS)
    schema = "dataset_id string, database_name string, table_name string, field_name string, stage string, comments string, row_no long"
    rows_a = spark.createDataFrame([("a", "db", "t", f"c{i}", "A", None, i) for i in range(2, 7)], schema)
    rows_b = spark.createDataFrame([("b", "db", "t", f"c{i}", "A", None, i) for i in range(2, 4)], schema)
    sinks.write_input_fields(spark, fields, rows_a)
    sinks.write_input_fields(spark, fields, rows_b)
    assert rows(spark.table(fields), "field_id", "dataset_id", "field_name") == [
        *[(i - 1, "a", f"c{i}") for i in range(2, 7)], (6, "b", "c2"), (7, "b", "c3"),
    ]
    sinks.write_input_fields(spark, fields, rows_a.limit(1))
    assert rows(spark.table(fields), "field_id", "dataset_id") == [(6, "b"), (7, "b"), (8, "a")]
    sinks.write_upsert(spark, config, _config(spark, ("a", "A", "x", {}), ("b", "A", "x", {})))
    ids = spark.createDataFrame([("a",), ("zz",)], "dataset_id string")
    assert rows(sinks.write_removed(spark, config, fields, ids), "dataset_id") == [("a",)]
    assert rows(spark.table(config), "dataset_id") == [("b",)]
    assert rows(spark.table(fields), "dataset_id") == [("b",), ("b",)]
    ids = spark.createDataFrame([("b",)], "dataset_id string")
    sinks.write_removed(spark, config, fields, ids)
    assert spark.table(config).count() == spark.table(fields).count() == 0


def test_log_tables_only_grow(spark, db):
    table = f"{db}.process"
    sinks.create_log_table(spark, table, S.PROCESS_LOG)
    log = spark.createDataFrame([("p1", "a", "SUCCESS"), ("p2", "b", "FAILED")], "process_load_id string, dataset_id string, status string")
    sinks.write_append(table, log, S.PROCESS_LOG)
    sinks.write_append(table, log, S.PROCESS_LOG)
    assert rows(spark.table(table), "process_load_id", "dataset_id") == [("p1", "a"), ("p1", "a"), ("p2", "b"), ("p2", "b")]


def test_overwrite_table(spark, db):
    sinks.overwrite_table(f"{db}.derived", spark.range(3))
    sinks.overwrite_table(f"{db}.derived", spark.range(2))
    assert spark.table(f"{db}.derived").count() == 2


def test_cut_lineage_keeps_rows_and_types(spark):
    df = spark.createDataFrame([("a", {"t": JAN10})], "k string, m map<string,timestamp>")
    cut = cut_lineage(df)
    assert cut.schema == df.schema and cut.collect() == df.collect()


# --- fetch of a configured dataset ------------------------------------------------------------


def _fields(spark, *entries):
    data = [(i, "d", "db", t, f, "A", None) for i, (t, f) in enumerate(entries, 1)]
    return spark.createDataFrame(data, S.INPUT_FIELDS)


def test_incremental_fetch_by_data(spark):
    config = _config(spark, ("d", "A", None, {
        "load_type": "INCREMENTAL", "incremental_timestamp_method": "TIMESTAMP_DATA_TABLE",
        "incremental_timestamp_field": "meta.ts", "last_process_datetime": {"t1": JAN10, "t2": JAN11},
    }))
    schema = "id int, meta struct<ts timestamp, src string>"
    tables = {
        "t1": spark.createDataFrame([(1, (JAN10, "a")), (2, (JAN11, "b"))], schema),
        "t2": spark.createDataFrame([(3, (JAN11, "c"))], schema),
        "t3": spark.createDataFrame([(4, (JAN11, "d"))], schema),
    }
    fields = _fields(spark, ("t1", "META.src"), ("t1", "id"), ("t2", "id"), ("t3", "id"))
    done = incremental_fetch(config, fields, tables, "d", "A")
    assert done.tables["t1"].columns == ["meta_src", "id"]
    assert rows(done.tables["t1"], "meta_src", "id") == [("b", 2)]
    assert done.tables["t2"].count() == 0 and done.tables["t3"].count() == 0
    assert [r["table_name"] for r in done.faults.collect()] == ["t3"]
    assert rows(done.watermarks, "table_name", "last_ts") == [("t1", JAN11), ("t2", JAN11)]
    updated = with_watermarks(config, done.watermarks).first()
    assert updated["last_process_datetime"] == {"t1": JAN11, "t2": JAN11}


def test_incremental_fetch_by_header(spark):
    config = _config(spark, ("d", "A", None, {
        "load_type": "INCREMENTAL", "incremental_timestamp_method": "TIMESTAMP_HEADER_TABLE", "incremental_timestamp_field": "ts",
        "incremental_header_to_tables_link_field": "hdr.hdr_id", "last_process_datetime": {"hdr": JAN10, "line": SEED},
    }))
    tables = {
        "hdr": spark.createDataFrame([(1, JAN10), (2, JAN11)], "hdr_id int, ts timestamp"),
        "line": spark.createDataFrame([(1, "a"), (2, "b"), (7, "c")], "h int, v string"),
    }
    fields = _fields(spark, ("hdr", "hdr_id"), ("line", "v"))
    done = incremental_fetch(config, fields, tables, "d", "A", {"line": "h"})
    assert rows(done.tables["hdr"], "hdr_id") == [(2,)]
    assert rows(done.tables["line"], "v") == [("a",), ("b",)]
    assert rows(done.watermarks, "table_name", "last_ts") == [("hdr", JAN11), ("line", JAN11)]
    by_name = config.withColumn("incremental_header_to_tables_link_field", F.lit("HDR_ID"))
    assert rows(incremental_fetch(by_name, fields, tables, "d", "A", {"line": "h"}).tables["line"], "v") == [("a",), ("b",)]


def test_a_table_without_link_or_declared_column_does_not_stop_the_others(spark):
    config = _config(spark, ("d", "A", None, {
        "load_type": "INCREMENTAL", "incremental_timestamp_method": "TIMESTAMP_HEADER_TABLE", "incremental_timestamp_field": "ts",
        "incremental_header_to_tables_link_field": "hdr.hdr_id", "last_process_datetime": {"hdr": JAN10, "line": SEED, "odd": SEED, "none": SEED},
    }))
    tables = {
        "hdr": spark.createDataFrame([(1, JAN10), (2, JAN11)], "hdr_id int, ts timestamp"),
        "line": spark.createDataFrame([(1, "a"), (2, "b"), (7, "c")], "hdr_id int, v string"),
        "odd": spark.createDataFrame([(1, "a")], "other int, v string"),
    }
    fields = _fields(spark, ("hdr", "hdr_id"), ("line", "v"), ("line", "old_name"), ("odd", "v"), ("none", "x"))
    done = incremental_fetch(config, fields, tables, "d", "A")
    assert set(done.tables) == {"hdr", "line"} and rows(done.tables["line"], "v") == [("a",), ("b",)]
    assert rows(done.faults, "table_name", "message") == [
        ("line", "Table 'line' has no declared column 'old_name' any more"),
        ("none", "Declared table 'none' is not among the sources"),
        ("odd", "Table 'odd' has no link column 'hdr_id'"),
    ]


def _scanned(df):
    """Rows that the scans of a frame gave when it ran."""
    assert df.collect() is not None
    plan = df._jdf.queryExecution().executedPlan()
    leaves, total = plan.collectLeaves() if "AdaptiveSparkPlan" not in plan.nodeName() else plan.executedPlan().collectLeaves(), []
    todo = [leaves.apply(i) for i in range(leaves.size())]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName():
            inner = node.plan().collectLeaves()
            todo += [inner.apply(i) for i in range(inner.size())]
        elif node.nodeName().startswith("Scan"):
            total.append((node.output().toString(), node.metrics().apply("numOutputRows").value()))
    return total


def test_new_header_keys_bound_the_scan_of_the_data(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(0, 100_000, 1, 1).selectExpr("id AS hdr_id", "id % 7 AS v").sortWithinPartitions("hdr_id").write.option("parquet.block.size", 16_384).option("parquet.page.size", 4096).parquet(path)
    data = spark.read.parquet(path)
    header = spark.range(99_000, 99_100).selectExpr("id AS hdr_id", "TIMESTAMP '2025-01-11 00:00:00' AS ts")
    old = spark.range(0, 99_000).selectExpr("id AS hdr_id", "TIMESTAMP '2025-01-01 00:00:00' AS ts")
    header = cut_lineage(header.union(old))
    marks = spark.createDataFrame([("line", JAN10)], "table_name string, last_ts timestamp")
    keys = fetch.key_range(fetch.newer_than(header, "ts", JAN10), "hdr_id")
    assert keys == (99_000, 99_099)
    wide = fetch.incremental_by_header(data, header, "hdr_id", "ts", marks, "line")
    narrow = fetch.incremental_by_header(data, header, "hdr_id", "ts", marks, "line", between=keys)
    assert rows(narrow, "hdr_id") == rows(wide, "hdr_id") == [(i,) for i in range(99_000, 99_100)]
    held = [n for text, n in _scanned(narrow) if "v#" in text]
    assert held and sum(held) < 20_000
    assert sum(n for text, n in _scanned(wide) if "v#" in text) == 100_000
    # Keys of another type are compared by the join alone.
    text = spark.createDataFrame([("99001", "a")], "hdr_id string, v string")
    assert fetch.incremental_by_header(text, header, "hdr_id", "ts", marks, "line", between=keys).count() == 1


def test_a_table_with_an_old_watermark_does_not_widen_the_scan_of_others(spark, tmp_path):
    path = str(tmp_path / "events")
    many = spark.range(0, 180_000, 1, 1).selectExpr(
        "concat('t', lpad(CAST(id DIV 30000 AS STRING), 2, '0')) AS source", "id", "timestamp_seconds(1735689600 + id % 30000) AS ts"
    )
    many.sortWithinPartitions("source", "ts").write.option("parquet.block.size", 16_384).option("parquet.page.size", 4096).parquet(path)
    data = spark.read.parquet(path)
    names = [f"t{k:02d}" for k in range(60)]
    late, early = datetime(2025, 1, 1, 8, 19, 50), datetime(2024, 1, 1)
    marks = spark.createDataFrame([(t, early if t == "t03" else late) for t in names] + [("t99", None)], "table_name string, last_ts timestamp")
    bounds = fetch.table_bounds(marks)
    assert 1 < len(bounds) <= 32 and sum(b[2] == early for b in bounds) == 1
    assert [t for t in names if not any(a <= t <= b for a, b, _ in bounds)] == []
    narrow = fetch.incremental_by_table(data, "ts", marks, "source", bounds)
    wide = fetch.incremental_by_table(data, "ts", marks, "source")
    assert rows(narrow, "id") == rows(wide, "id") and narrow.count() == 30_000 + 5 * 9
    few = sum(n for text, n in _scanned(narrow) if "source#" in text)
    assert few < 120_000 < sum(n for text, n in _scanned(wide) if "source#" in text) == 180_000
    assert fetch.incremental_by_table(data, "ts", marks.limit(0), "source", fetch.table_bounds(marks.limit(0))).count() == 0


def test_rows_that_arrive_during_a_fetch_are_fetched_by_the_next_one(spark, tmp_path):
    path, schema = str(tmp_path / "t1"), "id int, ts timestamp"
    spark.createDataFrame([(1, JAN10), (2, JAN11)], schema).write.parquet(path)
    config = _config(spark, ("d", "A", None, {
        "load_type": "INCREMENTAL", "incremental_timestamp_method": "TIMESTAMP_DATA_TABLE",
        "incremental_timestamp_field": "ts", "last_process_datetime": {"t1": JAN10, "t2": JAN10},
    }))
    fields = _fields(spark, ("t1", "id"), ("t2", "id"))
    source = lambda: {"t1": spark.read.schema(schema).parquet(path), "t2": spark.range(3)}
    done = incremental_fetch(config, fields, source(), "d", "A")
    later = JAN11.replace(day=20)
    spark.createDataFrame([(3, later)], schema).write.mode("append").parquet(path)
    assert rows(done.watermarks, "table_name", "last_ts") == [("t1", JAN11), ("t2", JAN10)]
    assert rows(done.tables["t1"], "id") == [(2,)]
    assert [(r["table_name"], "ts" in r["message"]) for r in done.faults.collect()] == [("t2", True)]
    after = with_watermarks(config, done.watermarks)
    assert rows(incremental_fetch(after, fields, source(), "d", "A").tables["t1"], "id") == [(3,)]


def test_full_fetch(spark):
    config = _config(spark, ("d", "A", None, {"load_type": "FULL", "incremental_timestamp_method": "TIMESTAMP_DATA_TABLE"}))
    tables = {"t1": spark.range(4)}
    done = incremental_fetch(config, _fields(spark, ("t1", "id")), tables, "d", "A")
    assert done.tables["t1"].count() == 4 and done.watermarks.count() == 0
