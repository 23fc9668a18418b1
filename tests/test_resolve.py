"""Existence checks and name resolution on flat and nested columns."""

from __future__ import annotations

import pytest

from sluice.operators import existence, resolve, sheets
from tests.helpers import catalog, field_rows, literal, messages, rows, wide_params

T1 = "id int, event_ts timestamp, meta struct<ts timestamp, src string>"


@pytest.fixture(scope="module")
def tables(spark):
    return catalog(
        spark, "lake", t1=T1, t2="id int, header struct<ts timestamp>", t3="id int, received struct<rcv_ts timestamp>"
    ).cache()


@pytest.fixture(scope="module")
def param_catalog(spark):
    return catalog(spark, "lake", t_data=T1, t_hdr="hdr_id int, header_link_ts timestamp").cache()


def test_input_fields(spark, tables):
    fields = sheets.clean_input_fields(
        field_rows(
            spark,
            ("", "t1", "meta.ts"), ("LAKE", "t1", "META.TS"), ("lake", "t2", "id"),
            ("lake", "", "id"), ("lake", "t2", ""), ("no_such_db_xyz", "t1", "meta.ts"),
            ("lake", "t2", "nope"), ("lake", "T1", "id"), ("lake", "t1", "meta.ts.deeper"),
        ),
        "lake",
    )
    row = "[Input Schema] Row "
    assert messages(existence.check_fields(fields, tables)) == [
        f"{row}5: 'Table Name' is empty.",
        f"{row}6: 'Column Name' is empty.",
        f"{row}7: Database 'no_such_db_xyz' not found.",
        f"{row}8: Not found → lake.t2.nope",
        f"{row}9: Not found → lake.T1.id",
        f"{row}10: Not found → lake.t1.meta.ts.deeper",
    ]
    assert rows(existence.missing_databases(fields, tables), "row_no") == [(7,)]
    assert rows(existence.missing_fields(fields, tables), "row_no") == [(5,), (6,), (7,), (8,), (9,), (10,)]


def test_blank_database_without_default(spark, tables):
    fields = sheets.clean_input_fields(field_rows(spark, ("", "t1", "meta.ts")), "")
    assert messages(existence.check_fields(fields, tables)) == [
        "[Input Schema] Row 2: 'Database Name' is empty and no default provided."
    ]


def test_database_name(spark, tables):
    params = wide_params(
        spark, {"Database Name": "lake"}, {"Database Name": "LAKE"}, {"Database Name": None}, {"Database Name": "no_such_db_xyz"}
    )
    assert messages(existence.check_databases(params, tables)) == ["Database Name missing", "Database 'no_such_db_xyz' not found"]


DATA = {"Incremental Timestamp Method": "TIMESTAMP_DATA_TABLE"}
HEADER = {"Incremental Timestamp Method": "TIMESTAMP_HEADER_TABLE", "Incremental Timestamp Field": "event_ts"}
LINK = "Incremental Header To Tables Link Field"


@pytest.mark.parametrize(
    ("changes", "found"),
    [
        ({**DATA, "Incremental Timestamp Field": "event_ts"}, True),
        ({**DATA, "Incremental Timestamp Field": "meta.ts"}, True),
        ({**DATA, "Incremental Timestamp Field": "t_data.event_ts"}, True),
        ({**DATA, "Incremental Timestamp Field": "t_data.META.ts"}, True),
        ({**DATA, "Incremental Timestamp Field": "T_DATA.event_ts"}, False),
        ({**DATA, "Incremental Timestamp Field": "nope"}, False),
        ({**HEADER, LINK: "t_hdr.header_link_ts"}, True),
        ({**HEADER, LINK: "header_link_ts"}, True),
        ({**HEADER, LINK: "t_hdr.nope"}, False),
    ],
)
def test_locate_param_field(spark, param_catalog, changes, found):
    base = {"Stage": "StageA", "Load Type": "INCREMENTAL", "Database Name": "lake", "Schedule": "DAILY"}
    params = wide_params(spark, {**base, **changes})
    declared = sheets.declared_tables(field_rows(spark, ("lake", "t_data", "id"), ("lake", "t_hdr", "hdr_id")))
    located = resolve.locate_param_field(resolve.field_lookups(params), declared, param_catalog)
    assert [r["found"] for r in located.collect()] == [found]
    assert resolve.check_param_fields(params, declared, param_catalog).count() == (0 if found else 1)


def test_all_searched_tables_are_listed(spark, param_catalog):
    params = wide_params(
        spark,
        {"Stage": "A", "Load Type": "INCREMENTAL", "Database Name": "lake", **DATA, "Incremental Timestamp Field": "nope"},
    )
    declared = sheets.declared_tables(field_rows(spark, *[("db", f"t{i:02}", "id") for i in range(30)]))
    (text,) = messages(resolve.check_param_fields(params, declared, param_catalog))
    assert text.endswith("'db.t28', 'db.t29']") and text.count("'db.t") == 30


def test_all_scanned_tables_and_paths_are_listed(spark):
    wide = catalog(spark, "lake", **{f"t{i:02}": f"id int, s{i:02} struct<ts timestamp>" for i in range(30)})
    params, candidates = _resolver_input(spark, [("nope", ()), ("ts", ())])
    got = {r["dataset_id"]: r["message"] for r in resolve.check_timestamp_field(params, candidates, wide).collect()}
    assert got["ds1"].count("'lake.t") == 30 and got["ds2"].count(".ts'") == 30


ALL = ("t1", "t2", "t3")
RESOLVED = [
    ("t1.event_ts", ALL, "event_ts"),
    ("t1.meta.ts", ALL, "meta.ts"),
    ("T1.META.TS", ALL, "META.TS"),
    ("t1.ts", ALL, "meta.ts"),
    ("meta.ts", ALL, "meta.ts"),
    ("event_ts", ALL, "event_ts"),
    ("rcv_ts", ALL, "received.rcv_ts"),
    ("ts", ("t1",), "meta.ts"),
    ("rcv_ts", (), "received.rcv_ts"),
    ("T3.rcv_ts", (), "received.rcv_ts"),
    ("t1.event_ts", (), "event_ts"),
    ("meta.ts", (), "meta.ts"),
]
FAULTS = [
    ("ts", ALL, "Ambiguous leaf 'ts' across tables in lake; candidates: ['header.ts', 'meta.ts']. Please specify one in the sheet."),
    ("ts", (), "Ambiguous leaf 'ts' across tables in lake; candidates: ['header.ts', 'meta.ts']. Please specify one in the sheet."),
    ("missing_col", (), "Not found → lake.missing_col. Scanned tables: ['lake.t1', 'lake.t2', 'lake.t3']"),
    ("t2.meta.ts", (), "Not found → lake.t2.meta.ts"),
    ("missing_col", ALL, "Not found → lake.missing_col. Scanned tables: ['lake.t1', 'lake.t2', 'lake.t3']"),
    ("nope.col", ALL, "Not found → lake.nope.col. Scanned tables: ['lake.t1', 'lake.t2', 'lake.t3']"),
    ("t2.meta.ts", ALL, "Not found → lake.t2.meta.ts"),
    ("", ALL, "Incremental Timestamp Field is missing - 1"),
    ("event_ts", ("t2", "t3"), "Not found → lake.event_ts. Scanned tables: ['lake.t2', 'lake.t3']"),
]


def _resolver_input(spark, cases):
    base = {"Stage": "A", "Load Type": "INCREMENTAL", "Database Name": "lake"}
    params = wide_params(spark, *[{**base, "Incremental Timestamp Field": c[0]} for c in cases])
    candidates = [(f"ds{i}", t, n) for i, c in enumerate(cases, 1) for n, t in enumerate(c[1])]
    return params, spark.createDataFrame(candidates, "dataset_id string, table_name string, first_row int")


def test_resolve(spark, tables):
    params, candidates = _resolver_input(spark, RESOLVED)
    specs = resolve.timestamp_specs(params)
    got = {r["dataset_id"]: r["resolved"] for r in resolve.resolve_timestamp_field(specs, candidates, tables).collect()}
    assert [got[f"ds{i}"] for i in range(1, len(RESOLVED) + 1)] == [c[2] for c in RESOLVED]


def test_unresolved(spark, tables):
    params, candidates = _resolver_input(spark, FAULTS)
    found = resolve.check_timestamp_field(params, candidates, tables)
    got = {r["dataset_id"]: r["message"] for r in found.collect()}
    assert [got[f"ds{i}"] for i in range(1, len(FAULTS) + 1)] == [c[2] for c in FAULTS]


def test_ambiguous_within_one_table(spark):
    two = catalog(spark, "db", t="id int, a struct<ts timestamp>, b struct<TS timestamp>")
    params, candidates = _resolver_input(spark, [("t.ts", ("t",), None)])
    params = params.withColumn("database_name", literal(spark, d="db").scalar())
    (text,) = messages(resolve.check_timestamp_field(params, candidates, two))
    assert text == "Ambiguous leaf 'ts' in db.t; candidates: ['a.ts', 'b.ts']. Please specify one in the sheet."


def test_conflicts(spark):
    schema = "dataset_id string, dataset_name string"
    config = spark.createDataFrame([("a", "A"), ("b", "B")], schema)
    incoming = spark.createDataFrame([("a", "A"), ("c", "B"), ("d", "D"), ("e", "E"), ("f", "E")], schema)
    taken = [("c", "FAILED"), ("e", "FAILED"), ("f", "FAILED")]
    assert rows(existence.dataset_conflicts(incoming, config), "dataset_id", "status") == [("a", "SKIPPED"), *taken]
    assert rows(existence.dataset_conflicts(incoming, config, overwrite=True), "dataset_id", "status") == taken
