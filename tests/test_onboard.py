"""Workbook files, the catalog snapshot and the whole onboarding job."""

from __future__ import annotations

import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.workbooks import build_workbook
from sluice import schemas as S
from sluice.plans.onboard import onboard_workbooks
from sluice.session import shared_folder
from sluice.sinks import tables as sinks
from sluice.sources import catalog as catalog_source
from sluice.sources.catalog import canonical_path, catalog_columns, named_databases, refreshed_catalog
from sluice.sources.workbooks import list_files, scan_tagged, scan_workbooks, with_dataset
from tests.helpers import rows

SPEC = [[label, "some_value"] for label in S.SPEC_LABELS]


def _spec(dataset):
    own = {"Dataset Name": f"Name of {dataset}", "ExternalID": dataset.lower()}
    return [[label, own.get(label, "some_value")] for label in S.SPEC_LABELS]


def _book(dataset, params=None, fields=None, drop=(), spec=None):
    base = {
        "Stage": "Domain-0-Transformation", "Pet Dataset ID": "p1", "Load Type": "Incremental", "Is Enabled": "TRUE",
        "Database Name": "SRC_DB", "Incremental Timestamp Method": "timestamp-data-table", "Incremental Timestamp Field": "t1.META.ts",
        "Schedule": "DAILY", "Start Process From Date": "2025-01-01", "Dataset Owner": "owner",
    }
    pairs = [["Key", "Value"], *([k, v] for k, v in {**base, **(params or {})}.items())]
    fields = fields or [["", "t1", "META.ts"], [None, None, None], ["src_db", "t1", "id"]]
    header = [" Database Name ", "Table Name", "Column Name", "Data Type", "Date Formats"]
    sheets = {
        "Specification": spec or _spec(dataset),
        "Input Schema": [header, *([*f, "string", "iso"] for f in fields)],
        "DPS-CDP Params": pairs, "Notes": [["free text"]],
    }
    return {k: v for k, v in sheets.items() if k not in drop}


@pytest.fixture(scope="module")
def source(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS src_db")
    spark.sql("CREATE TABLE src_db.t1 (id int, meta struct<ts: timestamp, src: string, deep: struct<x: int>>) USING parquet")
    spark.sql("CREATE TABLE src_db.t2 (id int, c1 string) USING parquet")
    yield catalog_columns(spark, ["src_db"]).cache()
    spark.sql("DROP DATABASE src_db CASCADE")


def test_catalog_columns(spark, source):
    got = rows(source, "table_name", "ordinal", "path", "depth", "type")
    assert got == sorted([
        ("t1", 1, "id", 1, "int"), ("t1", 2, "meta", 1, "struct<ts:timestamp,src:string,deep:struct<x:int>>"),
        ("t1", 2, "meta.ts", 2, "timestamp"), ("t1", 2, "meta.src", 2, "string"), ("t1", 2, "meta.deep", 2, "struct<x:int>"),
        ("t1", 2, "meta.deep.x", 3, "int"), ("t2", 1, "id", 1, "int"), ("t2", 2, "c1", 1, "string"),
    ])
    assert canonical_path(spark.table("src_db.t1").schema, "Meta.DEEP.x") == "meta.deep.x"


def test_catalog_is_refreshed_by_difference(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS snap")
    spark.sql("CREATE TABLE snap.a (id int) USING parquet")
    spark.sql("CREATE TABLE snap.b (id int, s struct<x: int>) USING parquet")
    read, real = [], catalog_source._read_schema

    def counted(session, db, table):
        read.append(table)
        return real(session, db, table)

    monkeypatch.setattr(catalog_source, "_read_schema", counted)
    refresh = lambda stored: refreshed_catalog(spark, stored, ["snap"]).cache()
    first = refresh(None)
    assert rows(first, "table_name", "path") == rows(catalog_columns(spark, ["snap"]), "table_name", "path")
    read.clear()
    again = refresh(first)
    assert read == [] and rows(again, *again.columns) == rows(first, *first.columns)
    spark.sql("ALTER TABLE snap.a ADD COLUMNS (more string)")
    spark.sql("CREATE TABLE snap.c (z int) USING parquet")
    spark.sql("DROP TABLE snap.b")
    spark.sql("SELECT * FROM snap.a").collect()
    later = refresh(again)
    assert sorted(read) == ["a", "c"]
    assert rows(later, "table_name", "path") == [("a", "id"), ("a", "more"), ("c", "z")]
    asked = spark.createDataFrame([(" SNAP ",), ("nowhere",), (None,)], "database_name string")
    assert named_databases(spark, asked) == ["snap"]
    spark.sql("DROP DATABASE snap CASCADE")


def test_scan_workbooks(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "A.XLSX").write_bytes(build_workbook({"One": [["k", None, " v & <w> "], [], ["x"]], "Two": [["only"]]}))
    (tmp_path / "sub" / "B.xlsx").write_bytes(build_workbook({"One": [["k", "k"]]}, shared=True))
    (tmp_path / "broken.xlsx").write_bytes(b"not a zip")
    (tmp_path / "c.csv").write_text("a,b")
    cells = with_dataset(scan_workbooks(spark, str(tmp_path)))
    assert rows(cells, "dataset_id", "sheet", "row_no", "col_no", "value") == [
        ("A", "One", 1, 1, "k"), ("A", "One", 1, 3, " v & <w> "), ("A", "One", 3, 1, "x"), ("A", "Two", 1, 1, "only"),
        ("B", "One", 1, 1, "k"), ("B", "One", 1, 2, "k"),
    ]
    assert list_files(spark, str(tmp_path)).count() == 4
    odd = tmp_path / "a b+c%20.xlsx"
    odd.write_bytes(build_workbook({"One": [["k"]]}))
    assert rows(with_dataset(scan_workbooks(spark, str(odd))), "dataset_id") == [("a b+c%20",)]
    requests = spark.createDataFrame([("mine", str(odd))], "dataset_id string, path string")
    assert rows(with_dataset(scan_workbooks(spark, str(tmp_path)), requests), "dataset_id", "value") == [("mine", "k")]


def test_typed_cells(spark, tmp_path):
    book = tmp_path / "t.xlsx"
    book.write_bytes(build_workbook({"S": [["x"]]}))
    sheet = (
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="2">'
        '<c r="A2"><v>5</v></c><c r="B2"><v>5.0</v></c><c r="C2"><v>1.25</v></c><c r="D2" t="b"><v>1</v></c>'
        '<c r="E2" s="1"><v>45693</v></c><c r="F2" s="2"><v>45658.5242592593</v></c><c r="AA2" t="str"><v>f</v></c><c r="AB2"/>'
        "</row></sheetData></worksheet>"
    )
    styles = (
        '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><numFmts><numFmt numFmtId="170" '
        'formatCode="yyyy-mm-dd hh:mm:ss"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/></cellXfs></styleSheet>'
    )
    typed = tmp_path / "typed.xlsx"
    with zipfile.ZipFile(book) as old, zipfile.ZipFile(typed, "w") as new:
        for name in old.namelist():
            new.writestr(name, sheet if name.endswith("sheet1.xml") else old.read(name))
        new.writestr("xl/styles.xml", styles)
    assert rows(scan_workbooks(spark, str(typed)), "row_no", "col_no", "value") == [
        (2, 1, "5"), (2, 2, "5"), (2, 3, "1.25"), (2, 4, "True"), (2, 5, "2025-02-05 00:00:00"),
        (2, 6, "2025-01-01 12:34:56"), (2, 27, "f"),
    ]


def test_damaged_workbooks_do_not_spoil_the_batch(spark, tmp_path):
    good = build_workbook(_book("GOOD"))
    (tmp_path / "good.xlsx").write_bytes(good)
    (tmp_path / "plain.xlsx").write_bytes(b"no archive")
    with zipfile.ZipFile(tmp_path / "good.xlsx") as old, zipfile.ZipFile(tmp_path / "cut.xlsx", "w") as new:
        for name in old.namelist():
            content = old.read(name)
            new.writestr(name, content[: len(content) // 2] if name.endswith("sheet1.xml") else content)
    paths = {r["path"].rsplit("/", 1)[1] for r in scan_workbooks(spark, str(tmp_path)).select("path").distinct().collect()}
    assert paths == {"good.xlsx"}


def test_faults_of_files_have_their_reason(spark, source, tmp_path):
    good = build_workbook(_book("GOOD"))
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "GOOD.xlsx").write_bytes(good)
    (tmp_path / "PLAIN.xlsx").write_bytes(b"no archive")
    (tmp_path / "OLD.xls").write_bytes(b"binary")
    (tmp_path / "a" / "TWICE.xlsx").write_bytes(good)
    (tmp_path / "b" / "TWICE.xlsx").write_bytes(good)
    with zipfile.ZipFile(tmp_path / "GOOD.xlsx") as old, zipfile.ZipFile(tmp_path / "CUT.xlsx", "w") as new:
        for name in old.namelist():
            content = old.read(name)
            new.writestr(name, content[: len(content) // 2] if name.endswith("sheet1.xml") else content)
    (tmp_path / "NOOWNER.xlsx").write_bytes(build_workbook(_book("NOOWNER", {"Dataset Owner": " "})))
    tagged = scan_tagged(spark, str(tmp_path))
    assert tagged.where("fault IS NOT NULL").select("path").count() == 2
    spark.sql("CREATE DATABASE IF NOT EXISTS faulty")
    done = onboard_workbooks(
        spark, with_dataset(tagged), with_dataset(list_files(spark, str(tmp_path))), source, "faulty.config", "faulty.fields"
    )
    errors = {r["dataset_id"]: (r["errors"] or [None])[0] for r in done.collect()}
    assert errors["GOOD"] is None and len(errors) == 6
    assert errors["PLAIN"] == "Workbook cannot be read: it is no Excel archive, or the archive is cut off"
    assert errors["CUT"] == "Workbook cannot be read: the XML of a part is damaged or cut off"
    assert errors["OLD"].startswith("Binary .xls workbooks cannot be read; save as .xlsx: ")
    assert errors["TWICE"].startswith("Several files stand for dataset TWICE: [") and errors["TWICE"].count("TWICE.xlsx") == 2
    assert errors["NOOWNER"] == "Column 'dataset_owner' must not be null"
    assert rows(spark.table("faulty.config"), "dataset_id") == [("GOOD",)]
    spark.sql("DROP DATABASE faulty CASCADE")


BOOKS = {
    "GOOD": _book("GOOD"),
    "FULL": _book("FULL", {"Load Type": "FULL", "Incremental Timestamp Field": "", "Schedule": "", "Start Process From Date": ""}),
    "PROV": _book("PROV", {"Stage": "Data-Provisioning", "Load Type": "", "Schedule": ""}),
    "OFF": _book("OFF", {"Is Enabled": "false"}),
    "NOSHEET": _book("NOSHEET", drop=("Input Schema",)),
    "BADCOL": _book("BADCOL", fields=[["", "t1", "id"], ["", "t2", "nope"]]),
    "NOSTART": _book("NOSTART", {"Start Process From Date": None}),
    "BADID": _book("BADID", spec=_spec("other")),
    "BADSPEC": _book("BADSPEC", spec=SPEC[:5]),
    "EMPTY": {**_book("EMPTY"), "Input Schema": [["Database Name", "Table Name", "Column Name"]]},
}
EXPECTED = {
    "GOOD": None, "FULL": None, "PROV": None,
    "OFF": "Dataset OFF is disabled (Is Enabled = FALSE). Skipping load.",
    "NOSHEET": "Missing required sheets: {'Input Schema'}",
    "BADCOL": "[Input Schema] Row 3: Not found → SRC_DB.t2.nope",
    "NOSTART": "'Start Process From Date' is required for first-time run of dataset NOSTART",
    "BADID": "Dataset ID mismatch between param and file",
    "BADSPEC": "Dataset ID mismatch between param and file",
    "EMPTY": "Input Schema sheet is empty.",
    "CSV": "Invalid file format. Expected Excel file (.xlsx or .xls), got: ",
}


def test_onboard_workbooks(spark, source, tmp_path):
    for name, sheets in BOOKS.items():
        (tmp_path / f"{name}.xlsx").write_bytes(build_workbook(sheets, shared=len(name) % 2 == 0))
    (tmp_path / "CSV.csv").write_text("a,b")
    spark.sql("CREATE DATABASE IF NOT EXISTS job")
    cells = with_dataset(scan_workbooks(spark, str(tmp_path)))
    datasets = with_dataset(list_files(spark, str(tmp_path)))

    def run(**options):
        return onboard_workbooks(spark, cells, datasets, source, "job.config", "job.fields", identity=True, layout=True, **options)

    held = Path(shared_folder(spark))
    before = {p.name for p in held.iterdir()} if held.exists() else set()
    results = {r["dataset_id"]: r for r in run(unique=True).collect()}
    # The results and the conflicts they name; every other staged folder is gone.
    assert len({p.name for p in held.iterdir()} - before) == 2
    assert set(results) == set(EXPECTED)
    for name, text in EXPECTED.items():
        assert results[name]["status"] == ("SUCCESS" if text is None else "FAILED"), name
        assert results[name]["config_written"] is (text is None)
        assert len(results[name]["errors"]) == (0 if text is None else 1)
        assert text is None or results[name]["errors"][0].startswith(text), (name, results[name]["errors"])

    config = {r["dataset_id"]: r for r in spark.table("job.config").collect()}
    assert set(config) == {"GOOD", "FULL", "PROV"}
    good = config["GOOD"]
    assert (good["incremental_timestamp_field"], good["load_type"], good["incremental_timestamp_method"]) == ("META.ts", "INCREMENTAL", "TIMESTAMP_DATA_TABLE")
    assert (good["dataset_name"], good["source_database_name"], good["is_enabled"]) == ("Name of GOOD", "SRC_DB", True)
    assert good["last_process_datetime"] == {"t1": datetime(2025, 1, 1)} and good["last_run_time"] is None
    assert config["PROV"]["load_type"] is None and config["PROV"]["last_process_datetime"] == {}
    fields = spark.table("job.fields")
    assert rows(fields.filter("dataset_id = 'GOOD'"), "database_name", "table_name", "field_name") == [
        ("SRC_DB", "t1", "META.ts"), ("src_db", "t1", "id"),
    ]
    assert fields.select("field_id").distinct().count() == fields.count() == 6

    again = {r["dataset_id"]: r["status"] for r in run(unique=True).collect()}
    assert [again[n] for n in ("GOOD", "FULL", "PROV", "OFF")] == ["SKIPPED", "SKIPPED", "SKIPPED", "FAILED"]
    ran = spark.table("job.config").where("dataset_id = 'GOOD'").withColumn("last_run_time", F.lit(datetime(2025, 2, 1)))
    sinks.write_upsert(spark, "job.config", ran, keep=())
    once_more = {r["dataset_id"]: r["status"] for r in run(overwrite=True).collect()}
    assert once_more["GOOD"] == "SUCCESS" and spark.table("job.config").count() == 3
    # The sheet was loaded again; the times of the dataset's runs stay.
    assert rows(spark.table("job.config").where("last_run_time IS NOT NULL"), "dataset_id", "last_run_time") == [("GOOD", datetime(2025, 2, 1))]
    spark.sql("DROP DATABASE job CASCADE")
