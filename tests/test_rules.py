"""Row-wise rules: the cases a user of the sheets relies on."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.functions.stamps import parse_start_date
from sluice.functions.text import strip, to_bool
from sluice.operators import rules, sheets
from tests.helpers import literal, messages, rows, wide_params

SHEETS = ["Specification", "Input Schema", "DPS-CDP Params"]


@pytest.mark.parametrize(
    ("present", "missing"),
    [
        (SHEETS, None),
        ([*SHEETS, "Notes", "Mappings"], None),
        (SHEETS[:2], "{'DPS-CDP Params'}"),
        ([], "{'DPS-CDP Params', 'Input Schema', 'Specification'}"),
        (["specification", " Input Schema ", "DPS-CDP Params"], "{'Input Schema', 'Specification'}"),
    ],
)
def test_required_sheets(spark, present, missing):
    datasets = literal(spark, dataset_id="ds1")
    found = spark.createDataFrame([("ds1", s) for s in present], "dataset_id string, sheet string")
    got = messages(rules.check_sheets(found, datasets))
    assert got == ([] if missing is None else [f"Missing required sheets: {missing}"])


SCHEDULE_CASES = [
    ("DAILY", None, None, None),
    ("WEEKLY", "MON,WED", None, None),
    ("WEEKLY", "MON,TUE", "", None),
    ("MONTHLY", None, "1,15,31", None),
    ("MONTHLY", "", "1,15,31", None),
    ("HOURLY", None, None, "Invalid schedule 'HOURLY'"),
    ("daily", None, None, "Invalid schedule 'daily'"),
    ("DAILY", "MON", None, "For DAILY schedule"),
    ("DAILY", None, "1,15", "For DAILY schedule"),
    ("WEEKLY", None, None, "'Week Days' must not be empty"),
    ("WEEKLY", "MON", "1", "For WEEKLY schedule, 'Dates Of Month'"),
    ("MONTHLY", None, None, "'Dates Of Month' must not be empty"),
    ("MONTHLY", "MON", "1,15", "For MONTHLY schedule, 'Week Days'"),
    (None, None, None, "Invalid schedule 'None'"),
]


def test_schedule(spark):
    data = [(i, s, w, d) for i, (s, w, d, _) in enumerate(SCHEDULE_CASES)]
    df = spark.createDataFrame(data, "i int, s string, w string, d string")
    got = {r["i"]: r["text"] for r in df.select("i", rules.schedule_fault("s", "w", "d").alias("text")).collect()}
    for i, (*_, expected) in enumerate(SCHEDULE_CASES):
        assert (got[i] is None) if expected is None else (expected in got[i]), SCHEDULE_CASES[i]


def test_file_format(spark):
    good = ["report.xlsx", "legacy.xls", "DBFS:/mnt/data/Report.XLSX", "s3://bucket/folder/file.XlS"]
    bad = ["data.csv", "report.xlsx.gz", "no_extension", "", None, "file.xlsm", "file.xlsx?version=1"]
    df = spark.createDataFrame([(str(i), p) for i, p in enumerate(good + bad)], "dataset_id string, path string")
    flagged = {int(r["dataset_id"]) for r in rules.check_file_format(df).collect()}
    assert flagged == set(range(len(good), len(good) + len(bad)))


@pytest.mark.parametrize(
    ("value", "enabled"),
    [("TRUE", True), (None, True), ("", True), ("true", True), ("No", True), ("FALSE", False), ("False", False), (" false ", False)],
)
def test_enabled(spark, value, enabled):
    params = wide_params(spark, {"Is Enabled": value})
    assert rules.enabled_only(params).count() == int(enabled)
    text = "Dataset ds1 is disabled (Is Enabled = FALSE). Skipping load."
    assert (text in messages(rules.check_scalar(params))) is not enabled


def test_to_bool(spark):
    words = ["true", " YES ", "1", "y", "no", "0", "", None, "tru"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    assert [r[0] for r in df.orderBy("i").select(to_bool("w")).collect()] == [True] * 4 + [False] * 5


def test_identity(spark):
    data = [("DS1", "DS1", "ds1"), ("DS2", "ds2", "other"), ("DS3", None, "DS3"), ("DS4", "DS5", None), ("001", "001", "001")]
    spec = spark.createDataFrame(data, "dataset_id string, externalid string, dataset_name string")
    assert rows(rules.check_identity(spec), "dataset_id", "message") == [
        ("DS3", "Dataset ID mismatch between param and file"),
        ("DS4", "Dataset ID mismatch between param and file"),
    ]
    both = rows(rules.check_identity(spec, check_name=True), "dataset_id", "rule")
    assert [r for r in both if r[1] == "dataset_name"] == [("DS2", "dataset_name"), ("DS4", "dataset_name")]


def test_spec_layout(spark):
    schema = "dataset_id string, row_no int, label string, value string"
    good = [("ok", i, label, "some_value") for i, label in enumerate(S.SPEC_LABELS, 1)]
    wrong = [("label", i, "Porpoise" if i == 4 else label, "v") for i, label in enumerate(S.SPEC_LABELS, 1)]
    blank = [("blank", i, label, " " if i == 3 else "v") for i, label in enumerate(S.SPEC_LABELS, 1)]
    short = [("short", i, label, "v") for i, label in enumerate(S.SPEC_LABELS[:7], 1)]
    found = rules.check_spec_layout(spark.createDataFrame(good + wrong + blank + short, schema))
    assert rows(found, "dataset_id", "row_no", "message") == [
        ("blank", 3, "Missing value for 'Data Sharing Agreement (DSA)' at row 3"),
        ("label", 4, "Row 4 mismatch: expected 'Purpose', found 'Porpoise'"),
        ("short", 0, "Specification sheet must contain 10 rows, found 7."),
    ]


def _params(**changes):
    base = {
        "Stage": "StageA", "Pet Dataset ID": "p1", "Load Type": "INCREMENTAL",
        "Incremental Timestamp Method": "TIMESTAMP_DATA_TABLE", "Incremental Timestamp Field": "event_ts", "Schedule": "DAILY",
    }
    return {**base, **{k.replace("_", " "): v for k, v in changes.items()}}


@pytest.mark.parametrize(
    ("changes", "expected"),
    [
        ({}, []),
        ({"Incremental_Timestamp_Method": "timestamp-header-table", "Incremental_Header_To_Tables_Link_Field": "t_hdr.id"}, []),
        ({"Load_Type": "FULL", "Incremental_Timestamp_Field": "", "Schedule": None}, []),
        ({"Stage": "DATA-PROVISIONING", "Load_Type": "nonsense"}, []),
        ({"Stage": None}, [50]),
        ({"Pet_Dataset_ID": " "}, [51]),
        ({"Load_Type": "DELTA"}, [52]),
        ({"Incremental_Timestamp_Field": ""}, [53]),
        ({"Load_Type": "full"}, [55]),
        ({"Incremental_Timestamp_Method": "SOMETHING_ELSE"}, [56]),
        ({"Incremental_Timestamp_Method": "TIMESTAMP_HEADER_TABLE"}, [57]),
        ({"Schedule": "WEEKLY"}, [54]),
        ({"Start_Process_From_Date": "05/02/2025"}, [71]),
    ],
)
def test_params(spark, changes, expected):
    params = wide_params(spark, {"Database Name": "db", **_params(**changes)})
    assert sorted(r["rule_no"] for r in rules.check_scalar(params).collect()) == expected


@pytest.mark.parametrize(
    ("days", "dates", "expected"),
    [
        ("sunday, MONDAY", None, []),
        ("Funday,Monday,mon", None, ["Invalid Week Days: {'Funday', 'Mon'}"]),
        (None, "1, 15 ,28", []),
        (None, "1,29", ["Dates Of Month must be between 1 and 28. Invalid: 29"]),
        (None, "1,,2", ["Dates Of Month must be between 1 and 28. Invalid: "]),
        (None, "x", ["Dates Of Month must be between 1 and 28. Invalid: x"]),
        (None, "99999999999999", ["Dates Of Month must be between 1 and 28. Invalid: 99999999999999"]),
        ("", "", []),
    ],
)
def test_calendar(spark, days, dates, expected):
    params = wide_params(spark, _params(Week_Days=days, Dates_Of_Month=dates))
    assert messages(rules.check_calendar(params)) == expected


def test_start_date(spark):
    cases = {
        "2025-01-01 12:34:56": datetime(2025, 1, 1, 12, 34, 56), " 2025-02-05 ": datetime(2025, 2, 5),
        "2025-2-5": datetime(2025, 2, 5), "05/02/2025": None, "2025-13-01": None, "2025-02-30": None,
        "2025-01-01T00:00:00": None, "": None, None: None, "2025-01-01 25:00:00": None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(parse_start_date("t")).collect()] == list(cases.values())


def test_strip_removes_every_whitespace(spark):
    text = "\t  a b\r\n "
    assert literal(spark, t=text).select(strip("t")).first()[0] == text.strip() == "a b"


def test_first_error(spark):
    found = spark.createDataFrame(
        [("a", 41, 9, "x", "late row"), ("a", 41, 3, "x", "early row"), ("a", 52, 0, "x", "later rule"), ("b", 30, 0, "x", "off")],
        S.VIOLATION,
    )
    datasets = spark.createDataFrame([("a",), ("b",), ("c",)], "dataset_id string")
    assert rows(rules.first_error(found, datasets), "dataset_id", "status", "errors") == [
        ("a", "FAILED", ["early row"]), ("b", "FAILED", ["off"]), ("c", "SUCCESS", []),
    ]


def test_duplicate_and_alike_keys(spark):
    pairs = spark.createDataFrame(
        [
            ("d", 2, "Stage", "one"), ("d", 3, "stage", "two"), ("d", 4, " Stage ", "three"),
            ("d", 5, "  ", "no key"), ("d", 6, "Load  Type", " full "), ("d", 7, "Load Type", None), ("e", 2, "junk", "x"),
        ],
        "dataset_id string, row_no int, key string, value string",
    )
    entries = sheets.param_map(pairs).select("dataset_id", F.posexplode("params").alias("pos", "key", "value"))
    # The last value of a key wins and keeps the first place.
    assert rows(entries.filter("dataset_id = 'd'"), "pos", "key", "value") == [(0, "Stage", "three"), (1, "stage", "two"), (2, "Load  Type", "full"), (3, "Load Type", None)]
    # Among keys that differ by case and spaces only, the first one wins.
    assert rows(sheets.param_get(pairs, "STAGE"), "dataset_id", "value")[0] == ("d", "three")
    wide = {r["dataset_id"]: r for r in sheets.param_columns(pairs).collect()}
    assert (wide["d"]["stage"], wide["d"]["load_type"], wide["d"]["schedule"]) == ("three", "full", None)
    assert wide["e"]["stage"] is None


def test_clean_input_fields(spark):
    from tests.helpers import field_rows

    raw = field_rows(
        spark, ("", "t1", "meta.ts"), ("   ", "   ", "   "), (" lake", "t2 ", " c1 "), ("", "", None), ("lake", "t1", "meta.ts")
    )
    assert rows(sheets.clean_input_fields(raw, "lake"), "row_no", "database_name", "table_name", "column_name") == [
        (2, "lake", "t1", "meta.ts"), (4, "lake", "t2", "c1"), (6, "lake", "t1", "meta.ts"),
    ]
    fields = sheets.clean_input_fields(raw, "lake")
    assert rows(sheets.declared_tables(fields), "database_name", "table_name", "first_row") == [("lake", "t1", 2), ("lake", "t2", 4)]
    assert rows(sheets.candidate_tables(raw), "table_name", "first_row") == [("t1", 2), ("t2", 4)]
