"""Run bookkeeping on real control tables."""

from __future__ import annotations

from datetime import datetime

import pytest

from sluice import schemas as S
from sluice.operators import runs
from sluice.plans.runs import create_state_table, run_dataset, run_event, store_events
from sluice.sinks import manifest
from sluice.sinks import tables as sinks
from tests.helpers import rows
from tests.test_tables import MARKS, _config

FEB1, FEB2 = datetime(2025, 2, 1, 6, 0), datetime(2025, 2, 2, 6, 0)


@pytest.fixture()
def ctl(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS rn")
    sinks.create_control_table(spark, "rn.config", S.DATASET_CONFIG)
    create_state_table(spark, "rn.runs")
    daily = {"is_enabled": True, "schedule": "DAILY", "last_process_datetime": {"t": FEB1, "u": FEB1}}
    sinks.write_upsert(spark, "rn.config", _config(spark, ("d", "A", "x", daily), ("off", "A", None, {**daily, "is_enabled": False})))
    yield "rn"
    spark.sql("DROP DATABASE rn CASCADE")


def _post(spark, run_id, action, at=FEB1, dataset="d", marks=None):
    got = store_events(spark, "rn.config", "rn.runs", run_event(spark, dataset, "A", run_id, action, at), marks).collect()
    return got[0]["outcome"]


def test_a_run_from_start_to_finish(spark, ctl):
    marks = spark.createDataFrame([("d", "A", "t", FEB2)], MARKS)
    assert _post(spark, "r1", runs.FINISH) == "REJECTED"
    assert _post(spark, "r1", runs.START) == "ACCEPTED"
    assert _post(spark, "r1", runs.START) == "REPEATED"
    assert _post(spark, "r2", runs.START) == "REJECTED"
    assert rows(spark.table("rn.config"), "dataset_id", "last_run_time") == [("d", None), ("off", None)]
    before = manifest.current(spark, ctl).generation
    assert _post(spark, "r1", runs.FINISH, FEB2, marks=marks) == "ACCEPTED"
    # One commit: state, run times and watermarks.
    assert manifest.current(spark, ctl).generation == before + 1
    row = spark.table("rn.config").where("dataset_id = 'd'").first()
    assert (row["last_run_time"], row["next_run_due_time"], row["comments"]) == (FEB1, FEB2, "x")
    assert row["last_process_datetime"] == {"t": FEB2, "u": FEB1}
    assert rows(spark.table("rn.runs"), "run_id", "state", "started", "finished") == [("r1", "DONE", FEB1, FEB2)]
    later = spark.createDataFrame([("d", "A", "t", datetime(2025, 3, 1))], MARKS)
    assert _post(spark, "r1", runs.FINISH, datetime(2025, 2, 9), marks=later) == "REPEATED"
    assert manifest.current(spark, ctl).generation == before + 1
    assert spark.table("rn.config").where("dataset_id = 'd'").first() == row
    assert _post(spark, "r3", runs.START, FEB2) == "ACCEPTED" and _post(spark, "r3", runs.FAIL, FEB2) == "ACCEPTED"
    assert spark.table("rn.config").where("dataset_id = 'd'").first()["last_run_time"] == FEB1
    assert _post(spark, "r1", runs.START, dataset="off") == "REJECTED" and _post(spark, "r1", runs.START, dataset="unknown") == "REJECTED"


def test_of_two_starts_at_once_one_is_accepted(spark, ctl, monkeypatch):
    """The second start commits after the first one has read the state and before it commits."""
    real, outcomes = manifest.try_commit, []

    def late(session, db, planned):
        monkeypatch.setattr(manifest, "try_commit", real)
        outcomes.append(_post(spark, "r2", runs.START))
        return real(session, db, planned)

    monkeypatch.setattr(manifest, "try_commit", late)
    assert _post(spark, "r1", runs.START) == "REJECTED" and outcomes == ["ACCEPTED"]
    assert rows(spark.table("rn.runs"), "run_id", "state") == [("r2", "RUNNING")]


def test_a_run_moves_its_watermarks_only_when_its_rows_are_stored(spark, ctl, tmp_path):
    sinks.create_control_table(spark, "rn.fields", S.INPUT_FIELDS)
    method = {"load_type": "INCREMENTAL", "incremental_timestamp_method": "TIMESTAMP_DATA_TABLE", "incremental_timestamp_field": "ts"}
    sinks.write_upsert(spark, "rn.config", _config(spark, ("e", "A", None, {
        **method, "is_enabled": True, "schedule": "DAILY", "last_process_datetime": {"t": FEB1}})))
    fields = spark.createDataFrame([("e", "db", "t", "id", "A", None, 2), ("e", "db", "gone", "id", "A", None, 3)], "dataset_id string, database_name string, table_name string, field_name string, stage string, comments string, row_no long")
    sinks.write_input_fields(spark, "rn.fields", fields)
    sources = {"t": spark.createDataFrame([(1, FEB1), (2, FEB2)], "id int, ts timestamp")}
    folder = str(tmp_path / "out")

    def run(run_id, store):
        return run_dataset(spark, "rn.config", "rn.fields", "rn.runs", sources, "e", "A", run_id, store, lambda: FEB2)

    def lost(fetched):
        raise OSError("target is gone")

    with pytest.raises(OSError, match="target is gone"):
        run("r1", lost)
    config = lambda: spark.table("rn.config").where("dataset_id = 'e'").first()
    assert config()["last_process_datetime"] == {"t": FEB1} and config()["last_run_time"] is None
    assert rows(spark.table("rn.runs").where("dataset_id = 'e'"), "run_id", "state") == [("r1", "FAILED")]
    faults = []

    def stored(fetched):
        fetched.tables["t"].write.mode("overwrite").parquet(folder)
        faults.extend(r["message"] for r in fetched.faults.collect())

    assert run("r2", stored) == "ACCEPTED"
    assert rows(spark.read.parquet(folder), "id") == [(2,)] and faults == ["Declared table 'gone' is not among the sources"]
    assert config()["last_process_datetime"] == {"t": FEB2} and config()["last_run_time"] == FEB2
    assert run("r2", lost) == "REPEATED"


def test_two_events_of_one_scope_fail(spark, ctl):
    both = run_event(spark, "d", "A", "r1", runs.START, FEB1).union(run_event(spark, "d", "A", "r1", runs.FINISH, FEB2))
    with pytest.raises(Exception, match="two run events"):
        store_events(spark, "rn.config", "rn.runs", both)
