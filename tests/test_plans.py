"""Shape of the physical plans that matter at scale."""

from __future__ import annotations

import pytest

from checks import queries as registered

SF = "/root/testdata/sf0.001"
JOINING = (
    "a3_incremental_by_table", "a6_advance_by_header", "a6_advance_watermarks", "incremental_fetch", "j1_missing_databases",
    "j2_check_fields", "j3_locate_param_field", "j4_resolve_timestamp_field", "j5_dataset_conflicts", "j6_incremental_by_header",
    "j7_dataset_overview", "k1_replace_scope", "k2_upsert", "k4_remove_datasets", "k5_assign_field_ids",
)


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(spark, name, capsys):
    registered.queries()[name](spark, SF).explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", JOINING)
def test_joins_are_equi_joins(no_broadcast, capsys, name):
    plan = _plan(no_broadcast, name, capsys)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BroadcastHashJoin" not in plan


def test_bounds_reach_the_scan(spark, capsys):
    by_table = _plan(spark, "a3_incremental_by_table", capsys)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in by_table
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in by_table
    by_header = _plan(spark, "j6_incremental_by_header", capsys)
    assert "GreaterThan(o_orderdate,1999-01-01T00:00)" in by_header
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in by_header


def test_fetch_shuffles_nothing(spark, capsys):
    for name in ("a4_full_fetch", "a5_project_declared", "a9_next_due"):
        assert "Exchange" not in _plan(spark, name, capsys)
