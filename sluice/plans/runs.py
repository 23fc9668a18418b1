"""Runs against the control tables: each step is one commit, accepted once."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.operators import runs
from sluice.operators.skew import existence_join
from sluice.plans.fetch import Fetched, incremental_fetch, with_watermarks
from sluice.session import cut_lineage, scratch
from sluice.sinks import manifest
from sluice.sinks import tables as sinks

EVENT = "dataset_id string, stage string, run_id string, action string, at timestamp"


def create_state_table(spark: SparkSession, table: str) -> None:
    sinks.create_control_table(spark, table, S.RUN_STATE)


def run_event(spark: SparkSession, dataset_id: str, stage: str, run_id: str, action: str, at: datetime) -> DataFrame:
    return spark.createDataFrame([(dataset_id, stage, run_id, action, at)], EVENT)


def store_events(
    spark: SparkSession, config_table: str, states_table: str, events: DataFrame, watermarks: DataFrame | None = None
) -> DataFrame:
    """Applies run events, one per scope; returns (dataset_id, stage, event_run_id, action, outcome, state).

    The state rows, the run times of finished runs and their ``watermarks`` (dataset_id, stage, table_name, last_ts) become
    visible with one commit. If another writer commits in between, the events are judged again on what it left, so of
    two starts one is accepted. Watermarks of events that are not accepted are left as they were.
    """
    db = manifest.database_of(spark, config_table)
    while True:
        with scratch(spark):
            base = manifest.current(spark, db)
            config, states = manifest.snapshot(spark, [config_table, states_table], base)
            keys = list(S.SCOPE)
            scopes = events.select(*keys).distinct()
            own = cut_lineage(existence_join(config, scopes, keys, "left_semi", salts=1))
            moved = cut_lineage(runs.transitions(own, existence_join(states, scopes, keys, "left_semi", salts=1), events))
            accepted = moved.where(F.col("outcome") == runs.ACCEPTED)
            # One small row for each event, which outlives what is staged here.
            outcomes = cut_lineage(moved.select(*keys, "event_run_id", "action", "outcome", "state"), keep=True)
            if accepted.isEmpty():
                return outcomes
            changed = runs.run_times(own, moved)
            if watermarks is not None:
                # Only a finished run moves its watermarks; the others keep their MAP.
                advanced = with_watermarks(changed, watermarks)
                changed = advanced.unionByName(existence_join(changed, advanced, keys, "left_anti", salts=1))
            writes = [
                sinks.upserted(states_table, accepted.select(*S.RUN_STATE.names), keep=()),
                sinks.upserted(config_table, cut_lineage(changed), keep=()),
            ]
            if manifest.commit(spark, writes, base=base) is not None:
                return outcomes


def run_dataset(
    spark: SparkSession, config_table: str, fields_table: str, states_table: str, sources: Mapping[str, DataFrame],
    dataset_id: str, stage: str, run_id: str, store: Callable[[Fetched], None], clock: Callable[[], datetime],
    data_links: Mapping[str, str] | None = None,
) -> str:
    """One run: start, fetch what is new, ``store`` it, finish; returns the outcome of the last event.

    ``store`` writes the fetched tables wherever they belong and should replace what an earlier attempt of this
    ``run_id`` left; a run that is done is not run again. Watermarks move with the finish, in one commit with state and run times: a run that ends
    before it fetches the same rows again. What the fetch staged is deleted when the run ends. A failure is recorded,
    then raised.
    """
    def post(action: str, watermarks: DataFrame | None = None) -> Row:
        event = run_event(spark, dataset_id, stage, run_id, action, clock())
        return store_events(spark, config_table, states_table, event, watermarks).first()

    begun = post(runs.START)
    if begun["outcome"] == runs.REJECTED or begun["state"] != runs.RUNNING:
        return begun["outcome"]
    with scratch(spark):
        try:
            config, fields = manifest.snapshot(spark, [config_table, fields_table])
            fetched = incremental_fetch(config, fields, sources, dataset_id, stage, data_links)
            store(fetched)
            return post(runs.FINISH, fetched.watermarks)["outcome"]
        except Exception:
            post(runs.FAIL)
            raise
