"""Run bookkeeping: the state of each dataset's run, and the run times that follow from it.

A scope (dataset, stage) has at most one state row, that of its latest run. An event moves it only from the state
it expects, so a finish that comes twice, or a start while another run is at work, changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.operators.merge import upsert
from sluice.operators.schedule import next_due

# Fixed values of this engine: states and events.
RUNNING, DONE, FAILED = "RUNNING", "DONE", "FAILED"
START, FINISH, FAIL = "START", "FINISH", "FAIL"
ACCEPTED, REPEATED, REJECTED = "ACCEPTED", "REPEATED", "REJECTED"


def transitions(config: DataFrame, states: DataFrame, events: DataFrame) -> DataFrame:
    """One row per event: its scope, run_id, outcome, and the state the scope is in after it.

    ``events`` is (dataset_id, stage, run_id, action, at), one per scope; two of one scope fail the job. A start is accepted
    for an enabled dataset that has no run at work; a finish or a failure for the run that is. The same event
    once more is REPEATED, any other REJECTED; neither changes the state.
    """
    keys = list(S.SCOPE)
    twice = F.concat(F.lit("two run events for "), F.concat_ws(", ", *keys))
    asked = events.groupBy(*keys).agg(F.count("*").alias("n"), F.any_value(F.struct("run_id", "action", "at")).alias("e"))
    asked = asked.select(*keys, F.when(F.col("n") == 1, F.col("e")).otherwise(F.raise_error(twice)).alias("e"))
    enabled = config.select(*keys, F.coalesce("is_enabled", F.lit(False)).alias("enabled"))
    held = states.select(*keys, F.struct("run_id", "state", "started", "finished").alias("s"))
    both = asked.join(enabled, keys, "left").join(held, keys, "left")
    own = F.coalesce(F.col("s.run_id") == F.col("e.run_id"), F.lit(False))
    state, action = F.col("s.state"), F.col("e.action")
    goal = F.when(action == FINISH, DONE).when(action == FAIL, FAILED)
    start = (
        F.when(own, REPEATED)
        .when(F.coalesce("enabled", F.lit(False)) & (state.isNull() | (state != RUNNING)), ACCEPTED)
        .otherwise(REJECTED)
    )
    end = F.when(own & (state == RUNNING), ACCEPTED).when(own & (state == goal), REPEATED).otherwise(REJECTED)
    moved = both.withColumn("outcome", F.when(action == START, start).when(goal.isNotNull(), end).otherwise(REJECTED))
    accepted = F.col("outcome") == ACCEPTED
    begun = accepted & (action == START)
    after = F.when(begun, F.struct(F.col("e.run_id").alias("run_id"), F.lit(RUNNING).alias("state"), F.col("e.at").alias("started"), F.lit(None).cast("timestamp").alias("finished")))
    after = after.when(accepted, F.struct(F.col("s.run_id").alias("run_id"), goal.alias("state"), F.col("s.started").alias("started"), F.col("e.at").alias("finished")))
    return moved.select(*keys, F.col("e.run_id").alias("event_run_id"), "e.action", "outcome", after.otherwise(F.col("s")).alias("after")).select(
        *keys, "event_run_id", "action", "outcome", "after.*"
    )


def next_states(states: DataFrame, moved: DataFrame) -> DataFrame:
    """The state rows after the accepted events."""
    return upsert(states, moved.where(F.col("outcome") == ACCEPTED).select(*states.columns), S.SCOPE)


def run_times(config: DataFrame, moved: DataFrame) -> DataFrame:
    """Config rows of runs that are done now: last_run_time is their start, next_run_due_time what the schedule says after it.

    A failed run leaves both, so its dataset stays due.
    """
    keys = list(S.SCOPE)
    done = moved.where((F.col("outcome") == ACCEPTED) & (F.col("state") == DONE)).select(*keys, F.col("started").alias("__run"))
    rows = config.join(done, keys)
    due = next_due(rows, F.col("__run"), "__run").select(*keys, F.col("next_run_due_time").alias("__due"))
    out = rows.join(due, keys, "left")
    times = {"last_run_time": F.col("__run"), "next_run_due_time": F.col("__due")}
    return out.select(*[times[c].cast(config.schema[c].dataType).alias(c) if c in times else F.col(c) for c in config.columns])


def record_run(config: DataFrame, states: DataFrame, events: DataFrame) -> DataFrame:
    """Every event with its outcome, the state after it, and the run times its dataset then has."""
    keys = list(S.SCOPE)
    moved = transitions(config, states, events)
    changed = run_times(config, moved).select(*keys, *[F.col(c).alias(f"__{c}") for c in S.RUN_TIMES], F.lit(True).alias("__done"))
    kept = moved.join(config.select(*keys, *S.RUN_TIMES), keys, "left").join(changed, keys, "left")
    return kept.select(
        *moved.columns, *[F.when(F.col("__done"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in S.RUN_TIMES]
    )
