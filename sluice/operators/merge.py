"""Pure forms of the sinks: old rows and incoming rows in, new table content out (K1-K4, K7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice import schemas as S
from sluice.operators.skew import existence_join


def replace_scope(target: DataFrame, incoming: DataFrame, keys: Sequence[str] = S.SCOPE) -> DataFrame:
    """K1: drop every target row whose scope is in ``incoming``, then add ``incoming``."""
    kept = existence_join(target, incoming, list(keys), "left_anti")
    return kept.unionByName(incoming.select(*target.columns))


def duplicate_keys(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    return incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def upsert(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str] = S.SCOPE, keep: Sequence[str] = ()
) -> DataFrame:
    """K2: matched keys take the incoming row, NULLs included; others are inserted or untouched.

    ``keep`` columns of matched rows stay as they are in the target. A key that comes twice in
    ``incoming`` fails the job. The side is chosen by a marker, never by a NULL test.
    """
    others = [c for c in target.columns if c not in keys]
    fault = F.concat(F.lit("duplicate key in incoming rows: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    single = (
        incoming.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*others)).alias("__new"))
        .withColumn("__in", F.when(F.col("__n") == 1, F.lit(True)).otherwise(F.raise_error(fault)))
        .select(*keys, "__new", "__in")
    )
    old = target.withColumn("__old", F.lit(True))
    joined = old.join(single, list(keys), "full_outer")
    matched = F.col("__in").isNotNull()
    kept_in_target = matched & F.col("__old").isNotNull()

    def pick(c: str):
        if c in keys:
            return F.col(c)
        new = F.col(f"__new.{c}")
        if c in keep:
            return F.when(kept_in_target, F.col(c)).when(matched, new).otherwise(F.col(c)).alias(c)
        return F.when(matched, new).otherwise(F.col(c)).alias(c)

    return joined.select(*[pick(c) for c in target.columns])


def append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """K3: all rows of both."""
    return target.unionByName(incoming.select(*target.columns))


def remove_datasets(config: DataFrame, fields: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """K4: both control tables without the given dataset ids, and the ids that were configured."""
    on = ["dataset_id"]
    wanted = ids.select("dataset_id").distinct()
    return (
        existence_join(config, wanted, on, "left_anti"),
        existence_join(fields, wanted, on, "left_anti"),
        existence_join(wanted, config, on, "left_semi"),
    )


def overwrite(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """K7: the incoming rows alone, in the columns of the target."""
    return incoming.select(*target.columns)
