"""Joins that hold when one key owns a third of the rows, or when the keys are as many as the datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALTS = 16

_SALT = "__salt"


def _hashable(dtype: T.DataType) -> bool:
    """Spark hashes every type but maps and variants, at any depth."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    return not isinstance(dtype, T.StructType) or all(_hashable(f.dataType) for f in dtype.fields)


def _salted(
    left: DataFrame, keys: DataFrame, on: Sequence[str], salts: int
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Spread the rows of a key over ``salts`` partitions; the few keys are repeated.

    The salt adds the number of the map partition to a hash of the row: copies of one row spread
    as well, and a task that runs again puts each row in the same place whatever the order of its
    input. The extra join column also gives the key side a shuffle of its own, which AQE needs to
    split a skewed partition. One salt means none: for a left side whose keys are unique.
    """
    distinct = keys.select(*on).distinct()
    if salts == 1:
        return left, distinct, list(on)
    hashable = [f.name for f in left.schema.fields if _hashable(f.dataType)]
    # Reduced before the sum: a 64-bit hash plus anything may overflow.
    row = F.pmod(F.xxhash64(*hashable), F.lit(salts))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (
        left.withColumn(_SALT, F.pmod(row + F.spark_partition_id(), F.lit(salts)).cast("int")),
        distinct.withColumn(_SALT, every_salt),
        [*on, _SALT],
    )


def never_broadcast(side: DataFrame) -> DataFrame:
    """``side`` of a join, shuffled whatever Spark takes for its size.

    For sides that grow with the datasets. Before they run, their size is guessed from that of the files, without what
    repeats a row (sheet keys, salts), so the threshold holds back no broadcast that the driver has no room for.
    """
    return side.hint("merge")


def existence_join(
    left: DataFrame, keys: DataFrame, on: Sequence[str], how: str, salts: int = SALTS, many: bool = False
) -> DataFrame:
    """``left_semi`` or ``left_anti`` of ``left`` with the distinct ``on`` values of ``keys``.

    ``many`` keys, such as dataset ids, are never broadcast.
    """
    spread, every, columns = _salted(left, keys, on, salts)
    return spread.join(never_broadcast(every) if many else every, columns, how).select(*left.columns)


def flag_existing(left: DataFrame, keys: DataFrame, on: Sequence[str], flag: str, salts: int = SALTS) -> DataFrame:
    """All rows of ``left`` with a boolean column telling whether its ``on`` values are in ``keys``."""
    spread, every, columns = _salted(left, keys, on, salts)
    marked = spread.join(every.withColumn(flag, F.lit(True)), columns, "left_outer")
    return marked.select(*left.columns, F.coalesce(flag, F.lit(False)).alias(flag))
