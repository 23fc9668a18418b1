"""Session settings the operators assume, and the one place that cuts lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Joins carry no broadcast hint: Spark broadcasts a side whose size estimate is below the
# threshold and otherwise shuffles, and AQE then splits skewed partitions. Sides that grow with the
# datasets are always shuffled (`operators/skew.py`).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    # Timestamps of the default kind have no statistics, so no bound would skip a row group of them.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Semi joins with few new headers test a Bloom filter of their keys before the data is shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset, as in local tests: a folder of this application under the warehouse. On a cluster
    a warehouse in a machine-local folder is refused, as executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named.rstrip("/")
    master, place = spark.sparkContext.master, spark.conf.get("spark.sql.warehouse.dir")
    if not master.startswith("local") and place.startswith(("file:", "/")):
        raise ValueError(f"set spark.checkpoint.dir to a folder all executors share; the warehouse {place} is local")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_staged/{spark.sparkContext.applicationId}"


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes to a folder of its own, which is deleted at the end, also on failure."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, keep: bool = False) -> str:
    """``df`` written once as parquet in the shared folder; returns the path.

    ``keep`` leaves it there when a surrounding ``scratch`` ends.
    """
    folder = None if keep else _scratch.get()
    path = f"{folder or shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def cut_lineage(df: DataFrame, keep: bool = False) -> DataFrame:
    """``df`` staged and read back.

    Later steps read only the columns they need from it, and a lost executor costs a read instead
    of the whole plan before it.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stage(df, keep))


def cut_lineage_by(df: DataFrame, column: str) -> DataFrame:
    """``df`` staged and read back in buckets of ``column``, as many as a shuffle has partitions.

    Steps that group or join on this column move the other side to it, and not the staged rows again. The catalog
    names the buckets only until the read is planned; the files stay where ``stage`` would write them.
    """
    spark = df.sparkSession
    path = f"{_scratch.get() or shared_folder(spark)}/{uuid.uuid4().hex}"
    name = f"staged_{uuid.uuid4().hex}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", path).format("parquet").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
