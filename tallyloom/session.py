"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # Dates are compared as calendar days; a fixed zone keeps them stable.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small inputs stay spread over the cores; large ones never come near this size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: str = "*", app: str = "tallyloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        # Call-site capture costs a round trip per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which all executors see.

    Where none is named, a folder in the warehouse. On a cluster a warehouse in the driver's own
    file system is refused, as executors do not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if not spark.sparkContext.master.startswith("local[") and warehouse.startswith("file:"):
            raise ValueError("name a folder that all executors see in spark.checkpoint.dir")
        base = f"{warehouse}/_work"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files, wherever it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Rows that fill a partition of a settled frame, and partitions that any one may have.
SETTLED_ROWS, SETTLED_PARTS = 50_000, 8


def settle(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Compute a small, often used frame once and cut its lineage there.

    ``rows`` is a bound of its rows, where one is known: a checkpoint is a file a partition, and
    so many rows need no more than that many.
    """
    shared_folder(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(SETTLED_PARTS, -(-rows // SETTLED_ROWS)))
    return df.checkpoint()


#: Bytes up to which an input counts as small.
SMALL_INPUT = 64 << 20


#: Bytes of input that one task takes where a row costs much or becomes many.
TASK_INPUT = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal an input to tasks of at most about TASK_INPUT bytes, and to all cores, before work that is heavy per row.

    Splits of a file are sized for reading: work on one would grow with the file.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_INPUT)))


def fill_cores(df: DataFrame) -> DataFrame:
    """Spread an input of a few megabytes over the cores before work that is heavy per row.

    So little is not split by itself and cheap to shuffle on any cluster; a larger input is
    returned as it is.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= SMALL_INPUT else df
