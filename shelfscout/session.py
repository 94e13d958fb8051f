"""Session settings and the shared scratch area."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: everything here may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot user or item may own a third of a shuffled table. Let the reader split that partition
    # even where the split costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows that carry a block of vectors or a long text are large: bound what one Arrow batch holds, once in the JVM and twice in Python.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every job in this package relies on; returns the same session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # Functions that run in tasks travel with them, so executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules["shelfscout"])
    return spark


def local_session(app_name: str = "shelfscout", cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark. On a cluster use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediates: the shared one the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="shelfscout-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return os.path.join(shared, "shelfscout")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that nothing refers to any more; it looks for them when the driver's heap is collected."""
    spark.sparkContext._jvm.System.gc()


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Tables spilled inside are removed at the end of the block, however it ends.

    What is read later is written by the function this yields, which takes what ``spill`` takes and belongs to the
    block around this one, if there is one.
    """
    mine: list[str] = []
    outer = _passing.get()
    token = _passing.set(mine)

    def lasting(df: DataFrame, *options: str) -> DataFrame:
        inner = _passing.set(outer)
        try:
            return spill(df, *options)
        finally:
            _passing.reset(inner)

    try:
        yield lasting
    finally:
        _passing.reset(token)
        for path in mine:
            discard(spark, path)


def task_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spill(df: DataFrame, label: str = "spill", spread_by: str | None = None) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    This cuts the lineage, survives the loss of executors, freezes values that depend on the physical
    plan (partition ids) and gives later joins a measured size to choose by. ``spread_by`` keeps the rows in
    ``spark.sql.shuffle.partitions`` parts, for tables that are small in bytes but costly to work through.
    """
    spark = df.sparkSession
    if spread_by is not None:
        df = df.repartition(task_count(spark), spread_by)
    path = scratch_path(spark, label)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
