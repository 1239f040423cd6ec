"""Session helpers: a local session for tests/bench and shared scratch locations.

Library code never changes global session settings; only ``local_session``
(tests, bench) sets configuration, and ``wide_rows`` the size of batches while an
operator with wide rows runs, unless the user has set it.  Scratch data always goes below the
cluster's shared checkpoint folder (``spark.checkpoint.dir``).  A private folder,
deleted when the process ends, is made only for a ``local`` master without that
setting (tests); on a cluster a missing setting is an error, because executors
would write to disks that nobody else can read.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlens") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Scratch folders written by this process, by Spark application.
_WRITTEN: dict[str, list[str]] = {}


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``)."""
    return re.match(r"local($|\[)", spark.sparkContext.master) is not None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a private one only for a local master without the setting."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/cohortlens-{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_paths(spark: SparkSession) -> list[str]:
    """The scratch folders this process has written for the application and not released."""
    return list(_WRITTEN.get(spark.sparkContext.applicationId, []))


def release_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete scratch folders this process has written for the application (all, or ``paths``); the number of folders.

    For callers that run many jobs in one application: call it when no frame built on that
    scratch data is needed any more."""
    jvm = spark.sparkContext._jvm
    written = scratch_paths(spark)
    gone = [p for p in written if paths is None or p in paths]
    for p in gone:
        target = jvm.org.apache.hadoop.fs.Path(p)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _WRITTEN[spark.sparkContext.applicationId] = [p for p in written if p not in gone]
    return len(gone)


def cut_lineage(df: DataFrame, name: str = "stage", row_group: int | None = None) -> DataFrame:
    """Cut the lineage with a table written to the shared checkpoint folder (Parquet),
    read back; never a local checkpoint or a machine-local folder.

    Used before iterative work (model sweeps, multi-pass fits) so that a lost executor
    only re-reads the written table instead of recomputing the whole upstream plan.
    Parquet is columnar and compressed, so this is cheaper than ``Dataset.checkpoint``'s
    row serialisation.  Files keep the partitioning and in-partition order of ``df``.
    ``row_group`` is the size in bytes of a file's row groups: a file is read by as many tasks as it has row groups at most.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    (writer if row_group is None else writer.option("parquet.block.size", row_group)).parquet(path)
    return spark.read.parquet(path)


#: Bytes of rows passed to Python at a time, and rows of a Parquet file read at a time, within ``wide_rows``.
WIDE_ROWS = {"spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20), "spark.sql.parquet.columnarReaderBatchSize": "512"}


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Batches for rows of kilobytes: Spark's defaults (10 000 rows for Python, 4 096 for Parquet) would be tens of megabytes in each of several buffers of a task.

    Counts for what is written inside; rows and results are the same.  Settings that the session has stay, the others are taken back."""
    given = spark.conf.getAll
    own = {k: v for k, v in WIDE_ROWS.items() if k not in given}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in own:
            spark.conf.unset(k)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
