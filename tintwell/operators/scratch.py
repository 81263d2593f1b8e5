"""Written intermediate tables, so that a lost executor never costs more than one step."""

from __future__ import annotations

import atexit
import contextlib
import os
import sysconfig
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_own_root: str | None = None
_shipped: set[str] = set()
_homes: set[str] = set()
_scopes: list[list[DataFrame]] = []


def root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a temporary one where none is named, in local mode alone."""
    global _own_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("steps are written to the shared folder in spark.checkpoint.dir, and this session names none")
    if _own_root is None:
        _own_root = tempfile.mkdtemp(prefix="tintwell-")
        atexit.register(_remove_own)
    return _own_root


def _remove_own() -> None:
    import shutil

    shutil.rmtree(_own_root, ignore_errors=True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back; shuffle files of the write are dropped at once."""
    spark, path = df.sparkSession, _place(df.sparkSession, label)
    with _shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tintwell_path = path
    return _held(out)


def _place(spark: SparkSession, label: str) -> str:
    """A new path in the application's folder, which is removed at the interpreter's end, even if the session has ended."""
    home = f"{root(spark)}/{spark.sparkContext.applicationId}"
    if home not in _homes:
        _homes.add(home)
        atexit.register(_remove, *_files(spark), home)
    return f"{home}/{label}-{uuid.uuid4().hex}"


def folder(spark: SparkSession, label: str) -> str:
    """A new path for files that are written and read again, removed with the application's other ones."""
    return _place(spark, label)


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    with contextlib.suppress(Exception):
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with contextlib.suppress(Exception):
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def _held(table: DataFrame) -> DataFrame:
    for tables in _scopes:
        tables.append(table)
    return table


def bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """df written once in buckets by a column, so that later joins on it move the other side alone.

    There are about as many buckets as the size of df has splits, and as many as a shuffle has partitions at least. The table lies beside the
    staged ones and is known to the session's catalog until it is dropped.
    """
    spark = df.sparkSession
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # With fewer buckets than a shuffle has partitions Spark would deal this side anew when the other has been dealt by the key.
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    wanted = -(-size // split) if size < 1 << 60 else 0  # rows of the session have no known size
    n = min(int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")), max(least, wanted))
    path, name = _place(spark, label), f"tintwell_{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.repartition(n, key).write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    out._tintwell_path, out._tintwell_table = path, name
    return _held(out)


@contextlib.contextmanager
def scope() -> Iterator[list[DataFrame]]:
    """The tables that staged() writes meanwhile, so that whoever knows that they are read no more can drop() them."""
    held: list[DataFrame] = []
    _scopes.append(held)
    try:
        yield held
    finally:
        _scopes.remove(held)


def drop(df: DataFrame) -> None:
    """Delete a table that staged() wrote and that no later frame reads."""
    path = getattr(df, "_tintwell_path", None)
    if path:
        if hasattr(df, "_tintwell_table"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._tintwell_table}")
        _remove(*_files(df.sparkSession), path)


def _files(spark: SparkSession) -> tuple[Any, Any]:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()


def _remove(kind: Any, conf: Any, path: str) -> None:
    """Delete a folder, if it is still there."""
    with contextlib.suppress(Exception):
        p = kind(path)
        p.getFileSystem(conf).delete(p, True)


def bounded_batches(df: DataFrame, size: str = "4m") -> DataFrame:
    """df, in a session whose Arrow batches are held to a few megabytes unless the user has set a size.

    Whole texts go to Python in these batches, and buffers for them are held on both sides of the pipe.
    """
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    if conf.get(BATCH, "67108864b") in ("67108864b", "67108864"):
        with contextlib.suppress(Exception):
            conf.set(BATCH, size)
    return spread(df)


def spread(df: DataFrame, least_bytes: int = 2 << 20) -> DataFrame:
    """df dealt over all cores, if it is a plain scan of fewer partitions than cores and not tiny; else df itself.

    That is so for one file of one row group, which Spark cannot split. A large table has partitions enough.
    """
    if df.isStreaming:
        return df
    plan = df._jdf.queryExecution()
    if int(str(plan.optimizedPlan().stats().sizeInBytes())) < least_bytes:
        return df
    physical = plan.executedPlan()
    if physical.getClass().getSimpleName() == "AdaptiveSparkPlanExec":  # it has exchanges, whose partitions are chosen as it runs
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if physical.execute().getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, where Python would not find it there by itself."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    home = Path(__file__).resolve().parents[2]
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep), *sysconfig.get_paths().values()]
    if home in {Path(p).resolve() for p in found if p} or (Path.cwd() / "tintwell").resolve() == home / "tintwell":
        return
    path = Path(tempfile.mkdtemp(prefix="tintwell-")) / "tintwell.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((home / "tintwell").rglob("*.py")):
            z.write(f, f.relative_to(home))
    spark.sparkContext.addPyFile(str(path))
