"""Session helpers: a local session for tests and benches, and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def local_session(
    app: str = "civicmart", cpus: int | str = "*", conf: dict[str, str] | None = None
) -> SparkSession:
    """Local session for tests and ``bench.py``; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def in_parallel(
    spark: SparkSession,
    function: Callable[[Item], Result],
    items: Iterable[Item],
    threads: int = 4,
) -> list[Result]:
    """Results in order. The calls submit independent Spark jobs at the same time, so the
    last tasks of one do not leave the cluster idle; the rows stay on the executors. All
    calls run to their end, then the first failure is raised."""
    with ThreadPoolExecutor(threads) as pool:
        # Wrapped once per call: each wrapping holds one copy of the local properties, which
        # two running threads must not share.
        calls = [pool.submit(inheritable_thread_target(spark)(function), item) for item in items]
    return [call.result() for call in calls]


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``, or the caller has set a checkpoint
    folder. Only when neither is there, in a local session, is a temporary folder made; it is
    used by this process alone and goes with it. Nothing is set on the session.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_roots:
            made = tempfile.mkdtemp(prefix="civicmart-")
            atexit.register(shutil.rmtree, made, ignore_errors=True)
            _local_roots[context.applicationId] = made
        root = _local_roots[context.applicationId]
    return root.rstrip("/")


def application_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/civicmart/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared scratch folder; never reused between calls."""
    return f"{application_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; for the end of a job, when no
    result built on them is to be read any more."""
    folder = hadoop_path(spark, application_scratch(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Used where several branches need the same aggregate: the branches then read the
    small table instead of repeating the scans and shuffles behind it. Lineage ends at
    files every executor can reach, so lost executors cost nothing upstream.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` returned, once all that was built on them is written.
    What reads them later fails, so nothing lazy may still refer to them."""
    for table in tables:
        spark = table.sparkSession
        folder = hadoop_path(spark, _written.pop(table))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
