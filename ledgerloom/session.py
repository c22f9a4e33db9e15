"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import functools
import sys
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
FREE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_freeing: dict[int, list] = {}  # session -> writers under way, the setting before the first of them
_freeing_lock = threading.Lock()
_written = threading.local()  # paths that this thread has written inside :func:`condensed`


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_by_value(module: str) -> None:
    """Send a module's task functions with the job, so executors need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, which has no other machines, may fall back to a
    temporary folder; on a cluster an unset folder is an error.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerloom-")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten in place."""
    return f"{shared_folder(spark)}/ledgerloom/{name}-{uuid.uuid4().hex}"


def keep_checkpoints(spark: SparkSession) -> None:
    """Give Spark a folder for checkpoints, without which the lineage of a fit of many rounds grows with each."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate result that no later reader needs."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result must be the same in every branch that reads it (row
    positions, sampled bounds) and must survive the loss of an executor.
    """
    path = new_path(df.sparkSession, name)
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    if (paths := getattr(_written, "paths", None)) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go when it ends, not when the driver comes to collect garbage.

    The setting is the session's, so the last of several writers puts it back.
    """
    with _freeing_lock:
        state = _freeing.setdefault(id(spark), [0, spark.conf.get(FREE_KEY, None)])
        state[0] += 1
        spark.conf.set(FREE_KEY, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            state[0] -= 1
            if not state[0]:
                del _freeing[id(spark)]
                spark.conf.unset(FREE_KEY) if state[1] is None else spark.conf.set(FREE_KEY, state[1])


def condensed(build: Callable[[], DataFrame], name: str = "stage") -> DataFrame:
    """What ``build`` returns, written once; what was materialized in this thread on the way is deleted.

    Nothing but the rows may be used of what ``build`` makes.
    """
    outer, _written.paths = getattr(_written, "paths", None), []
    try:
        df = build()
        spent, _written.paths = _written.paths, outer
        out = materialize(df, name)
    finally:
        _written.paths = outer
    for path in spent:
        discard(df.sparkSession, path)
    return out
