"""Session set-up for local runs, and the one way lineage is cut."""

from __future__ import annotations

import atexit
import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, memory: str = "8g", app: str = "slackline") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _scratch() -> str:
    folder = tempfile.TemporaryDirectory(prefix="slackline-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    return folder.name


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = _scratch()
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


_cleared: set[str] = set()


def _own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder. It is removed when Python ends."""
    context = spark.sparkContext
    folder = f"{shared_folder(spark)}/stored-{context.applicationId}"
    if folder not in _cleared:
        _cleared.add(folder)
        atexit.register(_remove, context, folder)
    return folder


def _remove(context, folder: str) -> None:
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder; it is removed when Python ends."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For a frame that is used more than once: it is computed once, a lost executor costs a
    read, and Catalyst knows its true size. What an application stores goes when it ends.
    """
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What runs inside hands Python at most ``rows`` rows at a time.

    For whole texts or their words: at Spark's 10,000 rows a batch of them takes tens of MB, as
    Arrow's buffers double while they grow, in the JVM and again in each Python worker, and neither
    gives them back. Only the size of a batch changes, never which rows come.
    """
    before = spark.conf.get(BATCH_ROWS)
    few = int(before) <= 0 or int(before) > rows  # 0 and less: no limit
    try:
        spark.conf.set(BATCH_ROWS, str(rows) if few else before)
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def forget(df: DataFrame) -> None:
    """Remove what ``stored`` wrote for ``df``; nothing for other frames."""
    path = getattr(df, "_stored_at", None)
    if path is not None:
        _remove(df.sparkSession.sparkContext, path)
