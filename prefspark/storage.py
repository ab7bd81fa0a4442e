"""Cut a lineage with a table that survives the loss of executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_OPEN: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or the context's own checkpoint folder.

    Only a local session without either gets a temporary folder; the session's settings
    aren't changed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="prefspark-checkpoint-")
    return _LOCAL_FOLDERS[application]


def new_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder."""
    path = f"{shared_folder(spark)}/prefspark-{uuid.uuid4().hex}"
    for opened in _OPEN:
        opened.append(path)
    return path


def durable(df: DataFrame, compression: str | None = None) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder.

    Unlike a checkpointed RDD, the table is read column by column and has a known size.
    """
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def _close(opened: list[str]) -> None:
    """Stop recording into ``opened``: by identity, as nested blocks may hold equal lists."""
    for at, other in enumerate(_OPEN):
        if other is opened:
            del _OPEN[at]
            return


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def recorded_tables() -> Iterator[list[str]]:
    """The paths of all tables that :func:`durable` stores inside the block.

    For callers that can only remove them later, once what reads them has been written.
    """
    opened: list[str] = []
    _OPEN.append(opened)
    try:
        yield opened
    finally:
        _close(opened)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, all tables that :func:`durable` stores inside the block.

    For whole jobs: their results must be written before the block ends.
    """
    opened: list[str] = []
    _OPEN.append(opened)
    try:
        yield
    finally:
        _close(opened)
        for path in opened:
            remove(spark, path)
