"""Shared-folder staging, small files, and skew-safe joins against one-row-per-key sides."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

_scope = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in ``spark.checkpoint.dir``.

    Where it is not set, as in tests, a folder of the session's warehouse, which the
    driver and all executors share as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed with all others when the application ends."""
    own = f"{shared_folder(spark)}/driftline/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    fresh = f"{own}/{label}-{uuid.uuid4().hex}"
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(fresh)
    return fresh


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was staged inside it, so long-lived jobs keep no leftovers."""
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        for name in _scope.paths:
            remove_path(spark, name)
        _scope.paths = outer


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts the lineage and gives the planner real file sizes."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """File names in a folder of any Hadoop file system; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return [status.getPath().getName() for status in files.listStatus(path)]


def claim_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file that only one writer can create: any other gets ``FileExistsError``."""
    final = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(final.getParent())
    try:
        out = files.create(final, False)
    except Py4JJavaError as exc:
        if files.exists(final):
            raise FileExistsError(path) from exc
        raise
    out.write(bytearray(text.encode()))
    out.close()


def stored_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file, or of all files in a folder; None where there is neither."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = name.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(files.getContentSummary(name).getLength()) if files.exists(name) else None


def empty_for(spark: SparkSession, path: str) -> float | None:
    """Seconds since an empty file was written; None where it has content or is not there."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = name.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(name):
        return None
    status = files.getFileStatus(name)
    return None if status.getLen() else time.time() - status.getModificationTime() / 1000


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file in place of the one before."""
    final = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = final.getFileSystem(spark._jsc.hadoopConfiguration()).create(final, True)
    out.write(bytearray(text.encode()))
    out.close()


def remove_path(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all that is in it; nothing happens where there is neither."""
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    name.getFileSystem(spark._jsc.hadoopConfiguration()).delete(name, True)


def swap_folder(spark: SparkSession, fresh: str, final: str) -> None:
    """Puts a folder that is written whole in the place of another."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(final)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    files.delete(path, True)
    if not files.rename(hadoop.Path(fresh), path):
        raise OSError(f"{fresh} could not be moved to {final}")


def read_text(spark: SparkSession, path: str) -> str:
    """Content of one small text file."""
    row = spark.read.text(path, wholetext=True).first()
    return row["value"] if row else ""


def file_exists(spark: SparkSession, path: str) -> bool:
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, moved into place whole so that no reader sees part of it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    final = hadoop.Path(path)
    part = hadoop.Path(final.getParent(), f"_{final.getName()}.{uuid.uuid4().hex}")
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(part)
    out.write(bytearray(text.encode()))
    out.close()
    if not files.rename(part, final):
        files.delete(part, False)
        raise FileExistsError(path)


def scan_bytes(df: DataFrame) -> int:
    """Planner's size estimate; for a staged table this is the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    return int(
        spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    )


def keyed_join(
    big: DataFrame, small: DataFrame, keys: list[str], how: str, limit_bytes: int | None = None
) -> DataFrame:
    """Join ``big`` to ``small``, a staged table with one row per key.

    Within the size limit ``small`` is broadcast and ``big`` is not shuffled at all.
    Beyond it both are shuffled, and the adaptive planner splits the partition of a hot
    key of ``big``: ``small`` has only one row to repeat for it.
    """
    limit = broadcast_limit(big.sparkSession) if limit_bytes is None else limit_bytes
    if scan_bytes(small) <= limit:
        return big.join(F.broadcast(small), keys, how)
    return big.join(small.hint("merge"), keys, how)
