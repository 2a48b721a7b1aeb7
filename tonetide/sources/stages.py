"""Reuse-or-compute stages on shared storage."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Sequence
from typing import Protocol, TypeVar

from pyspark.sql import DataFrame, SparkSession


class Saveable(Protocol):
    def write(self): ...


M = TypeVar("M", bound=Saveable)


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/tonetide-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="tonetide-")


def _file(spark: SparkSession, path: str):
    """Hadoop's file system and path objects for ``path``."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()), file


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, file = _file(spark, path)
    out = fs.create(file, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a finished job left its ``_SUCCESS`` mark; a broken write does not count."""
    fs, marker = _file(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def _claim(spark: SparkSession, path: str, made_with: str) -> None:
    """Note beside ``path`` that it is a stage of ours and what it is made with.

    Raises if it was made with something else, or if ``path`` holds files of somebody else's.
    """
    note = f"{path.rstrip('/')}.stage"
    fs, file = _file(spark, note)
    if fs.exists(file):
        before = "\n".join(r[0] for r in spark.read.text(note, wholetext=True).collect())
        if not _agree(before, made_with):
            raise ValueError(f"{path} was made with {before}, not with {made_with}")
        return
    _, folder = _file(spark, path)
    if fs.exists(folder) and len(fs.listStatus(folder)):
        raise FileExistsError(f"{path} holds files that no stage has written")
    _write_text(spark, note, made_with)


def _agree(before: str, now: str) -> bool:
    """Equal parameters; one that is not known on either side says nothing."""
    if before == now:
        return True
    a, b = json.loads(before), json.loads(now)
    return a.keys() == b.keys() and all(
        a[k] == b[k] or a[k] is None or b[k] is None for k in a
    )


def made_with(**parameters) -> str:
    """Text that names parameters, the same for equal ones. None means: not known."""
    return json.dumps(parameters, sort_keys=True, default=str)


def stage(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    parameters: str = "{}",
    partition_by: Sequence[str] = (),
    schema: str | None = None,
) -> DataFrame:
    """Read ``path`` if it is complete, else build it, write it and read it back.

    The table read back has no lineage behind it, so a lost executor costs one re-read. A stage made
    with other ``parameters`` (see ``made_with``) is never read: that is an error, as is a folder
    that no stage has written. ``partition_by`` names columns whose values get folders of their own; it
    needs the table's ``schema``, as a table without rows has no such folder.
    """
    _claim(spark, path, parameters)
    if not is_complete(spark, path):
        build().write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def stage_model(
    spark: SparkSession,
    path: str,
    load: Callable[[str], M],
    build: Callable[[], M],
    parameters: str = "{}",
) -> M:
    """The same for fitted models; ``load`` reads what ``build`` made and saved.

    A model is saved in several files, so the mark that counts is written after the last of them.
    """
    _claim(spark, path, parameters)
    if not is_complete(spark, path):
        build().write().overwrite().save(path)
        _write_text(spark, f"{path}/_SUCCESS", "")
    return load(path)
