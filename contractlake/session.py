"""Where a job may keep intermediate files."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, purpose: str = "work") -> str:
    """A new folder name under the shared folder the session names in ``spark.checkpoint.dir``.

    Every executor must be able to read what another one wrote, so a machine-local folder is
    taken only when the session runs in one process and names no folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return f"{base.rstrip('/')}/contractlake-{purpose}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _hadoop_path(spark, path)
    return fs.exists(jvm_path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, so that Python code in a task opens the same place."""
    fs, jvm_path = _hadoop_path(spark, path)
    return fs.makeQualified(jvm_path).toString()


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    fs, jvm_path = _hadoop_path(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(jvm_path) if s.isDirectory())


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this job wrote itself (a staging copy, or the first half of a failed load)."""
    fs, jvm_path = _hadoop_path(spark, path)
    fs.delete(jvm_path, True)


def drop_empty(spark: SparkSession, path: str) -> None:
    """Delete a folder if nothing is in it."""
    fs, jvm_path = _hadoop_path(spark, path)
    if fs.exists(jvm_path) and not list(fs.listStatus(jvm_path)):
        fs.delete(jvm_path, False)


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder and when they were changed, in milliseconds; none if it is not there."""
    fs, jvm_path = _hadoop_path(spark, path)
    if not fs.exists(jvm_path):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(jvm_path)]


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    fs, jvm_path = _hadoop_path(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# Fixed value: what a store calls a file that is made only where there is none.
CONDITIONAL = "fs.option.create.conditional.overwrite"


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file unless there is one; False where there is. Others see all of its text or no file.

    A store with conditional writes decides when the upload ends. Elsewhere a draft beside it gets
    the name in one step that fails where the name is taken: a hard link on a local disk, a rename
    that does not overwrite on HDFS and others where renaming is one step. Stores with neither are refused.
    """
    fs, jvm_path = _hadoop_path(spark, path)
    if fs.exists(jvm_path):
        return read_text(spark, path) == text
    fs.mkdirs(jvm_path.getParent())
    scheme = fs.getUri().getScheme()
    try:
        if fs.hasPathCapability(jvm_path, CONDITIONAL):
            _write(fs.createFile(jvm_path).overwrite(False).opt(CONDITIONAL, True).build(), text)
            return True
        if scheme in ("s3", "s3a", "s3n"):
            raise RuntimeError(f"{path}: this store makes no file only where there is none")
        draft = spark._jvm.org.apache.hadoop.fs.Path(jvm_path.getParent(), f".{uuid.uuid4().hex}")
        _write(fs.create(draft, False), text)
        try:
            if scheme == "file":
                os.link(draft.toUri().getPath(), jvm_path.toUri().getPath())
            else:
                _rename_to_free_name(spark, fs.makeQualified(draft), fs.makeQualified(jvm_path))
        finally:
            fs.delete(draft, False)
        return True
    except (OSError, Py4JJavaError):
        # An answer that got lost counts as success if the file is ours.
        if fs.exists(jvm_path):
            return read_text(spark, path) == text
        raise


def _write(stream, text: str) -> None:
    stream.write(bytearray(text.encode()))
    stream.close()


def _rename_to_free_name(spark: SparkSession, source, target) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    context.rename(source, target, none)
