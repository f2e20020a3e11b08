"""Files and folders of shared storage, through the file system that Spark itself uses for their paths.

Notes are small facts about batches, each a text file of its own beside the tables: written whole, replaced whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Existing paths of a glob pattern, in one listing."""
    fs, jpath = _file_system(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(jpath) or []]


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all in it, if it is there."""
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """A folder, unless it is there."""
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder in place of another."""
    fs, jpath = _file_system(spark, source)
    _, jtarget = _file_system(spark, target)
    fs.delete(jtarget, True)
    fs.mkdirs(jtarget.getParent())
    if not fs.rename(jpath, jtarget):
        raise OSError(f"{source} cannot be moved to {target}")


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the files of a folder to those of another."""
    fs, jpath = _file_system(spark, source)
    _, jtarget = _file_system(spark, target)
    fs.mkdirs(jtarget)
    for status in fs.listStatus(jpath):
        moved = spark._jvm.org.apache.hadoop.fs.Path(jtarget, status.getPath().getName())
        if not fs.rename(status.getPath(), moved):
            raise OSError(f"{status.getPath().toString()} cannot be moved to {target}")


def unescaped(spark: SparkSession, uri: str):
    """The path of a URI as Spark reports it for a file."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(uri)).toString()


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Readers see the former text or the new one, never a part."""
    fs, jpath = _file_system(spark, path)
    _, draft = _file_system(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    fs.delete(jpath, False)
    if not fs.rename(draft, jpath):
        raise OSError(f"{path} cannot be written")


def read_note(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    fs, jpath = _file_system(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
