"""Files in the store that Spark reads, through Hadoop's file system: listing, replacing and removing."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path below ``path``, bytes, time of change) of every file, in order of their paths. A single file has no path below."""
    fs, place = _at(spark, path)
    top = fs.getFileStatus(place).getPath().toUri().getPath()
    found, listing = [], fs.listFiles(place, True)
    while listing.hasNext():
        status = listing.next()
        found.append((status.getPath().toUri().getPath()[len(top) :], status.getLen(), status.getModificationTime()))
    return sorted(found)


def folders_in(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of change in milliseconds) of the folders directly below ``path``."""
    fs, place = _at(spark, path)
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(place) if s.isDirectory()) if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _renamed(spark: SparkSession, old: str, new: str, overwrite: bool) -> None:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    mode = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    modes = gateway.new_array(mode, 1)
    modes[0] = mode.OVERWRITE if overwrite else mode.NONE
    _, source = _at(spark, old)
    fs, target = _at(spark, new)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(source), fs.makeQualified(target), modes)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file by one rename, so that readers see the old text or the new one."""
    beside = f"{path}.{uuid.uuid4().hex}"
    fs, place = _at(spark, beside)
    stream = fs.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    _renamed(spark, beside, path, overwrite=True)


def moved_if_new(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a finished folder, unless another one got there first; the own one is removed then."""
    if not exists(spark, new):
        try:
            _renamed(spark, old, new, overwrite=False)
            return True
        except Exception:
            if not exists(spark, new):
                raise
    remove(spark, old)
    return False
