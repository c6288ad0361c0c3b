"""Small file-system helpers that work on any path Spark can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    handle = jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    handle, fs = _path(spark, path)
    return fs.exists(handle)


def list_names(spark: SparkSession, path: str) -> list[str]:
    handle, fs = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(handle)]


def remove(spark: SparkSession, path: str) -> None:
    handle, fs = _path(spark, path)
    fs.delete(handle, True)


def read_text(spark: SparkSession, path: str) -> str:
    handle, fs = _path(spark, path)
    stream = fs.open(handle)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: write beside it, then rename over it."""
    jvm = spark.sparkContext._jvm
    target, fs = _path(spark, path)
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)
