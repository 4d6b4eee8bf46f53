"""Opening a folder of the shared store from inside a task."""

from __future__ import annotations

import re

from pyarrow import fs
from pyspark.sql import SparkSession

# Names Hadoop gives schemes that Arrow knows under another.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def qualified(spark: SparkSession, folder: str) -> str:
    """`folder` with the scheme Spark would read it under, so that tasks write where Spark looks."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return store.makeQualified(path).toString()


def open_store(folder: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a folder named the way Spark names it."""
    scheme, colon, rest = folder.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), folder
    if scheme == "file":
        return fs.LocalFileSystem(), re.sub("^/+", "/", rest)
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
