"""Zip archives holding one CSV each.

`binaryFile` lists the archives and deals them out to tasks by their sizes; their content is not one of the columns read. A task
opens an archive where it lies, goes by its central directory and streams the member, so an archive may be larger than a row and
than a task's memory, and only what is needed of it is read. Decompression is the one thing Spark has no built-in for.
"""

from __future__ import annotations

import shutil
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chainlake.functions.messages import BAD_ARCHIVE, SHARED_MEMBER, filled
from chainlake.functions.text import address
from chainlake.sources.store import open_store, qualified

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
MEMBER_SCHEMA = "path string, member string, bytes long, n_csv int, found string, content binary"
MEMBER_FIELDS = pa.schema(
    [
        ("path", pa.string()), ("member", pa.string()), ("bytes", pa.int64()), ("n_csv", pa.int32()),
        ("found", pa.string()), ("content", pa.binary()),
    ]
)


def csv_members(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    return [info for info in archive.infolist() if info.filename.lower().endswith(".csv")]


def _open_members(keep: Callable[[str, zipfile.ZipFile, zipfile.ZipInfo], bytes | None]) -> Callable:
    """Arrow step over paths: one row per archive; `keep` decides what becomes of the member's bytes."""

    def one(path: str) -> dict:
        store, inner = open_store(path)
        with store.open_input_file(inner) as source, zipfile.ZipFile(source) as archive:
            found = csv_members(archive)
            row = {"path": path, "n_csv": len(found), "found": str([i.filename for i in found])}
            if len(found) == 1:
                row["member"] = found[0].filename.split("/")[-1]
                row["bytes"] = found[0].file_size
                row["content"] = keep(row["member"], archive, found[0])
            return row

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                yield pa.RecordBatch.from_pylist([one(path)], MEMBER_FIELDS)

    return step


def archive_files(reader, paths: str | list[str]) -> DataFrame:
    """(path, modificationTime, length) of the zip files, from a batch or a streaming reader; none is opened."""
    reader = reader.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", "*.zip")
    return reader.load(paths).drop("content")


def _described(members: DataFrame) -> DataFrame:
    """Add the problem text of archives that do not hold exactly one CSV."""
    text = filled(BAD_ARCHIVE, arquivo=F.col("path"), achados=F.col("n_csv"), nomes=F.col("found"))
    return members.withColumn("problema", F.when(F.col("n_csv") != 1, text)).drop("found")


def read_archives(spark: SparkSession, paths: str | list[str], with_content: bool = False) -> DataFrame:
    """(path, member, bytes, n_csv, problema[, content]) per archive.

    A bad archive stays in the result with its `problema` set; `checked` turns it into an error. Of the archives only the central directory
    is read, and the member where its content, which must fit in a row, is asked for.
    """
    step = _open_members((lambda m, z, i: z.read(i)) if with_content else (lambda m, z, i: None))
    members = _described(archive_files(spark.read, paths).select("path").mapInArrow(step, MEMBER_SCHEMA))
    return members if with_content else members.drop("content")


def in_input_order(archives: DataFrame, paths: DataFrame | list[str]) -> DataFrame:
    """Results with the `ordinal` at which each was asked for; one asked for twice comes twice.

    `paths` is a list or a table (ordinal, path). An archive nobody asked for has a null ordinal; a path without
    an archive gives no row.
    """
    if not isinstance(paths, DataFrame):
        paths = archives.sparkSession.createDataFrame(list(enumerate(paths)), "ordinal int, path string")
    asked = paths.select("ordinal", _plain("path").alias("plain"))
    return archives.withColumn("plain", _plain("path")).join(asked, "plain", "left").drop("plain")


def _plain(path: str):
    return F.regexp_replace(path, "^file:/+", "/")


def checked(archives: DataFrame) -> DataFrame:
    """Fail the job at the first archive that does not hold exactly one CSV."""
    failure = F.raise_error(F.col("problema")).cast("boolean")
    return archives.where(F.when(F.col("problema").isNull(), True).otherwise(failure))


def unpack_archives(spark: SparkSession, paths: str | list[str], raw_dir: str) -> DataFrame:
    """Write each archive's CSV, byte for byte, to `raw_dir` and say what was written; see `unpack`."""
    return unpack(archive_files(spark.read, paths), raw_dir)


def unpack(files: DataFrame, raw_dir: str) -> DataFrame:
    """`read_archives` on the given files, writing each member below `raw_dir` as `destino`.

    Archives whose members have the same name claim one file; all of them get a `problema` that says so. `destino` is
    the file's full address, as `count_records` gives it.

    Streams the member to a private name and renames it, so a retried or speculative task leaves the same
    whole file. The writes happen when the result is evaluated; write the result once, then read it.
    """

    raw_dir = qualified(files.sparkSession, raw_dir)

    def write(member: str, archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> None:
        store, root = open_store(raw_dir)
        store.create_dir(root)
        private = f"{root}/.{uuid.uuid4().hex}"
        with archive.open(info) as source, store.open_output_stream(private) as target:
            shutil.copyfileobj(source, target, 1 << 20)
        store.move(private, f"{root}/{member}")

    members = _described(files.select("path").mapInArrow(_open_members(write), MEMBER_SCHEMA))
    destination = address(F.concat(F.lit(raw_dir.rstrip("/") + "/"), "member"))
    written = members.drop("content").withColumn("destino", destination)
    # Of files only: rows without a destination would meet in one group of the window.
    claimed = F.count("*").over(W.partitionBy(F.coalesce("destino", "path")))
    shared = F.when(claimed > 1, filled(SHARED_MEMBER, nome=F.col("member"), arquivos=claimed))
    return written.withColumn("problema", F.coalesce("problema", shared))
