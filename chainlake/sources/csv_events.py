"""All-string scan of header CSV files whose layouts may differ from file to file.

The files are read with `header=False`, so that each file's own header arrives as its first record, and
one Arrow pass per task puts every value under the name *its* file gives it, numbers the rows and fills
blanks. Spark's own `header=True` takes one file's header for all files and swaps values silently where
column order differs; and numbering rows with a window would shuffle and sort every wide row by file.
A multi-line CSV is never split, so a file's rows reach one task in order and a running count is enough.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.functions.text import address, decoded_name
from chainlake.sources.store import open_store

BROKEN = "_record"
SLOT = "_c"
MARK = -1


@dataclass(frozen=True)
class Layout:
    """Union of the header names of a set of files, and the widest header's length."""

    columns: tuple[str, ...]
    width: int


def slot_schema(width: int) -> T.StructType:
    slots = [T.StructField(f"{SLOT}{i}", T.StringType()) for i in range(width)]
    return T.StructType([*slots, T.StructField(BROKEN, T.StringType())])


def csv_options(reader, width: int):
    """Reader options shared by batch and streaming scans.

    The line end is given rather than detected: a detected CRLF turns every CRLF inside quotes into LF and
    misses line ends of the other kind. What a CRLF leaves behind is taken off by `_without_returns`.
    """
    return reader.schema(slot_schema(width)).options(
        header=False, multiLine=True, escape='"', lineSep="\n", columnNameOfCorruptRecord=BROKEN, encoding="UTF-8"
    )


def records(scan: DataFrame) -> DataFrame:
    """Add the file a raw record came from, as Spark writes it: a path, URL-encoded."""
    return scan.select(F.input_file_name().alias("path"), "*")


def header_names(cells: Iterable[str | None]) -> list[str]:
    """Column names of a header record; an unnamed column is named after its place."""
    return [(cell or "").lstrip("﻿") or f"{SLOT}{i}" for i, cell in enumerate(cells)]


def _runs(names: pa.Array) -> Iterator[tuple[str, int, int]]:
    """(value, start, stop) of each stretch of equal values."""
    encoded = pc.run_end_encode(names)
    start = 0
    for value, stop in zip(encoded.values.to_pylist(), encoded.run_ends.to_pylist()):
        yield value, start, stop
        start = stop


def _name_of(path: str) -> str:
    """Base name of a path as Spark writes it, URL-encoded."""
    return unquote(path.rsplit("/", 1)[-1])


HEADERS = "path string, length long, modificationTime timestamp, arquivo_origem string, colunas array<string>"
_KEYS = ("path", "length", "modificationTime")


def first_record(source: BinaryIO) -> list[str]:
    """Cells of the first record that is not blank, quoted line ends included; what follows it is not read but for the rest of a block."""
    text = io.TextIOWrapper(source, encoding="utf-8", errors="replace", newline="")
    return next((cells for cells in csv.reader(text) if cells and cells != ["\ufeff"]), [])


def _read_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow step over (path, length, modificationTime): the header of each file, from its beginning alone; none of an empty one."""
    for batch in batches:
        for i, path in enumerate(batch.column(0).to_pylist()):
            store, inner = open_store(path)
            with store.open_input_file(inner) as source:
                cells = first_record(source)
            if cells:
                name, header = pa.array([path.rsplit("/", 1)[-1]]), pa.array([header_names(cells)], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in batch.columns), name, header], [*batch.schema.names, "arquivo_origem", "colunas"])


def file_layouts(spark: SparkSession, paths: str | list[str], index: str | None = None) -> DataFrame:
    """(arquivo_origem, colunas): the header of every file that has one. Files are listed, and only their first records read.

    `index` is the folder of a table of headers known by path, length and time of change. Headers it has are taken from it, others are
    read and added; a file that was written again is another one.
    """
    # The listing's content column is not selected, so no file is read for it.
    files = spark.read.format("binaryFile").load(paths).select(*_KEYS)
    if index is None:
        return files.mapInArrow(_read_headers, HEADERS).select("arquivo_origem", "colunas")
    try:
        known = spark.read.schema(HEADERS).parquet(index)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], HEADERS)
    fresh = files.join(known.select(*_KEYS), list(_KEYS), "left_anti")
    fresh.mapInArrow(_read_headers, HEADERS).write.mode("append").parquet(index)
    every = spark.read.schema(HEADERS).parquet(index).dropDuplicates(list(_KEYS))
    return every.join(files, list(_KEYS), "left_semi").select("arquivo_origem", "colunas")


def discover_layout(spark: SparkSession, paths: str | list[str], index: str | None = None) -> Layout:
    """Names in order of first place, and width. Only distinct header names reach the driver. `index` as in `file_layouts`."""
    headers = file_layouts(spark, paths, index)
    names = (
        headers.select(F.posexplode("colunas").alias("place", "name"))
        .groupBy("name")
        .agg(F.min("place").alias("place"), F.max("place").alias("last"))
        .orderBy("place", "name")
    )
    found = names.collect()
    return Layout(tuple(row["name"] for row in found), max((row["last"] for row in found), default=-1) + 1)


def _without_returns(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    """Take the CR of a CRLF off each record's last cell, and drop records that are nothing else."""
    cells = [batch.column(i + 1) for i in range(width)]
    trimmed, only = list(cells), None
    for i in reversed(range(width)):
        ends = pc.fill_null(pc.ends_with(cells[i], "\r"), False)
        if pc.any(ends).as_py():
            for later in cells[i + 1:]:
                ends = pc.and_(ends, pc.is_null(later))
            trimmed[i] = pc.if_else(ends, pc.utf8_slice_codeunits(cells[i], 0, -1), cells[i])
            if i == 0:
                only = pc.and_(ends, pc.equal(cells[0], "\r"))
    whole = pa.RecordBatch.from_arrays([batch.column(0), *trimmed, batch.column(width + 1)], batch.schema.names)
    return whole if only is None else whole.filter(pc.invert(only))


def _header_of(record: dict, path: str, columns: tuple[str, ...], width: int) -> list[str]:
    """Names in a file's first record; a record that does not fit the scan is taken apart again."""
    cells = [record[f"{SLOT}{i}"] for i in range(width)]
    if record[BROKEN] is not None:
        cells = next(csv.reader([record[BROKEN]]), [])
    if len(cells) > width:
        raise ValueError(f"{path}: header has {len(cells)} columns, the scan was given {width}")
    header = header_names(cells)
    # A column without a name of its own has the one of its place, which a given layout need not list.
    unknown = {n for i, n in enumerate(header) if n not in columns and (cells[i] or "").lstrip("\ufeff")}
    if unknown:
        raise ValueError(f"{path}: columns {sorted(unknown)} are not in the layout the scan was given")
    return header


def _by_own_header(columns: tuple[str, ...], width: int, marks: bool) -> Callable:
    """Arrow step: consume each file's header record, then emit its rows under `columns`."""

    def numbered(values: list[pa.Array], name: str, first: int) -> pa.RecordBatch:
        rows = len(values[0])
        index = pa.array(range(first, first + rows), pa.int64())
        fields = [*columns, "arquivo_origem", "line_number"]
        return pa.RecordBatch.from_arrays([*values, pa.repeat(name, rows), index], names=fields)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, name, places, seen = None, "", {}, 0
        for raw in batches:
            batch = _without_returns(raw, width)
            for path, start, stop in _runs(batch.column(0)):
                part = batch.slice(start, stop - start)
                if path != file:
                    header = _header_of(part.slice(0, 1).to_pylist()[0], path, columns, width)
                    places = {column: i + 1 for i, column in enumerate(header)}
                    file, name, seen = path, _name_of(path), 0
                    part = part.slice(1)
                    if marks:
                        yield numbered([pa.array([c if c in places else ""]) for c in columns], name, MARK)
                rows = part.num_rows
                if rows:
                    values = [
                        pc.fill_null(part.column(places[c]), "") if c in places else pa.repeat("", rows)
                        for c in columns
                    ]
                    yield numbered(values, name, seen)
                    seen += rows

    return step


def aligned(raw: DataFrame, columns: tuple[str, ...], width: int, marks: bool = False) -> DataFrame:
    """Raw records -> rows under `columns`, with `arquivo_origem` and the 0-based `line_number`.

    With `marks`, each file also yields one row numbered MARK that holds the names of the columns it has,
    so that a file without data rows is seen too.
    """
    fields = [T.StructField(c, T.StringType()) for c in columns]
    schema = T.StructType(
        [*fields, T.StructField("arquivo_origem", T.StringType()), T.StructField("line_number", T.LongType())]
    )
    return raw.mapInArrow(_by_own_header(columns, width, marks), schema)


def with_ingest_time(df: DataFrame) -> DataFrame:
    """One instant per query, or per micro-batch on a stream."""
    return df.withColumn("ingerido_em", F.current_timestamp())


def read_events(
    spark: SparkSession, paths: str | list[str], layout: Layout | None = None
) -> DataFrame:
    """Bronze rows of the files: every value a string, never null, plus the provenance columns.

    Without a `layout` the headers are looked up first. A given layout saves that scan; a file with a column
    it does not know fails the read, a file without one of its columns reads as blank there.
    """
    layout = layout or discover_layout(spark, paths)
    raw = records(csv_options(spark.read, layout.width).csv(paths))
    return with_ingest_time(aligned(raw, layout.columns, layout.width))


def count_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(csv, arquivo_origem, linhas): data records per file, 0 for a file that holds a header only.

    `csv` is the address that unpacking leaves as `destino`, so that both can be joined.

    Counts parsed records, not line ends: a quoted field may span lines.
    """
    scan = csv_options(spark.read, 1).csv(paths)
    blank_line = F.coalesce(F.col(f"{SLOT}0") == "\r", F.lit(False))
    return (
        scan.where(~blank_line)
        .select(
            address(decoded_name(F.col("_metadata.file_path"))).alias("csv"),
            decoded_name(F.col("_metadata.file_name")).alias("arquivo_origem"),
        )
        .groupBy("csv", "arquivo_origem")
        .agg((F.count("*") - 1).alias("linhas"))
    )
