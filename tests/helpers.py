"""Small inputs shared by the tests."""

from __future__ import annotations

import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from chainlake import Contract
from chainlake.contract import CONTROL

SOURCE = Contract(name="swaps")
BOM = b"\xef\xbb\xbf"

EDGES = (
    BOM + b"Dissemination Identifier,Original Dissemination Identifier,Action type,Note\r\n"
    b'1,,NEWT,"a\nb"\r\n'
    b"2,1,MODI,\r\n"
    b"\r\n"
    b"3,1\r\n"
    b"4,1,TERM,x,EXTRA\r\n"
    b'5,"",NEWT," pad "\r\n'
    b'6,1,MODI,"say ""hi"""\r\n'
)
EDGE_ROWS = [
    ("1", "", "NEWT", "a\nb", 0),
    ("2", "1", "MODI", "", 1),
    ("3", "1", "", "", 2),
    ("4", "1", "TERM", "x", 3),
    ("5", "", "NEWT", " pad ", 4),
    ("6", "1", "MODI", 'say "hi"', 5),
]


def fresh(tmp_path: Path, name: str) -> str:
    return str(tmp_path / f"{name}-{uuid.uuid4().hex[:8]}")


def folder_of(tmp_path: Path, files: dict[str, bytes]) -> str:
    folder = Path(fresh(tmp_path, "in"))
    folder.mkdir()
    for name, content in files.items():
        (folder / name).write_bytes(content)
    return str(folder)


def archive_of(tmp_path: Path, archives: dict[str, dict[str, bytes]]) -> str:
    folder = Path(fresh(tmp_path, "zip"))
    folder.mkdir()
    for name, members in archives.items():
        with zipfile.ZipFile(folder / name, "w") as archive:
            for member, content in members.items():
                archive.writestr(member, content)
    return str(folder)


def control(spark: SparkSession, *records: dict) -> DataFrame:
    rows = [tuple(r.get(name) for name in CONTROL.names) for r in records]
    return spark.createDataFrame(rows, CONTROL)


def volumes(spark: SparkSession, *days: tuple[str, int]) -> DataFrame:
    """Volume records: (dt, linhas)."""
    return control(spark, *({"origem": "quality_check", "status": "ok", "dt": d, "linhas": n} for d, n in days))


def tuples(df: DataFrame) -> list[tuple]:
    return [tuple(r) for r in df.collect()]
