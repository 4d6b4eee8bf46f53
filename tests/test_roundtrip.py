"""Properties of Bronze: whatever a CSV file holds comes back as the same strings."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from chainlake.sources import bronze, csv_events
from tests.helpers import BOM, folder_of, fresh

PIECES = ["a", "Z", "0", " ", "  ", ",", '"', '""', "\n", "\r\n", "\t", "\\", "\\n", "'", "é", "日本", ";", "#", "null", "-", "+"]


def texts(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(PIECES) for _ in range(rng.randrange(6))) for _ in range(n)]


def csv_file(rng: random.Random, columns: list[str], rows: int) -> bytes:
    """A file with every kind of quoting, ragged rows and blank lines."""
    ends = rng.choice([["\n"], ["\r\n"], ["\n", "\r\n"]])
    out = io.StringIO(newline="")

    def write(cells: list[str]) -> None:
        quoting = rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
        csv.writer(out, lineterminator=rng.choice(ends), quoting=quoting).writerow(cells)

    write(columns)
    for _ in range(rows):
        width = max(1, len(columns) + rng.choice([0, 0, 0, 0, -1, 1]))
        write(["k", *texts(rng, width - 1)])
        if rng.random() < 0.05:
            out.write(rng.choice(ends))
    return (BOM if rng.random() < 0.5 else b"") + out.getvalue().encode()


@pytest.mark.parametrize("seed", range(4))
def test_bronze_holds_what_the_file_holds(spark, tmp_path, seed):
    rng = random.Random(seed)
    columns = ["Dissemination Identifier", "b c", "Notional amount-Leg 1", "d.e"]
    files, expected = {}, {}
    for i in range(5):
        order = rng.sample(columns, len(columns))
        content = csv_file(rng, order, rng.randrange(60))
        files[f"f {i}+%41.csv"] = content
        reader = csv.DictReader(io.StringIO(content.decode("utf-8-sig"), newline=""))
        for n, row in enumerate(reader):
            expected[f"f {i}+%41.csv", n] = tuple(row.get(c) or "" for c in columns)

    target, folder = fresh(tmp_path, "bronze"), folder_of(tmp_path, files)
    bronze.write_bronze(csv_events.read_events(spark, folder), target)
    stored = bronze.read_bronze(spark, target).select(
        "arquivo_origem", "line_number", *(F.col(f"`{c}`") for c in columns)
    )
    assert {(r[0], r[1]): tuple(r[2:]) for r in stored.collect()} == expected
    counts = {r["arquivo_origem"]: r["linhas"] for r in csv_events.count_records(spark, folder).collect()}
    assert counts == {name: sum(f == name for f, _ in expected) for name in files}
