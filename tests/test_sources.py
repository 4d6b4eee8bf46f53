"""CSV scan, Bronze, archives, manifests, control log, tables."""

from datetime import date

import zipfile
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chainlake import Contract
from chainlake.sources import archives, bronze, control, csv_events, manifest, tables
from tests.helpers import BOM, EDGE_ROWS, EDGES, SOURCE, archive_of, folder_of, fresh, tuples

NAME = "A+B c.csv"
COLUMNS = ("Dissemination Identifier", "Original Dissemination Identifier", "Action type", "Note")


def rows_of(df, *extra):
    return sorted(tuples(df.select(*(f"`{c}`" for c in COLUMNS), "line_number", *extra)), key=lambda r: r[4:])


def test_every_csv_edge(spark, tmp_path):
    read = csv_events.read_events(spark, folder_of(tmp_path, {NAME: EDGES}))
    assert rows_of(read) == EDGE_ROWS
    assert {r[0] for r in read.select("arquivo_origem").collect()} == {NAME}
    assert read.columns == [*COLUMNS, "arquivo_origem", "line_number", "ingerido_em"]
    assert read.where(" or ".join(f"`{c}` is null" for c in read.columns)).count() == 0


def test_values_follow_each_files_own_header(spark, tmp_path):
    swapped = BOM + b"Note,Action type,Dissemination Identifier,New\n" + b"n,NEWT,7,z\n"
    folder = folder_of(tmp_path, {NAME: EDGES, "b.csv": swapped})
    read = csv_events.read_events(spark, folder)
    assert set(read.columns) >= {*COLUMNS, "New"}
    (other,) = tuples(read.where("arquivo_origem = 'b.csv'").select(*(f"`{c}`" for c in COLUMNS), "New"))
    assert other == ("7", "", "NEWT", "n", "z")
    assert rows_of(read.where(F.col("arquivo_origem") == NAME)) == EDGE_ROWS
    headers = dict(tuples(csv_events.file_layouts(spark, folder)))
    assert headers["b.csv"] == ["Note", "Action type", "Dissemination Identifier", "New"]


def test_declared_layout_refuses_a_wider_file(spark, tmp_path):
    folder = folder_of(tmp_path, {"a.csv": b"x,y,z\n1,2,3\n"})
    with pytest.raises(PySparkException, match="header has 3 columns"):
        csv_events.read_events(spark, folder, csv_events.Layout(("x", "y"), 2)).collect()


def test_declared_layout_reads_missing_columns_as_blank(spark, tmp_path):
    folder = folder_of(tmp_path, {"a.csv": b"y\n2\n"})
    read = csv_events.read_events(spark, folder, csv_events.Layout(("x", "y"), 2))
    assert tuples(read.select("x", "y", "line_number")) == [("", "2", 0)]


def test_unnamed_and_repeated_columns(spark, tmp_path):
    folder = folder_of(tmp_path, {"a.csv": b"x,,x\n1,2,3\n"})
    read = csv_events.read_events(spark, folder)
    assert tuples(read.select("x", "_c1")) == [("3", "2")]


def test_line_numbers_restart_with_each_file(spark, tmp_path):
    files = {f"f{i:02d}.csv": b"a\n" + b"".join(b"%d\n" % n for n in range(i * 7)) for i in range(1, 9)}
    read = csv_events.read_events(spark, folder_of(tmp_path, files))
    found = read.groupBy("arquivo_origem").agg(
        F.count("*").alias("n"), F.min("line_number"), F.max("line_number"),
        F.count_if(F.col("a").cast("long") == F.col("line_number")),
    )
    assert sorted(tuples(found)) == [(f"f{i:02d}.csv", i * 7, 0, i * 7 - 1, i * 7) for i in range(1, 9)]


def test_counts_records_not_lines(spark, tmp_path):
    folder = folder_of(tmp_path, {NAME: EDGES, "head.csv": b"a,b\n"})
    counts = csv_events.count_records(spark, folder)
    assert sorted(tuples(counts.select("arquivo_origem", "linhas"))) == [(NAME, 6), ("head.csv", 0)]


def test_bronze_is_idempotent_per_file(spark, tmp_path):
    first = folder_of(tmp_path, {NAME: EDGES})
    second = folder_of(tmp_path, {"other.csv": EDGES.replace(b"\r\n1,", b"\r\n9,")})
    target = fresh(tmp_path, "bronze")
    for folder in (first, first, second):
        bronze.write_bronze(csv_events.read_events(spark, folder), target)
    stored = bronze.read_bronze(spark, target)
    assert rows_of(stored.where(F.col("arquivo_origem") == NAME)) == EDGE_ROWS
    assert stored.count() == 12
    shorter = folder_of(tmp_path, {NAME: b"\r\n".join(EDGES.split(b"\r\n")[:2]) + b"\r\n"})
    bronze.write_bronze(csv_events.read_events(spark, shorter), target)
    assert bronze.read_bronze(spark, target).groupBy("arquivo_origem").count().orderBy("count").collect()[0][1] == 1


def test_bronze_read_with_columns_spans_layouts(spark, tmp_path):
    target = fresh(tmp_path, "bronze")
    for name, content in (("a.csv", b"x\n1\n"), ("b.csv", b"y\n2\n")):
        bronze.write_bronze(csv_events.read_events(spark, folder_of(tmp_path, {name: content})), target)
    stored = bronze.read_bronze(spark, target, ("x", "y"))
    assert sorted(tuples(stored.select("arquivo_origem", "x", "y"))) == [("a.csv", "1", ""), ("b.csv", "", "2")]
    narrow = bronze.projected(stored, ("x",))
    assert narrow.columns == ["x", "line_number", "ingerido_em", "arquivo_origem"]


def test_ingest_summary(spark, tmp_path):
    folder = folder_of(tmp_path, {NAME: EDGES})
    read = csv_events.read_events(spark, folder)
    assert tuples(bronze.ingest_summary(read)) == [(NAME, 6, 4)]
    assert tuples(bronze.ingest_summary(read, csv_events.file_layouts(spark, folder))) == [(NAME, 6, 4)]


def test_archive_content_is_byte_identical_and_in_input_order(spark, tmp_path):
    folder = archive_of(tmp_path, {"b.zip": {"in/B.CSV": EDGES}, "a.zip": {"a.csv": b"x\n1\n", "read.me": b"?"}})
    found = archives.read_archives(spark, folder, with_content=True)
    asked = [f"{folder}/b.zip", f"{folder}/a.zip"]
    got = tuples(
        archives.in_input_order(found, asked).orderBy("ordinal")
        .select("ordinal", "member", "bytes", "n_csv", "problema", "content")
    )
    assert [(r[0], r[1], r[2], r[3], r[4], bytes(r[5])) for r in got] == [
        (0, "B.CSV", len(EDGES), 1, None, EDGES), (1, "a.csv", 4, 1, None, b"x\n1\n"),
    ]


def test_archive_without_csv_is_reported_and_can_fail_the_job(spark, tmp_path):
    folder = archive_of(tmp_path, {"bad.zip": {"only.txt": b"x"}})
    found = archives.read_archives(spark, folder)
    (row,) = found.collect()
    assert row["problema"].startswith("esperava exatamente 1 .csv dentro de ") and "achei 0: []" in row["problema"]
    with pytest.raises(PySparkException, match="esperava exatamente 1"):
        archives.checked(found).collect()


def test_archives_with_one_member_name_are_reported(spark, tmp_path):
    folder = archive_of(tmp_path, {"a.zip": {"x.csv": b"x\n1\n"}, "b.zip": {"in/x.csv": b"x\n2\n"}, "c.zip": {"y.csv": b"x\n"}})
    done = archives.unpack_archives(spark, folder, fresh(tmp_path, "raw")).orderBy("path").collect()
    assert [r["problema"] is None for r in done] == [False, False, True]


def test_an_archive_asked_for_twice_comes_twice(spark, tmp_path):
    folder = archive_of(tmp_path, {"a.zip": {"a.csv": b"x\n"}, "b.zip": {"b.csv": b"x\n"}})
    asked = [f"{folder}/b.zip", f"{folder}/a.zip", f"{folder}/b.zip"]
    found = archives.in_input_order(archives.read_archives(spark, folder), asked).orderBy("ordinal")
    assert tuples(found.select("ordinal", "member")) == [(0, "b.csv"), (1, "a.csv"), (2, "b.csv")]


def test_unpacked_files_are_whole_and_repeatable(spark, tmp_path):
    folder = archive_of(tmp_path, {"a.zip": {"out/a.csv": EDGES}, "bad.zip": {"x.txt": b""}})
    raw = fresh(tmp_path, "raw")
    for _ in range(2):
        done = archives.unpack_archives(spark, folder, raw).where("problema is null").collect()
    assert [r["destino"] for r in done] == [f"file:{raw}/a.csv"]
    assert (tmp_path / raw / "a.csv").read_bytes() == EDGES


@pytest.mark.parametrize(
    "asset, regulator, path",
    [
        ("RATES", "cftc", "cftc/eod/CFTC_CUMULATIVE_RATES_2026_10_02.zip"),
        ("CREDITS", "sec", "sec/eod/SEC_CUMULATIVE_CREDITS_2026_10_02.zip"),
    ],
)
def test_source_paths(spark, asset, regulator, path):
    days = manifest.calendar(spark, date(2026, 10, 2), date(2026, 10, 2))
    (row,) = manifest.source_manifest(days, SOURCE, (asset,), (regulator,)).collect()
    assert (row["origem"], row["destino"]) == (path, "raw/swaps_zip/" + path.split("/")[-1])


def test_manifest_defaults_and_missing_files(spark, tmp_path):
    root = tmp_path / "store" / "cftc" / "eod"
    root.mkdir(parents=True)
    (root / "CFTC_CUMULATIVE_RATES_2026_10_02.zip").write_bytes(b"x")
    days = manifest.calendar(spark, date(2026, 10, 1), date(2026, 10, 3))
    wanted = manifest.source_manifest(days, SOURCE)
    assert wanted.count() == 3
    listing = manifest.source_listing(spark, str(tmp_path / "store"))
    missing = manifest.missing_sources(wanted, listing, str(tmp_path / "store"))
    assert sorted(str(r["data"]) for r in missing.collect()) == ["2026-10-01", "2026-10-03"]


def test_admission_is_prefix_and_suffix(spark):
    paths = spark.createDataFrame([("raw/a.CSV",), ("raw/a.txt",), ("other/a.csv",)], "path string")
    assert tuples(manifest.admitted(paths, "raw/", ".csv")) == [("raw/a.CSV",)]
    assert manifest.admitted(paths, "raw/").count() == 2


def test_control_log_appends_mixed_records_and_prunes_days(spark, tmp_path):
    path = fresh(tmp_path, "log")
    copied = spark.createDataFrame([("a/x.zip", "raw/x.zip")], "origem string, destino string")
    control.append_control(control.copy_records(copied), path, "2026-10-02T06:00:00+00:00")
    outcome = spark.createDataFrame([("jr_1", "SUCCEEDED", None, 42)], "job_run_id string, state string, execution_id string, duracao_segundos long")
    control.append_control(control.outcome_records(outcome), path, "2026-10-05T06:00:00.5+00:00")
    log = control.read_control(spark, path)
    shown = log.select("origem", "zip", "job_run_id", "status", "duracao_segundos", "timestamp", "dt").orderBy("dt")
    assert tuples(shown) == [
        ("ingerir_cumulative", "raw/x.zip", None, "copiado", None, "2026-10-02T06:00:00+00:00", "2026-10-02"),
        ("glue_job", None, "jr_1", "succeeded", 42, "2026-10-05T06:00:00.500000+00:00", "2026-10-05"),
    ]
    window = control.read_control(spark, path, "2026-10-05T12:00:00+00:00", 2)
    assert window.count() == 1
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_unknown_column_that_looks_unnamed_is_refused(spark, tmp_path):
    folder = folder_of(tmp_path, {"a.csv": b"x,_country\n1,BR\n"})
    with pytest.raises(PySparkException, match="_country"):
        csv_events.read_events(spark, folder, csv_events.Layout(("x",), 2)).collect()
    trailing = folder_of(tmp_path, {"b.csv": b"x,\n1,\n"})
    assert csv_events.read_events(spark, trailing, csv_events.Layout(("x",), 2)).count() == 1


def test_bronze_keeps_all_columns_and_file_names(spark, tmp_path):
    target = fresh(tmp_path, "bronze")
    for name, column in (("007", "y"), ("7", "z")):
        row = spark.createDataFrame([("1", "2", name, 0)], f"x string, {column} string, arquivo_origem string, line_number long")
        bronze.write_bronze(row.withColumn("ingerido_em", F.current_timestamp()), target)
    stored = bronze.read_bronze(spark, target).select("arquivo_origem", "x", "y", "z").orderBy("arquivo_origem")
    assert tuples(stored) == [("007", "1", "2", ""), ("7", "1", "", "2")]


def test_registered_tables(spark, tmp_path):
    target, log = fresh(tmp_path, "bronze"), fresh(tmp_path, "log")
    source = Contract(name="reg")
    header = b",".join(c.encode() for c in source.columns.raw_names().values())
    folder = folder_of(tmp_path, {"a.csv": header + b"\n" + b"1,,NEWT,e,2026-10-02T19:00:00,IR,P,10,USD\n"})
    bronze.write_bronze(csv_events.read_events(spark, folder), target)
    copied = spark.createDataFrame([("a", "b")], "origem string, destino string")
    control.append_control(control.copy_records(copied), log)
    for refresh in (False, True):
        names = tables.register_tables(spark, source, target, log, "registered", refresh)
    assert spark.table(names[0]).select("Action type", "arquivo_origem").collect()[0][:] == ("NEWT", "a.csv")
    assert spark.table(names[1]).select("status").collect()[0][0] == "copiado"


def test_declared_layout_refuses_unknown_columns(spark, tmp_path):
    folder = folder_of(tmp_path, {"a.csv": b'x,"y\nz"\n1,2\n'})
    with pytest.raises(PySparkException, match="are not in the layout"):
        csv_events.read_events(spark, folder, csv_events.Layout(("x", "y"), 2)).collect()
    # Discovery takes the line end within quotes for part of the name.
    assert [r[:2] for r in csv_events.read_events(spark, folder).select("x", "`y\nz`").collect()] == [("1", "2")]


def test_required_sources_fail_the_job(spark, tmp_path):
    root = tmp_path / "store" / "cftc" / "eod"
    root.mkdir(parents=True)
    (root / "CFTC_CUMULATIVE_RATES_2026_10_02.zip").write_bytes(b"x")
    listing = manifest.source_listing(spark, str(tmp_path / "store"))
    one = manifest.source_manifest(manifest.calendar(spark, date(2026, 10, 2), date(2026, 10, 2)), SOURCE)
    assert manifest.required_sources(one, listing, str(tmp_path / "store")).count() == 1
    two = manifest.source_manifest(manifest.calendar(spark, date(2026, 10, 2), date(2026, 10, 3)), SOURCE)
    with pytest.raises(PySparkException, match="Falha ao copiar cftc/eod/CFTC_CUMULATIVE_RATES_2026_10_03.zip"):
        manifest.required_sources(two, listing, str(tmp_path / "store")).collect()


def test_headers_come_from_first_records_alone(spark, tmp_path):
    files = {
        "quoted.csv": b'a,"b\nc ""x""",d\r\n1,2,3\r\n', "blank first.csv": b"\n\r\na,e\n1,2\n", "empty.csv": b"", "bom+%20.csv": BOM + b"z\n", "body.csv": b"a\n" + b'"' * 3 + b"\xff" * 100,
    }
    folder = folder_of(tmp_path, files)
    found = {r["arquivo_origem"]: r["colunas"] for r in csv_events.file_layouts(spark, folder).collect()}
    assert found == {"quoted.csv": ["a", 'b\nc "x"', "d"], "blank first.csv": ["a", "e"], "bom+%20.csv": ["z"], "body.csv": ["a"]}
    plan = csv_events.file_layouts(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and "modificationTime" in plan


def test_a_header_index_reads_only_new_and_changed_files(spark, tmp_path):
    folder = folder_of(tmp_path, {"a.csv": b"a,b\n1,2\n", "b.csv": b"b,c\n"})
    index = fresh(tmp_path, "headers")
    assert csv_events.discover_layout(spark, folder, index) == csv_events.Layout(("a", "b", "c"), 2)
    assert csv_events.discover_layout(spark, folder, index) == csv_events.discover_layout(spark, folder)
    assert spark.read.parquet(index).count() == 2
    (Path(folder) / "b.csv").write_bytes(b"b,c,d\n")
    (Path(folder) / "n.csv").write_bytes(b"n\n")
    assert csv_events.discover_layout(spark, folder, index) == csv_events.Layout(("a", "b", "n", "c", "d"), 3)
    assert spark.read.parquet(index).count() == 4


def test_archives_are_streamed_not_loaded(spark, tmp_path):
    folder = Path(fresh(tmp_path, "zip"))
    folder.mkdir()
    with zipfile.ZipFile(folder / "large.zip", "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
        with archive.open(zipfile.ZipInfo("in/large.csv"), "w", force_zip64=True) as member:
            member.write(b"x\n" * 3_000_000)
        archive.writestr("notes.txt", b"?" * 1000)
    files = archives.archive_files(spark.read, str(folder))
    assert files.columns == ["path", "modificationTime", "length"]
    (row,) = archives.read_archives(spark, str(folder)).collect()
    assert (row["member"], row["bytes"], row["n_csv"]) == ("large.csv", 6_000_000, 1)
    raw = fresh(tmp_path, "raw")
    assert archives.unpack_archives(spark, str(folder), raw).count() == 1
    assert (Path(raw) / "large.csv").stat().st_size == 6_000_000
