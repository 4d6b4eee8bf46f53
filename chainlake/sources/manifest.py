"""Which files a source should have published, which are there, and which may enter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainlake.contract import Contract
from chainlake.functions.messages import COPY_BODY, filled
from chainlake.functions.text import base_name


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """(data): every day from `first` to `last`."""
    days = (last - first).days + 1
    return spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("data"))


def source_manifest(
    days: DataFrame,
    contract: Contract,
    classes: tuple[str, ...] = (),
    regulators: tuple[str, ...] = (),
) -> DataFrame:
    """(data, classe_ativo, fonte, origem, destino) for each day, class and regulator.

    `days` has a date column `data`; a calendar, or the days some other table names.
    """
    path = filled(
        contract.source_template,
        fonte=F.col("fonte"),
        fonte_upper=F.upper("fonte"),
        classe_ativo=F.col("classe_ativo"),
        data_underscore=F.translate(F.col("data").cast("string"), "-", "_"),
    )
    return (
        days.select("data", F.explode(_texts(classes or (contract.default_class,))).alias("classe_ativo"))
        .select("*", F.explode(_texts(regulators or (contract.default_regulator,))).alias("fonte"))
        .withColumn("origem", path)
        .withColumn("destino", F.concat(F.lit(contract.zip_prefix), base_name(F.col("origem"))))
    )


def _texts(values: tuple[str, ...]):
    return F.array(*(F.lit(v) for v in values))


def source_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modified) of the files below `root`; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def _paths_below(listing: DataFrame, root: str) -> DataFrame:
    """(origem): the listed paths relative to `root`."""
    plain = F.ltrim(F.regexp_replace("path", "^file:/+", "/"), F.lit("/"))
    folder = root.removeprefix("file:").strip("/") + "/"
    below = F.when(plain.startswith(folder), F.substr(plain, F.lit(len(folder) + 1))).otherwise(plain)
    return listing.select(below.alias("origem"))


def missing_sources(manifest: DataFrame, listing: DataFrame, root: str) -> DataFrame:
    """Manifest entries with no file below `root`."""
    return manifest.join(_paths_below(listing, root), "origem", "left_anti")


def required_sources(manifest: DataFrame, listing: DataFrame, root: str) -> DataFrame:
    """The manifest, if all its files are there; the job fails at the first that is not."""
    there = _paths_below(listing, root).distinct().withColumn("found", F.lit(True))
    failure = F.raise_error(filled(COPY_BODY, arquivo=F.col("origem"))).cast("boolean")
    marked = manifest.join(there, "origem", "left")
    return marked.where(F.when(F.col("found"), True).otherwise(failure)).select(*manifest.columns)


def admitted(paths: DataFrame, prefix: str, suffix: str | None = None, column: str = "path") -> DataFrame:
    """Paths under the prefix and, where a suffix is given, also ending in it whatever its case."""
    path = F.col(column)
    rule = path.startswith(prefix)
    if suffix is not None:
        rule = rule & F.lower(path).endswith(suffix.lower())
    return paths.where(rule)
