"""The Bronze table: all-string rows with provenance, one partition per source file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.contract import PROVENANCE
from chainlake.functions.text import named, quoted


def write_bronze(df: DataFrame, path: str) -> None:
    """Replace the partitions of the files in `df`, leave all others. Repeating a load changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("arquivo_origem")
        .parquet(path)
    )


def bronze_schema(columns: tuple[str, ...]) -> T.StructType:
    strings = [T.StructField(c, T.StringType()) for c in columns]
    return T.StructType(
        [
            *strings,
            T.StructField("line_number", T.LongType()),
            T.StructField("ingerido_em", T.TimestampType()),
            T.StructField("arquivo_origem", T.StringType()),
        ]
    )


def read_bronze(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Bronze rows over files of several layouts: the columns of all of them, or just `columns`; absent ones blank.

    Without `columns` Spark merges the schemas of the footers in a job of its own; a given list saves that. File
    names are read as the texts they are: `007` and `7` are two files.
    """
    if columns is None:
        found = spark.read.option("mergeSchema", True).parquet(path).columns
        columns = tuple(c for c in found if c not in PROVENANCE)
    return spark.read.schema(bronze_schema(columns)).parquet(path).na.fill("", [*map(quoted, columns)])


def projected(bronze: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The declared columns and the provenance; the rest is never read from Parquet."""
    return bronze.select(*(named(c) for c in columns), "line_number", "ingerido_em", "arquivo_origem")


def project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select and rename: new name -> present name."""
    return df.select(*(named(old).alias(new) for new, old in names.items()))


def ingest_summary(bronze: DataFrame, layouts: DataFrame | None = None) -> DataFrame:
    """(arquivo, linhas, colunas_originais) per file; per-file widths where `layouts` gives the headers."""
    counts = bronze.groupBy(F.col("arquivo_origem").alias("arquivo")).agg(F.count("*").alias("linhas"))
    if layouts is None:
        width = len([c for c in bronze.columns if c not in PROVENANCE])
        return counts.withColumn("colunas_originais", F.lit(width))
    widths = layouts.select(
        F.col("arquivo_origem").alias("arquivo"), F.size("colunas").alias("colunas_originais")
    )
    return counts.join(widths, "arquivo", "left")
