"""Registration of the stored tables in the session catalog. Metadata only; data is never moved."""

from __future__ import annotations

from pyspark.sql import SparkSession

from chainlake.contract import CONTROL, LEAF, Contract


def bronze_ddl(table: str, location: str, contract: Contract) -> str:
    declared = ",\n  ".join(f"`{name}` string" for name in contract.columns.raw_names().values())
    return (
        f"CREATE TABLE IF NOT EXISTS {table} (\n  {declared},\n  line_number bigint,\n"
        f"  ingerido_em timestamp,\n  arquivo_origem string\n) USING parquet\n"
        f"PARTITIONED BY (arquivo_origem)\nLOCATION '{location}'"
    )


def control_ddl(table: str, location: str) -> str:
    fields = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CONTROL.fields)
    return (
        f"CREATE TABLE IF NOT EXISTS {table} (\n  {fields},\n  {LEAF} string\n) USING json\n"
        f"PARTITIONED BY (dt, {LEAF})\nLOCATION '{location}'"
    )


def register_tables(
    spark: SparkSession,
    contract: Contract,
    bronze_path: str,
    control_path: str,
    database: str = "default",
    refresh_schema: bool = False,
) -> tuple[str, str]:
    """Declare Bronze (the contract's columns) and the control log, and discover their partitions.

    `refresh_schema` drops the control log's definition first: `IF NOT EXISTS` keeps an old schema.
    """
    bronze, control = f"{database}.{contract.name}_bronze", f"{database}.controle_execucoes"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if refresh_schema:
        spark.sql(f"DROP TABLE IF EXISTS {control}")
    spark.sql(bronze_ddl(bronze, bronze_path, contract))
    spark.sql(control_ddl(control, control_path))
    refresh_partitions(spark, bronze, control)
    return bronze, control


def refresh_partitions(spark: SparkSession, *tables: str) -> None:
    """Make partitions written since the last call visible."""
    for table in tables:
        spark.sql(f"MSCK REPAIR TABLE {table}")
