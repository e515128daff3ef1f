"""Reads of catalog tables and written folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def catalog_scan(spark: SparkSession, table: str, limit: int = 20, database: str | None = None,
                 catalog: str | None = None, order: list[str] | None = None) -> DataFrame:
    """The first rows of a catalog table; ``order`` makes the choice definite."""
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if database:
        spark.catalog.setCurrentDatabase(database)
    rows = spark.table(table)
    return (rows.orderBy(*order) if order else rows).limit(limit)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN `{database}`" if database else "SHOW TABLES")


def table_description(spark: SparkSession, table: str) -> DataFrame:
    """(column, type, partition) of a catalog table."""
    folders = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    rows = [(f.name, f.dataType.simpleString(), f.name in folders) for f in spark.table(table).schema]
    return spark.createDataFrame(rows, "column STRING, type STRING, partition BOOLEAN")


def table_snapshots(spark: SparkSession, table: str, batch: str = "load_batch") -> DataFrame:
    """What each batch has written into a catalog table that the jobs append to."""
    return spark.table(table).groupBy(batch).agg(F.count(F.lit(1)).alias("n_rows"))


def refresh_partitions(spark: SparkSession, table: str) -> None:
    """Register folders written since the table was declared."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def time_slice(logs: DataFrame, start: str, end: str) -> DataFrame:
    """Rows of hourly folders in ``[start, end)`` (``yyyy-MM-dd HH``).

    The condition uses only partition columns, so other folders are never listed.
    """
    hour = F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0))
    fmt = F.lit("yyyy-MM-dd HH")
    return logs.where((hour >= F.to_timestamp_ntz(F.lit(start), fmt)) & (hour < F.to_timestamp_ntz(F.lit(end), fmt)))
