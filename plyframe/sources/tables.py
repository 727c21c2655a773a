"""Writing and reading tables: full replace, stable hash layout, read-only scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_SCHEMA = "chess_data_raw"  # fixed value: schema of the raw table


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] = ()) -> None:
    """Write ``df`` as table ``name``, replacing what was there."""
    spark = df.sparkSession
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> None:
    """Write ``df`` hashed by ``key``: later joins, windows and groups on it need no shuffle.

    The caller hands over rows already hashed into ``buckets`` partitions, so every task
    writes one file.
    """
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def switch(spark: SparkSession, fresh: str, name: str) -> None:
    """Give table ``fresh`` the place of table ``name``.

    Both lie in folders of their own, so the former one's files stay for readers that are still at it.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def show_as(spark: SparkSession, table: str, name: str) -> None:
    """Let ``name`` be a view of ``table``, in one step; a table of that name, from before there were versions, goes."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {table}")


def replace_files(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def query(spark: SparkSession, sql: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """SQL over frames by name (``{name}``) with bound values (``:name``)."""
    return spark.sql(sql, args=args or {}, **frames)
