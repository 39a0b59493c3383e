"""Catalog tables: creation, inserts and partitions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidelog import storage

#: Marks tables whose files belong to them although their place was given.
OWNED = "tidelog.owns_files"


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    partitioned_by: Iterable[str] = (),
) -> None:
    """Create a Parquet table at ``location`` unless it exists; partition columns go last.

    The files below ``location`` are the table's own: dropping a partition deletes them.
    """
    parts = list(partitioned_by)
    columns = [f for f in schema.fields if f.name not in parts] + [schema[p] for p in parts]
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet{by} LOCATION '{location}' "
        f"TBLPROPERTIES ('{OWNED}' = 'true')"
    )


def together(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows of one partition into few files; a large partition still splits over tasks."""
    return df.hint("rebalance", *columns)


def insert(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert by column position, like ``INSERT INTO`` / ``INSERT OVERWRITE``."""
    df.write.insertInto(table, overwrite=overwrite)


def insert_select(spark: SparkSession, table: str, query: str, overwrite: bool = False) -> None:
    spark.sql(f"INSERT {'OVERWRITE' if overwrite else 'INTO'} {table} {query}")


def partitioned_insert(rows: DataFrame, table: str, partitions: Iterable[str]) -> None:
    """Append insert-only rows to a partitioned table, partition columns last."""
    parts = list(partitions)
    data = [c for c in rows.columns if c not in parts]
    insert(together(rows.select(*data, *parts), *parts), table)


def _location(spark: SparkSession, table: str) -> str | None:
    """Where the files of a table made by ``create_table`` lie; None for other tables."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name in ('Location', 'Table Properties')")
    found = {r["col_name"]: r["data_type"] for r in described.collect()}
    return found["Location"].rstrip("/") if f"{OWNED}=true" in found.get("Table Properties", "") else None


def drop_partition(spark: SparkSession, table: str, spec: Mapping[str, str]) -> None:
    """Drop the partitions that ``spec`` names, in full or by their first columns, and their files.

    Files go where the catalog manages them, or the table was made by ``create_table``. The
    catalog forgets a partition first, so a failure leaves files that no reader sees.
    """
    wanted = ", ".join(f"`{k}` = '{v}'" for k, v in spec.items())
    location = _location(spark, table)
    folders = []
    if location is not None:
        folders = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table} PARTITION ({wanted})").collect()]
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({wanted})")
    for folder in folders:
        storage.delete_folder(spark, f"{location}/{folder}")
    spark.catalog.refreshTable(table)
