"""Reading registered tables and their metadata.

All of these go through the session catalog (``spark.sql`` / ``spark.table``);
listings are small metadata frames, previews are ``limit`` queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.names import positive_int
from ..sinks.tables import TableLoadError, follow_pointer, register_table, table_location, table_name


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The rows of a registered table (its Parquet files at its location).

    The catalog entry is brought up to the table's current version first, and its file listing
    refreshed: another process may have overwritten the table or appended to it.
    """
    name = table_name(database, table)
    if not spark.catalog.tableExists(f"{database}.{table}"):
        raise TableLoadError(f"table {database}.{table} is not registered")
    if table_location(spark, database, table) is None:
        raise TableLoadError(f"table {database}.{table} has no location")
    follow_pointer(spark, database, table)
    return spark.table(name)


def attach_table(spark: SparkSession, database: str, table: str, warehouse_dir: str) -> DataFrame:
    """S4 in a new process, whose catalog may not know the table stored below ``warehouse_dir``:
    register it (current version, or all partitions), then read it."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        register_table(spark, database, table, warehouse_dir)
    return read_table(spark, database, table)


def list_databases(spark: SparkSession) -> DataFrame:
    """M1."""
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """M2."""
    return spark.sql(f"SHOW TABLES IN {table_name(database)}")


def describe_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """M3: column names and types."""
    return spark.sql(f"DESCRIBE TABLE {table_name(database, table)}")


def describe_extended(spark: SparkSession, database: str, table: str) -> DataFrame:
    """M4: columns plus table details (location, provider, type)."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table_name(database, table)}")


def preview_table(spark: SparkSession, database: str, table: str, limit: int = 20) -> DataFrame:
    """M5: ``SELECT * ... LIMIT n``."""
    return read_table(spark, database, table).limit(positive_int(limit, "limit"))


def show_table(spark: SparkSession, database: str, table: str, limit: int = 20) -> None:
    """Print M1, M2, M3 and M5 for one table, like a catalog shell session."""
    n = positive_int(limit, "limit")
    list_databases(spark).show(truncate=False)
    list_tables(spark, database).show(truncate=False)
    describe_table(spark, database, table).show(truncate=False)
    preview_table(spark, database, table, n).show(n, truncate=False)
