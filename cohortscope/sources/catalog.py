"""Sources and marts under names of the session's catalog.

A source is asked for by a logical name. The setting `cohortscope.source.<name>` says which table stands behind it, so
that a run can be pointed at other tables without a change of code; without the setting the name is the table's.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from cohortscope.sources.versions import Versions

SETTING = "cohortscope.source."


def source(named: DataFrame | str) -> DataFrame:
    """A frame as it is, or the table of the active session that a logical name stands for."""
    if isinstance(named, DataFrame):
        return named
    spark = SparkSession.active()
    return spark.table(spark.conf.get(f"{SETTING}{named}", None) or named)


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def _analyse(spark: SparkSession, table: str) -> None:
    """Rows and column statistics, from which Spark picks joins and their order."""
    spark.sql(f"ANALYZE TABLE {_quoted(table)} COMPUTE STATISTICS FOR ALL COLUMNS")


def save(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Replace a table, with statistics, and return it as read back: a managed one, or one whose files are at `path`.
    A database in the name is made if needed."""
    spark = df.sparkSession
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(table.rsplit('.', 1)[0])}")
    df.write.mode("overwrite").format("parquet").options(**({"path": path} if path else {})).saveAsTable(table)
    _analyse(spark, table)
    return spark.table(table)


def register(versions: Versions, tables: Mapping[str, str] | Iterable[str]) -> dict[str, DataFrame]:
    """Give the published set's tables catalog names, with statistics: `tables` lists them, or maps them to names.

    Nothing is copied: each name is an external table over the current version's folder, and dropping it leaves the
    files. Register again after the next publish.
    """
    spark, folder = versions.spark, versions.current()
    names = dict(tables) if isinstance(tables, Mapping) else {table: table for table in tables}
    for table, name in names.items():
        if "." in name:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name.rsplit('.', 1)[0])}")
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
        spark.catalog.createTable(name, path=f"{folder}/{table}", source="parquet")
        _analyse(spark, name)
    return {table: spark.table(name) for table, name in names.items()}
