"""Which rows readers see: a load's are hidden from its first write to its last.

A small table holds, per load or merge in progress, what it hides: a load's name, and the table
where only one is meant. It has no rows but while something is under way or broken off, so it
costs a reader next to nothing. A load that breaks off stays hidden until it is repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemill.functions.names import route_id
from telemill.options import Options
from telemill.sinks import tables

COLUMNS = {"hidden": "STRING", "route": "STRING"}


def _name(options: Options) -> str:
    return tables.table_name(options.quarantine_schema, options.hidden_table, options)


def hide(spark: SparkSession, by: str, names: list[str], options: Options, route: tuple[str, str] | None = None) -> None:
    """Hides the rows of the named loads, in one table or in all, until ``show``."""
    rows = spark.createDataFrame([(name, route and route_id(*route)) for name in names], ", ".join(f"{k} {v}" for k, v in COLUMNS.items()))
    tables.overwrite_partitions(rows.coalesce(1).withColumn(options.batch_column, F.lit(by)), _name(options))


def show(spark: SparkSession, by: str, options: Options) -> None:
    """The one step after which readers see what ``by`` has hidden."""
    spark.sql(f"ALTER TABLE {_name(options)} DROP IF EXISTS PARTITION (`{options.batch_column}` = {tables.literal(by)})")


def hidden(spark: SparkSession, schema: str, table: str, options: Options, loads: bool = True) -> list[str]:
    """Loads whose rows in a table are not to be read: those in progress and those broken off, or
    without ``loads`` only what a merge hides in this table."""
    if not spark.catalog.tableExists(_name(options)):
        return []
    route = F.col("route")
    mine = route == route_id(schema, table)
    rows = spark.table(_name(options)).where(route.isNull() | mine if loads else mine)
    return sorted({row.hidden for row in rows.select("hidden").collect()})


def hiding(spark: SparkSession, options: Options) -> dict[str, list[str]]:
    """What is under way or broken off: the load or merge that hides, and the names it hides."""
    if not spark.catalog.tableExists(_name(options)):
        return {}
    found: dict[str, list[str]] = {}
    for row in spark.table(_name(options)).select(options.batch_column, "hidden").toLocalIterator():
        found.setdefault(row[0], []).append(row.hidden)
    return found


def visible(rows: DataFrame, schema: str, table: str, options: Options) -> DataFrame:
    """The rows of a table that are committed."""
    if options.batch_column not in rows.columns:
        return rows
    names = hidden(rows.sparkSession, schema, table, options)
    return rows.where(~F.col(options.batch_column).isin(names)) if names else rows
