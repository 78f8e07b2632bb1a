"""How many rows each table has per day and load, noted with every append."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from telemill.functions.names import route_id
from telemill.options import Options
from telemill.sinks import tables
from telemill.sinks.commits import hidden

COLUMNS = {"day": "DATE", "rows": "BIGINT"}


def _name(options: Options) -> str:
    return tables.table_name(options.quarantine_schema, options.days_table, options)


def _write(counts: DataFrame, schema: str, table: str, batch: str, options: Options) -> None:
    placed = counts.coalesce(1).withColumns({"route": F.lit(route_id(schema, table)), options.batch_column: F.lit(batch)})
    tables.overwrite_partitions(placed, _name(options))


def forget(spark: SparkSession, schema: str, table: str, batch: str, options: Options) -> None:
    spark.sql(
        f"ALTER TABLE {_name(options)} DROP IF EXISTS PARTITION "
        f"(route = {tables.literal(route_id(schema, table))}, `{options.batch_column}` = {tables.literal(batch)})"
    )


def note(spark: SparkSession, schema: str, table: str, batch: str, rows: int, options: Options) -> None:
    """Writes down the days (months in a table by months) a load has just filled in a table, ``rows``
    in all. Where they are several, their files' footers are counted, those of this load alone."""
    days = sorted({day for day, _ in tables.batch_chunks(spark, schema, table, batch, options)}) if rows else []
    if not days:
        forget(spark, schema, table, batch, options)
        return
    if len(days) == 1:
        found = spark.createDataFrame([(days[0], rows)], "day STRING, rows BIGINT").withColumn("day", F.col("day").cast("date"))
    else:
        own = spark.table(tables.table_name(schema, table, options)).where(F.col(options.batch_column) == batch)
        found = own.groupBy(F.col(options.date_column).alias("day")).agg(F.count("*").alias("rows"))
    _write(found, schema, table, batch, options)


def counts(spark: SparkSession, schema: str, table: str, options: Options) -> DataFrame | None:
    """``day, rows`` and the load, as far as noted; None where nothing can have been."""
    if not spark.catalog.tableExists(_name(options)):
        return None
    return spark.table(_name(options)).where(F.col("route") == route_id(schema, table)).drop("route")


def merge(spark: SparkSession, schema: str, table: str, batches: list[str], into: str, options: Options) -> None:
    """The notes of loads that were merged, under the name they have now."""
    known = counts(spark, schema, table, options)
    merged = known.where(F.col(options.batch_column).isin([*batches, into])).groupBy("day").agg(F.sum("rows").alias("rows"))
    # A row per day the table has at most. As numbers of days: a table may hold days that Python does not know.
    rows = [tuple(row) for row in merged.select(F.unix_date("day"), "rows").toLocalIterator()]
    if rows:
        summed = spark.createDataFrame(rows, "day INT, rows BIGINT").withColumn("day", F.date_from_unix_date("day"))
        _write(summed, schema, table, into, options)
    for batch in batches:
        forget(spark, schema, table, batch, options)


def first_needed(spark: SparkSession, schema: str, table: str, limit: int, options: Options) -> tuple[bool, int | None]:
    """Whether days are noted, and the first day (counted from 1970) such that it and all later
    ones hold ``limit`` rows, None if the whole table does not. Rows that were never noted only
    make it an earlier day than needed."""
    known = counts(spark, schema, table, options)
    if known is None:
        return False, None
    left = ~F.col(options.batch_column).isin(hidden(spark, schema, table, options))
    per_day = known.where(left).groupBy(F.unix_date("day").alias("day")).agg(F.sum("rows").alias("rows"))
    # One row per day the table has.
    later = Window.orderBy(F.col("day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = per_day.withColumn("later", F.coalesce(F.sum("rows").over(later), F.lit(0))).agg(
        F.min(F.when(F.col("later") < limit, F.col("day"))).alias("day"), F.sum("rows").alias("rows"), F.min("day").alias("oldest")
    )
    found = needed.first()
    if found.rows is None:
        return False, None
    return True, found.day if found.rows >= limit and found.day > found.oldest else None
