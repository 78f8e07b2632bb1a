"""Latest rows and time ranges of a table."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from telemill.functions.names import quoted
from telemill.operators.flatten import column_list
from telemill.options import Options
from telemill.sinks import days, tables
from telemill.sinks.commits import visible


def scan(spark: SparkSession, schema: str, table: str, options: Options | None = None) -> DataFrame:
    """All committed rows and all columns of a table, without its partition columns."""
    options = options or Options()
    return _rows(spark, schema, table, options).drop(*options.partition_columns)


def latest(
    spark: SparkSession,
    schema: str,
    table: str,
    column: str = "*",
    order: str | list[str] = "id",
    limit: int = 5,
    expressions: list[Column] | None = None,
    options: Options | None = None,
) -> DataFrame:
    """Project, order descending with NULLs first, limit.

    ``column`` is a list of names as text; ``expressions`` are further columns. A missing
    table or column gives an empty result. Ordered by the time column, a time-partitioned
    table is read from its newest days back only as far as the rows noted for each day reach.
    Rows of a load that is not complete are not seen.
    """
    options = options or Options()
    keys = [order] if isinstance(order, str) else list(order)
    name = quoted(options.database(schema), table)
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], StructType())
    rows = _rows(spark, schema, table, options)
    known = {field.lower() for field in rows.columns}
    stored = rows.drop(*options.partition_columns)
    wanted = [quoted(x) for x in stored.columns] if column.strip() == "*" else column_list(column)
    if any(_bare(x) not in known for x in [*wanted, *keys]):
        return spark.createDataFrame([], StructType())
    if keys[0].lower() == options.ts_column.lower() and options.date_column in rows.columns:
        day = _first_day(rows, schema, table, limit, options)
        if day is not None:
            rows = rows.where(F.col(options.date_column) >= day)
    ordered = rows.orderBy(*[F.col(quoted(_bare(key))).desc_nulls_first() for key in keys])
    # The sort keys need not be projected; Catalyst keeps them until the top rows are known.
    return ordered.limit(limit).select(*[F.col(x) for x in wanted], *(expressions or []))


def time_range(
    spark: SparkSession,
    schema: str,
    table: str,
    start: datetime.datetime,
    end: datetime.datetime,
    options: Options | None = None,
) -> DataFrame:
    """Rows with start <= time < end. A bound on the time column prunes no partitions by
    itself, so the same bound is put on the date, and the hour, they are partitioned by. Times in
    the tables have no zone, so neither have the bounds."""
    if start.tzinfo is not None or end.tzinfo is not None:
        raise ValueError("times in the tables have no zone; give bounds without one")
    options = options or Options()
    rows = _rows(spark, schema, table, options)
    ts, day = F.col(options.ts_column), F.col(options.date_column)
    chunk = tables.chunk_of(spark, schema, table, options)
    first = start.date().replace(day=1) if chunk == "month" else start.date()
    bounded = rows.where((ts >= _ntz(start)) & (ts < _ntz(end))).where(day.between(F.lit(first), F.lit(end.date())))
    if chunk == "hour":
        hour = F.col(options.hour_column)
        bounded = bounded.where((day > F.lit(first)) | (hour >= start.hour))
        bounded = bounded.where((day < F.lit(end.date())) | (hour <= end.hour))
    return bounded.drop(*options.partition_columns)


def _rows(spark: SparkSession, schema: str, table: str, options: Options) -> DataFrame:
    return visible(spark.table(quoted(options.database(schema), table)), schema, table, options)


def _ntz(value: datetime.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def _bare(name: str) -> str:
    return name.strip("`").lower()


def _first_day(rows: DataFrame, schema: str, table: str, limit: int, options: Options) -> Column | None:
    noted, first = days.first_needed(rows.sparkSession, schema, table, limit, options)
    if not noted:
        return _oldest_day_needed(rows, limit, options)
    return None if first is None else F.date_from_unix_date(F.lit(first))


def _oldest_day_needed(rows: DataFrame, limit: int, options: Options) -> Column | None:
    """For tables no day is noted of: first day such that it and all later ones hold ``limit``
    rows, looking back 1, 2, 4, ... days from the newest one; None if the whole table does not.
    Days are counted from 1970, so any date a table holds will do, and a look reads the footers
    of the files of its days only."""
    day = F.unix_date(F.col(options.date_column))
    newest, oldest = rows.agg(F.max(day), F.min(day)).first()
    back = 1
    while newest is not None and newest - back + 1 > oldest:
        first = F.date_from_unix_date(F.lit(newest - back + 1))
        if rows.where(F.col(options.date_column) >= first).count() >= limit:
            return first
        back *= 2
    return None
