"""Catalog tables: create, widen and append."""

from __future__ import annotations

from contextlib import suppress
from threading import RLock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemill.functions import cells as cell_rules
from telemill.functions.names import quoted
from telemill.options import Options

# Spark types of the storage types. JSON is text; a column comment tells it from a string.
SPARK_TYPES = {
    cell_rules.DOUBLE: "DOUBLE", cell_rules.STRING: "STRING", cell_rules.JSON: "STRING", cell_rules.VARIANT: "VARIANT",
}
JSON_COMMENT = "json"

# Widths of a table's partitions, and the property that tells which one it has.
CHUNKS = ("hour", "day", "month")
CHUNK_PROPERTY = "telemill.chunk"

# Definitions are read, compared and changed under one lock per application. Across
# applications one of them should define the tables; a column that another has added
# meanwhile is taken as it is.
DEFINITIONS = RLock()


class NotATimeTable(Exception):
    """A table of that name exists and is none that loads can append to."""


class OtherType(Exception):
    """A column that a load has values for is of a type that loads do not make."""


def ensure_schema(spark: SparkSession, schema: str, options: Options) -> None:
    database = options.database(schema)
    place = f" LOCATION '{options.warehouse}/{database}'" if options.warehouse else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{place}")


def table_name(schema: str, table: str, options: Options) -> str:
    return quoted(options.database(schema), table)


def _definition(column: str, storage: str, options: Options) -> str:
    if storage == cell_rules.JSON and options.json_as == "variant":
        storage = cell_rules.VARIANT
    comment = f" COMMENT '{JSON_COMMENT}'" if storage == cell_rules.JSON else ""
    return f"{quoted(column)} {SPARK_TYPES[storage]}{comment}"


def create_time_table(
    spark: SparkSession, schema: str, table: str, columns: dict[str, str], options: Options
) -> None:
    """Table with the fixed pair, nullable data columns, and one partition per day, hour or month
    (``options.chunk``) and load."""
    if options.chunk not in CHUNKS:
        raise ValueError(f"no width {options.chunk!r} of partitions; known: {', '.join(CHUNKS)}")
    hours = [options.hour_column] if options.chunk == "hour" else []
    definitions = [
        f"{quoted(options.ts_column)} TIMESTAMP_NTZ NOT NULL",
        f"{quoted(options.id_column)} STRING NOT NULL",
        *[_definition(name, storage, options) for name, storage in columns.items()],
        f"{quoted(options.date_column)} DATE",
        *[f"{quoted(hour)} INT" for hour in hours],
        f"{quoted(options.batch_column)} STRING",
    ]
    partitions = ", ".join(quoted(x) for x in (options.date_column, *hours, options.batch_column))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(schema, table, options)} "
        f"({', '.join(definitions)}) USING parquet PARTITIONED BY ({partitions}) "
        f"TBLPROPERTIES ('{CHUNK_PROPERTY}' = '{options.chunk}')"
    )


def chunk_of(spark: SparkSession, schema: str, table: str, options: Options) -> str:
    """The width of a table's partitions, as the catalog has it; a day where it says nothing."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table_name(schema, table, options)}")
    return next((row.value for row in found.collect() if row.key == CHUNK_PROPERTY), "day")


def create_plain_table(
    spark: SparkSession, schema: str, table: str, columns: dict[str, str], options: Options
) -> None:
    """Table with a generated key ``id`` and nullable data columns, one partition per append."""
    definitions = ["id BIGINT", *[_definition(name, storage, options) for name, storage in columns.items()]]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(schema, table, options)} "
        f"({', '.join(definitions)}, {quoted(options.batch_column)} STRING) "
        f"USING parquet PARTITIONED BY ({quoted(options.batch_column)})"
    )


def stored_columns(
    spark: SparkSession, schema: str, table: str, options: Options
) -> dict[str, str | None] | None:
    """Data columns of a table with their storage types, None for a type that loads do not make;
    None if there is no table."""
    name = table_name(schema, table, options)
    if not spark.catalog.tableExists(name):
        return None
    columns = {}
    for field in spark.table(name).schema.fields:
        if field.name.lower() in options.reserved_columns:
            continue
        if field.dataType.simpleString() == "double":
            columns[field.name.lower()] = cell_rules.DOUBLE
        elif field.dataType.simpleString() == "variant":
            columns[field.name.lower()] = cell_rules.VARIANT
        elif field.metadata.get("comment") == JSON_COMMENT:
            columns[field.name.lower()] = cell_rules.JSON
        elif field.dataType.simpleString() == "string":
            columns[field.name.lower()] = cell_rules.STRING
        else:
            columns[field.name.lower()] = None
    return columns


def add_columns(
    spark: SparkSession, schema: str, table: str, columns: dict[str, str], options: Options
) -> None:
    """Adds the columns the table lacks; types of existing ones never change."""
    present = stored_columns(spark, schema, table, options) or {}
    missing = [_definition(x, storage, options) for x, storage in columns.items() if x.lower() not in present]
    if missing:
        name = table_name(schema, table, options)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(missing)})")


def ensure_table(
    spark: SparkSession, schema: str, table: str, columns: dict[str, str], options: Options
) -> dict[str, str]:
    """Creates or widens a table for ``columns``, in their order. Returns all data columns
    the table then has, as read from it. Nothing is defined where nothing is new."""
    with DEFINITIONS:
        present = stored_columns(spark, schema, table, options)
        if present is None:
            ensure_schema(spark, schema, options)
            create_time_table(spark, schema, table, columns, options)
            present = stored_columns(spark, schema, table, options)
        _check_time_table(spark, schema, table, options)
        while not present.keys() >= columns.keys():
            # Another application may have added one of them; then the rest is added next.
            with suppress(AnalysisException):
                add_columns(spark, schema, table, columns, options)
            spark.catalog.refreshTable(table_name(schema, table, options))
            before, present = present, stored_columns(spark, schema, table, options)
            if present == before:
                add_columns(spark, schema, table, columns, options)
    odd = sorted(name for name in columns if present[name] is None)
    if odd:
        raise OtherType(f"columns of other types than DOUBLE, STRING and VARIANT: {', '.join(odd)}")
    return present


def _check_time_table(spark: SparkSession, schema: str, table: str, options: Options) -> None:
    found = {name.lower() for name in spark.table(table_name(schema, table, options)).columns}
    if not found >= set(options.table_columns):
        raise NotATimeTable(f"{schema}.{table}")


#: The day (or the first one of a month) of a partition, and its hour, if it is of one.
Chunk = tuple[str, str]


def batch_chunks(spark: SparkSession, schema: str, table: str, batch: str, options: Options) -> list[Chunk]:
    """What a load has partitions of in a table; as many as the load has days (hours, months)."""
    listed = spark.sql(
        f"SHOW PARTITIONS {table_name(schema, table, options)} "
        f"PARTITION ({quoted(options.batch_column)} = {literal(batch)})"
    )
    keys = [F.regexp_extract("partition", f"(?:^|/){x}=([^/]*)", 1) for x in (options.date_column, options.hour_column)]
    return [tuple(row) for row in listed.select(*keys).collect()]


def of_chunks(chunks: list[Chunk], options: Options) -> Column:
    """Whether a row of a table lies in one of these; prunes partitions."""
    day = F.col(options.date_column)
    days = day.isin(*[F.lit(x).cast("date") for x in sorted({day for day, _ in chunks})])
    if not any(hour for _, hour in chunks):
        return days
    return days & F.concat_ws(" ", day.cast("string"), F.col(options.hour_column).cast("string")).isin(*map(" ".join, chunks))


def drop_chunks(
    spark: SparkSession, schema: str, table: str, batch: str, chunks: list[Chunk], options: Options
) -> None:
    """Drops partitions of a load."""
    own = {options.batch_column: batch}
    specs = [{options.date_column: day, **({options.hour_column: hour} if hour else {}), **own} for day, hour in chunks]
    drop_partitions(spark, table_name(schema, table, options), specs)


def drop_scopes(spark: SparkSession, name: str, batch: str, kept: set[str], options: Options) -> None:
    """Drops a load's partitions of a table by load and scope, but for the scopes in ``kept``. The
    catalog lists them; no file is read."""
    own = f"{quoted(options.batch_column)} = {literal(batch)}"
    listed = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({own})")
    scope = F.regexp_extract("partition", "scope=([^/]*)", 1)
    for row in listed.select(scope.alias("scope")).toLocalIterator():
        if row.scope not in kept:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({own}, scope = {literal(row.scope)})")


#: Partitions that one statement drops.
DROPPED_AT_ONCE = 200


def drop_partitions(spark: SparkSession, name: str, specs: list[dict[str, str]]) -> None:
    """Drops partitions, each given by all its keys."""
    named = ["PARTITION (" + ", ".join(f"{quoted(key)} = {literal(x)}" for key, x in spec.items()) + ")" for spec in specs]
    for first in range(0, len(named), DROPPED_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(named[first : first + DROPPED_AT_ONCE])}")


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def append(
    df: DataFrame, schema: str, table: str, batch: str, options: Options, gather: bool = True
) -> None:
    """Writes one load into its own partitions, replacing what an earlier attempt of the
    same load left there; columns ``df`` lacks are NULL.

    ``gather`` brings rows together by partition so that a task does not open a file of each;
    the rebalance splits those that are too large for one task. Leave it out where the rows
    already lie by day.
    """
    chunk, ts = chunk_of(df.sparkSession, schema, table, options), F.col(options.ts_column)
    keys = {options.date_column: F.trunc(ts.cast("date"), "month") if chunk == "month" else ts.cast("date")}
    if chunk == "hour":
        keys[options.hour_column] = F.hour(ts)
    dated = df.withColumns(keys)
    if gather:
        dated = dated.hint("rebalance", *keys)
    placed = dated.withColumn(options.batch_column, F.lit(batch))
    overwrite_partitions(placed, table_name(schema, table, options))


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replaces the partitions ``df`` has rows for. In this mode each writer stages its
    files in a folder of its own, so several may write to a table at a time."""
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {name} WITH (partitionOverwriteMode = 'dynamic') "
        "BY NAME SELECT * FROM {rows}",
        rows=df,
    )
