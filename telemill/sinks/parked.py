"""Outcomes whose table could not take them, kept as they were staged until it can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from telemill.functions.names import quoted, route_scope
from telemill.options import Options
from telemill.sinks import tables

# What a staged outcome has; its rows are kept with their cells, so that nothing is parsed again.
COLUMNS = {
    "seq": "BIGINT",
    "topic": "STRING",
    "recv_ts": "TIMESTAMP_NTZ",
    "payload": "STRING",
    "target": "STRING",
    "pos": "INT",
    "violations": "INT",
    "route_schema": "STRING",
    "route_table": "STRING",
    "rows": "ARRAY<STRUCT<pos: INT, ts: TIMESTAMP_NTZ, id: STRING, cells: ARRAY<STRUCT<column: STRING, tag: STRING, value: VARIANT>>>>",
    "error": "STRING",
    "parked_at": "TIMESTAMP",
}


def table(spark: SparkSession, options: Options) -> DataFrame:
    return spark.table(_name(options))


def _name(options: Options) -> str:
    return tables.table_name(options.quarantine_schema, options.parked_table, options)


def park(outcomes: DataFrame, route: tuple[str, str], batch: str, error: Exception, options: Options) -> None:
    """Moves a load's accepted outcomes for one table here, with the error it failed with."""
    placed = outcomes.select(*[name for name in COLUMNS if name not in ("error", "parked_at")]).withColumns(
        {
            "error": F.lit(str(error)[:4000]),
            "parked_at": F.current_timestamp(),
            options.batch_column: F.lit(batch),
            "scope": F.lit(route_scope(*route)),
        }
    )
    tables.overwrite_partitions(placed, _name(options))


def waiting(spark: SparkSession, options: Options) -> DataFrame:
    """What is parked: a row per table and load, with the error, outcomes and rows."""
    return (
        table(spark, options)
        .groupBy("route_schema", "route_table", options.batch_column)
        .agg(
            F.min("parked_at").alias("parked_at"), F.min("error").alias("error"),
            F.count("*").alias("outcomes"), F.sum(F.size("rows")).alias("rows"),
        )
    )


def of_load(spark: SparkSession, route: tuple[str, str], batch: str, options: Options) -> DataFrame:
    """A load's parked outcomes for one table, as staged ones."""
    mine = (F.col("scope") == route_scope(*route)) & (F.col(options.batch_column) == batch)
    return table(spark, options).where(mine).withColumn("reason", F.lit(None).cast("string"))


def drop(spark: SparkSession, route: tuple[str, str], batch: str, options: Options) -> None:
    spark.sql(
        f"ALTER TABLE {_name(options)} DROP IF EXISTS PARTITION ({quoted(options.batch_column)} = {tables.literal(batch)}, "
        f"scope = {tables.literal(route_scope(*route))})"
    )


def drop_others(spark: SparkSession, batch: str, kept: set[str], options: Options) -> None:
    """Drops what an earlier attempt of a load parked and this one did not; ``kept`` are scopes."""
    tables.drop_scopes(spark, _name(options), batch, kept, options)
