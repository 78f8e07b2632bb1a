"""Rows of plain tables, numbered by a generated key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from telemill.functions.names import quoted, route_id
from telemill.options import Options
from telemill.session import scratch
from telemill.sinks import tables
from telemill.sinks.tables import DEFINITIONS, overwrite_partitions, table_name

# monotonically_increasing_id() counts rows of a partition in its lower 33 bits.
ROWS_PER_PARTITION = 2**33


def number_rows(rows: DataFrame, folder: str, order: list[str], first: int = 1) -> DataFrame:
    """Adds ``id``: first, first + 1, ... in the given order, without moving all rows to
    one task. Rows are sorted in ranges and numbered within each; only the ranges' counts
    meet. They are written to ``folder`` in between, so that both uses see the same ranges.
    Rows equal in ``order`` keep their input order, and a large group of them is split over
    ranges."""
    placed = _in_ranges(rows, folder, order)
    return _numbered(placed, rows.columns, first)


def _in_ranges(rows: DataFrame, folder: str, order: list[str]) -> DataFrame:
    position = F.monotonically_increasing_id()
    (
        rows.withColumn("_input", position)
        .repartitionByRange(*order, "_input")
        .sortWithinPartitions(*order, "_input")
        .withColumn("_range", F.shiftright(position, 33))
        .withColumn("_offset", position % ROWS_PER_PARTITION)
        .drop("_input")
        .write.parquet(folder)
    )
    return rows.sparkSession.read.parquet(folder)


def _numbered(placed: DataFrame, columns: list[str], first: int) -> DataFrame:
    counts = placed.groupBy("_range").agg(F.count("*").alias("_rows"))
    # One row per range, that is per task of the sort.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return placed.join(F.broadcast(starts), "_range").select(
        (F.col("_start") + F.col("_offset") + first).alias("id"), *columns
    )


KEY_RANGES = {"first": "BIGINT", "rows": "BIGINT"}


def _ranges(options: Options) -> str:
    return table_name(options.quarantine_schema, options.keys_table, options)


def reserve(spark: SparkSession, schema: str, table: str, batch: str, rows: int, options: Options) -> int:
    """The first key of a range of ``rows`` for the append named ``batch``; no other append gets
    one of them. The same append has the same range again unless it has more rows than before,
    then it gets a new one at the end and its old keys stay unused."""
    ranges, route = _ranges(options), route_id(schema, table)
    with DEFINITIONS:
        if not spark.catalog.tableExists(ranges):
            tables.ensure_schema(spark, options.quarantine_schema, options)
            columns = ", ".join(f"{name} {kind}" for name, kind in KEY_RANGES.items())
            batch_ = quoted(options.batch_column)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {ranges} ({columns}, route STRING, {batch_} STRING) USING parquet PARTITIONED BY (route, {batch_})")
        known = spark.table(ranges).where(F.col("route") == route)
        mine = F.col(options.batch_column) == batch
        found = known.agg(
            F.max(F.when(mine, F.col("first"))).alias("first"), F.max(F.when(mine, F.col("rows"))).alias("rows"),
            F.max(F.col("first") + F.col("rows")).alias("next"),
        ).first()
        if found["first"] is not None and rows <= found["rows"]:
            return found["first"]
        # Rows of before ranges were kept, or of another writer, have keys too.
        stored = spark.table(table_name(schema, table, options)).agg(F.max("id")).first()[0] if found["next"] is None else 0
        first = max(found["next"] or 0, (stored or 0) + 1)
        row = spark.createDataFrame([(first, rows)], "first BIGINT, rows BIGINT")
        overwrite_partitions(row.withColumns({"route": F.lit(route), options.batch_column: F.lit(batch)}), ranges)
    return first


def append_plain(
    rows: DataFrame, schema: str, table: str, order: list[str], batch: str, options: Options
) -> None:
    """Appends rows to a plain table as the append named ``batch``, with keys of its own after
    those of the appends before it. Run again, it replaces its own rows under the same keys.

    Only the range of keys is given out under a lock, in a look at the ranges given before; the
    rows are sorted, numbered and written outside it, so appends run side by side.
    """
    spark = rows.sparkSession
    with scratch(spark, "numbered") as folder:
        placed = _in_ranges(rows, folder, order)
        first = reserve(spark, schema, table, batch, placed.count(), options)
        numbered = _numbered(placed, rows.columns, first)
        overwrite_partitions(numbered.withColumn(options.batch_column, F.lit(batch)), table_name(schema, table, options))
