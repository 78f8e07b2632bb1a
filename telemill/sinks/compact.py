"""Merging the partitions of closed loads."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession, functions as F

from telemill.options import Options
from telemill.sinks import commits, days, quarantine, tables


def compact(
    spark: SparkSession, schema: str, table: str, batches: list[str], options: Options | None = None
) -> str:
    """Merges what the named loads have in a table into one partition per day (hour or month, as
    the table has them); returns the name it has instead of theirs, which is made of the names.

    The loads must be closed: complete, and not to be run again, which for a stream leaves
    out its last micro-batch. They are noted as closed first, and a load of such a name is
    refused from then on, so that no row can be stored a second time. Run again after a
    failure, the merge is finished: days that are merged already stay, and what is left of
    the loads' own partitions is dropped. Readers see either the loads' rows or the merged ones.
    """
    options = options or Options()
    into = "merged-" + hashlib.sha256("\n".join(sorted(batches)).encode()).hexdigest()[:20]
    name = tables.table_name(schema, table, options)
    batch = F.col(options.batch_column)
    for one in batches:
        noted = quarantine.ledger(spark, options, one).select("route_schema", "route_table", "merged").distinct().collect()
        if not noted or any(row.merged is None for row in noted):
            quarantine.note(spark, one, [tuple(row[:2]) for row in noted], options, merged=into)
    left = {one: tables.batch_chunks(spark, schema, table, one, options) for one in batches}
    merged = set(tables.batch_chunks(spark, schema, table, into, options))
    unmerged = sorted({x for found in left.values() for x in found} - merged)
    if not merged or unmerged:
        commits.hide(spark, into, [into], options, (schema, table))
    if unmerged:
        rows = spark.table(name).where(batch.isin(*batches))
        rows = rows.where(tables.of_chunks(unmerged, options))
        keys = [key for key in (options.date_column, options.hour_column) if key in rows.columns]
        placed = rows.hint("rebalance", *keys).withColumn(options.batch_column, F.lit(into))
        tables.overwrite_partitions(placed, name)
    # In one step the merged rows are seen and the loads' own are not.
    commits.hide(spark, into, batches, options, (schema, table))
    for one, found in left.items():
        tables.drop_chunks(spark, schema, table, one, found, options)
    days.merge(spark, schema, table, batches, into, options)
    commits.show(spark, into, options)
    return into
