"""Relational sink through Spark's JDBC writer."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batch_size: int = 1000,
    connections: int = 8,
    properties: dict[str, str] | None = None,
) -> None:
    """Appends rows in statements of ``batch_size``, over at most ``connections``
    connections at a time; what made the rows is not held to so few tasks. Needs the database's driver on the class path."""
    (
        df.repartition(connections)
        .write.format("jdbc")
        .mode("append")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .save()
    )
