"""Column dictionary: the storage type of each column is set by its first writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemill.functions import cells as cell_rules
from telemill.operators.flatten import accepted

ROUTE = ("route_schema", "route_table")


def column_dictionary(outcomes: DataFrame) -> DataFrame:
    """``(route_schema, route_table, column, storage, first_seen)``; ``column`` is NULL for
    a table some of whose rows have no cells at all.

    Column set and types of a payload are those of its first row, so only that one is
    read. Tasks combine their cells to one row per column before the shuffle.
    """
    first_row = F.get("rows", F.lit(0))
    # Arrival order as one number, so that the minimum stays in the hash aggregate.
    order = F.col("seq").cast("decimal(20,0)") * 2**31 + F.coalesce(first_row["pos"], F.lit(0))
    exploded = (
        accepted(outcomes)
        .select(*ROUTE, order.cast("decimal(30,0)").alias("order"), first_row["cells"].alias("cells"))
        .select(*ROUTE, "order", F.explode_outer("cells").alias("cell"))
        .select(*ROUTE, "order", "cell.column", cell_rules.storage(F.col("cell.tag")).alias("storage"))
    )

    def first_as(storage: str):
        return F.min(F.when(F.col("storage") == storage, F.col("order"))).alias(storage)

    kinds = (cell_rules.DOUBLE, cell_rules.JSON, cell_rules.STRING)
    return (
        exploded.groupBy(*ROUTE, "column")
        .agg(*[first_as(storage) for storage in kinds])
        .select(*ROUTE, "column", *kinds, F.least(*kinds).alias("first_seen"))
        .select(
            *ROUTE,
            "column",
            F.coalesce(*[F.when(F.col(x) == F.col("first_seen"), x) for x in kinds]).alias("storage"),
            "first_seen",
        )
    )


def route_columns(dictionary: DataFrame) -> DataFrame:
    """One row per table with its columns in the order they were first seen; a table's
    columns are one schema, which its definition holds in one place anyway."""
    entry = F.struct("first_seen", "column", "storage")
    return dictionary.groupBy(*ROUTE).agg(
        F.array_sort(F.collect_list(F.when(F.col("column").isNotNull(), entry))).alias("columns")
    )
