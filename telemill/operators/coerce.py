"""Cells against the types of their columns; a payload with one misfit is refused whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemill.functions import cells as cell_rules
from telemill.operators import flatten


def row_fault(rows: Column, columns: dict[str, str]) -> Column:
    """Reason to refuse an outcome's rows for a table with these columns, or NULL. The
    table's types are literals here, so this needs no join and no shuffle."""

    def misfit(cell: Column) -> Column:
        return ~by_storage(
            cell["column"],
            columns,
            cell_rules.fits_double(cell),
            cell_rules.fits_json(cell),
            cell_rules.fits_string(cell),
        )

    some = F.exists(rows, lambda row: F.exists(row["cells"], misfit))
    return F.when(some, "cast_failed")


def by_storage(column: Column, columns: dict[str, str], double, json, string) -> Column:
    """One of three values, by the storage type of the named column."""
    doubles = [name for name, storage in columns.items() if storage == cell_rules.DOUBLE]
    jsons = [name for name, storage in columns.items() if storage in (cell_rules.JSON, cell_rules.VARIANT)]
    return F.when(column.isin(*doubles), double).when(column.isin(*jsons), json).otherwise(string)


def table_cells(outcomes: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The cells of accepted outcomes for one table, by the check that its loads use, with
    ``storage``, ``fits`` and the stored value in ``number`` or ``text_value``."""
    long = flatten.cells(flatten.rows(flatten.accepted(outcomes)))
    storage = by_storage(F.col("column"), columns, cell_rules.DOUBLE, cell_rules.JSON, cell_rules.STRING)
    one = F.struct(F.struct(F.array(F.struct("column", "tag", "value")).alias("cells")).alias("row"))
    fault = row_fault(F.array(one["row"]), columns)
    is_double = F.col("storage") == cell_rules.DOUBLE
    return (
        long.withColumn("storage", storage)
        .withColumn("fits", fault.isNull())
        .select(
            "seq",
            "column",
            "storage",
            "fits",
            F.when(is_double, cell_rules.number(F.col("value"))).alias("number"),
            F.when(~is_double, F.col("text")).alias("text_value"),
        )
    )
