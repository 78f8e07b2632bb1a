"""Accepted outcomes as rows, as long cells and as a wide projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemill.functions import cells as cell_rules
from telemill.functions.names import quoted
from telemill.options import Options

ROW_KEYS = ("seq", "target", "route_schema", "route_table")


def accepted(outcomes: DataFrame, target: str | None = None) -> DataFrame:
    kept = outcomes.where(F.col("reason").isNull())
    return kept if target is None else kept.where(F.col("target") == target)


def rejected(outcomes: DataFrame) -> DataFrame:
    """Quarantine rows of refused outcomes."""
    return outcomes.where(F.col("reason").isNotNull()).select(
        "seq", "topic", "recv_ts", "target", "pos", "reason", "violations", "payload"
    )


def rows(accepted: DataFrame) -> DataFrame:
    """One row per record: ``pos, ts, id, cells`` beside the outcome's route."""
    # Rows are never empty; see outcomes() for the outer form.
    exploded = accepted.select(*ROW_KEYS, F.explode_outer("rows").alias("row"))
    return exploded.select(*ROW_KEYS, "row.pos", "row.ts", "row.id", "row.cells")


def cells(rows: DataFrame) -> DataFrame:
    """One row per cell: ``column, tag, value`` and the value as ``text``."""
    keys = [name for name in rows.columns if name != "cells"]
    exploded = rows.select(*keys, F.explode_outer("cells").alias("cell")).select(*keys, "cell.*")
    return exploded.withColumn("text", cell_rules.text(F.col("value")))


def by_column(cells: Column, columns: dict[str, str], checked: bool) -> Column:
    """Cells as a struct of the table's columns, in one cast that looks at the cells there are: the
    work of a projection grows with these and not with the columns of the table times their size."""
    kinds = {x: "double" if _as_number(storage, checked) else "variant" for x, storage in columns.items()}
    schema = ", ".join(f"{quoted(name)}: {kind}" for name, kind in kinds.items())
    return F.try_variant_get(F.to_variant_object(F.map_from_arrays(cells["column"], cells["value"])), "$", f"struct<{schema}>")


def _as_number(storage: str, checked: bool) -> bool:
    return checked and storage == cell_rules.DOUBLE


def stored_value(value: Column, storage: str, checked: bool) -> Column:
    if _as_number(storage, checked):
        return value
    if storage == cell_rules.VARIANT:
        return cell_rules.parsed(value)
    return cell_rules.number(value) if storage == cell_rules.DOUBLE else cell_rules.text(value)


def wide(
    rows: DataFrame,
    columns: dict[str, str],
    options: Options,
    *keys: str,
    checked: bool = False,
) -> DataFrame:
    """Fixed columns, then one column per entry of ``columns`` (name to storage type).
    ``keys`` are further columns of ``rows`` to keep in front. ``checked`` rows are known
    to fit and convert faster; in others a misfit cell becomes NULL."""
    cells = [by_column(F.col("cells"), columns, checked).alias("_cells")] if columns else []
    found = rows.select(*keys, "ts", "id", *cells)
    return found.select(
        *keys,
        F.col("ts").alias(options.ts_column),
        F.col("id").alias(options.id_column),
        *[
            stored_value(F.col("_cells")[name], storage, checked).alias(name)
            for name, storage in columns.items()
        ],
    )


def column_list(text: str) -> list[str]:
    """Names in a list such as ``timestamp, id, x``, quoted."""
    return [quoted(part.strip().strip("`")) for part in text.split(",") if part.strip()]
