"""Payloads of delimited lines: the same records, and the same reasons to refuse them, as of JSON.

The first line names the columns. ``timestamp``, ``schema``, ``table`` and ``deviceid`` are those of
a record; any other is a field, written ``name`` or ``name:type``. Each further line is a record;
blank lines count nothing. A cell in double quotes may hold the separator, and quotes written
twice; an empty cell without quotes is a missing value, one with quotes an empty text. Line breaks
within a cell are not possible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemill.functions import cells, strict_json
from telemill.session import configure

RECORD_KEYS = ("timestamp", "schema", "table", "deviceid")
QUOTE = '"'


def judged(raw: DataFrame, separator: str = ",") -> DataFrame:
    """Adds ``records``, ``violations`` and the ``reason`` to refuse a payload, NULL if it is sound.

    ``bad_payload_type``: no UTF-8, or no line that can name columns. ``duplicate_column``: one
    named twice. ``structure``: each line with more or fewer cells than columns, each cell with
    quotes out of place or no JSON under the json tag, and each record without fields is a
    violation. ``empty_batch``: no records.
    """
    if len(separator) != 1 or separator in '"\r\n:':
        raise ValueError(f"not a separator: {separator!r}")
    configure(raw.sparkSession)
    header, lines = F.col("_header"), F.col("_lines")
    named = F.transform(header, _unquoted)
    found = (
        raw.withColumn("_text", F.try_validate_utf8("payload"))
        .withColumn("_all", F.filter(F.split("_text", "\r?\n"), lambda line: F.trim(line) != ""))
        .withColumn("_header", _split(F.get("_all", F.lit(0)), separator))
        .withColumn("_lines", F.transform(F.slice("_all", F.lit(2), F.size("_all")), lambda line: _split(line, separator)))
        .withColumn("_columns", F.transform(named, _column))
    )
    nameless = header.isNull() | F.exists(header, lambda cell: _misquoted(cell) | (_unquoted(cell).isNull()))
    names = F.transform("_columns", lambda column: F.concat(column["name"], F.when(column["own"], "").otherwise(" ")))
    early = F.when(F.coalesce(nameless, F.lit(True)), "bad_payload_type").when(
        F.size(F.array_distinct(names)) < F.size(names), "duplicate_column"
    )
    violations = F.when(early == "bad_payload_type", 1).when(
        early.isNull(), F.aggregate(lines, F.lit(0), lambda total, line: total + _violations(line))
    )
    reason = F.coalesce(
        F.col("_early"), F.when(F.col("violations") > 0, "structure").when(F.size(lines) == 0, "empty_batch")
    )
    return (
        found.withColumn("_early", early)
        .withColumn("violations", violations)
        .withColumn("reason", reason)
        .withColumn("records", F.when(F.col("reason").isNull(), F.transform(lines, _record)))
        .select(*raw.columns, "records", "violations", "reason")
    )


def _split(line: Column, separator: str) -> Column:
    """The cells of a line, quotes included. Between quotes a separator is none; a line break is
    in no line, so it can stand for the others."""
    parts = F.split(line, QUOTE)
    outside = F.transform(
        parts, lambda part, i: F.when(i % 2 == 0, F.replace(part, F.lit(separator), F.lit("\n"))).otherwise(part)
    )
    return F.split(F.array_join(outside, QUOTE), "\n")


def _inner(cell: Column) -> Column:
    return F.substring(cell, F.lit(2), F.length(cell) - 2)


def _misquoted(cell: Column) -> Column:
    closed = (F.length(cell) > 1) & cell.endswith(QUOTE)
    inside = F.replace(_inner(cell), F.lit(QUOTE * 2), F.lit(""))
    return F.when(cell.startswith(QUOTE), ~closed | inside.contains(QUOTE)).otherwise(cell.contains(QUOTE))


def _unquoted(cell: Column) -> Column:
    """What a cell holds; NULL for an empty one without quotes."""
    text = F.when(cell.startswith(QUOTE), F.replace(_inner(cell), F.lit(QUOTE * 2), F.lit(QUOTE))).otherwise(cell)
    return F.when(cell != "", text)


def _column(name: Column) -> Column:
    """Name and type of a column, and whether it is one of the record itself."""
    own = name.isin(*RECORD_KEYS)
    tag = F.when(name.contains(":"), F.substring_index(name, ":", -1))
    bare = F.when(name.contains(":"), F.substring(name, F.lit(1), F.length(name) - F.length(tag) - 1)).otherwise(name)
    return F.struct(bare.alias("name"), tag.alias("type"), own.alias("own"))


def _cells(line: Column) -> Column:
    """Cells of a line, each beside its column."""
    return F.zip_with(F.col("_columns"), line, lambda column, cell: F.struct(column.alias("column"), cell.alias("cell")))


def _is_field(one: Column) -> Column:
    return ~one["column"]["own"]


def _violations(line: Column) -> Column:
    def bad(one: Column) -> Column:
        text = _unquoted(one["cell"])
        no_json = _is_json(one) & text.isNotNull() & ~strict_json.is_strict_text(text)
        return _misquoted(one["cell"]) | no_json

    no_fields = F.when(F.exists(F.col("_columns"), lambda column: ~column["own"]), 0).otherwise(1)
    of_cells = no_fields + F.size(F.filter(_cells(line), bad))
    return F.when(F.size(line) != F.size("_columns"), 1).otherwise(of_cells)


def _is_json(one: Column) -> Column:
    return F.coalesce(one["column"]["type"] == cells.JSON_TAG, F.lit(False))


def _record(line: Column) -> Column:
    def member(name: str) -> Column:
        mine = F.filter(_cells(line), lambda one: one["column"]["own"] & (one["column"]["name"] == name))
        return _unquoted(F.get(mine, F.lit(0))["cell"]).cast("variant").alias(name)

    def field(one: Column) -> Column:
        text = _unquoted(one["cell"])
        value = F.when(_is_json(one), F.try_parse_json(text)).otherwise(text.cast("variant"))
        return F.struct(one["column"]["name"], F.struct(one["column"]["type"].alias("type"), value.alias("value")))

    fields = F.map_from_entries(F.transform(F.filter(_cells(line), _is_field), field))
    return F.struct(*map(member, RECORD_KEYS), fields.alias("fields"))
