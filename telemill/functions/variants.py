"""Reading members of a variant where a missing key and a JSON null differ.

A missing key is SQL NULL, an explicit null is a variant that holds null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# One device record. Only the parts that are ever stored are taken out of the JSON.
RECORD_TYPE = (
    "struct<timestamp:variant,schema:variant,table:variant,deviceid:variant,"
    "fields:map<string,struct<type:string,value:variant>>>"
)


def kind(value: Column) -> Column:
    """Type name of a variant without parameters: BIGINT, DECIMAL, STRING, OBJECT, ..."""
    return F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)


def is_nested(value: Column) -> Column:
    return kind(value).isin("OBJECT", "ARRAY")


def has_value(value: Column) -> Column:
    """Neither missing nor null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def text(value: Column) -> Column:
    """A value as text; NULL for a missing key and for a null."""
    return F.try_variant_get(value, "$", "string")


def text_or(value: Column, default: str) -> Column:
    """A value as text, ``default`` for a missing key only."""
    return F.when(value.isNull(), F.lit(default)).otherwise(text(value))
