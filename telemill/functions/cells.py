"""Field tags, and what a cell becomes in a column of a given storage type.

A cell is ``struct<column, tag, value>``: the lower-cased field name, the field's logical
type, and its value as a variant, a missing or null one standing for SQL NULL. Under the
json tag the value is the JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from telemill.functions import strict_json, variants

# Logical type tags and the storage they get; any other tag is text.
NUMBER_TAGS = ("int", "float")
JSON_TAG = "json"
DEFAULT_TAG = "str"
DOUBLE, JSON, STRING = "DOUBLE", "JSON", "STRING"
# A column that holds JSON parsed; for cells it is like one of JSON text.
VARIANT = "VARIANT"

# Fixed patterns: spellings of a double precision number.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NOT_FINITE = r"(?i)^\s*(nan|[+-]?inf(inity)?)\s*$"


def storage(tag: Column) -> Column:
    return (
        F.when(tag.isin(*NUMBER_TAGS), DOUBLE).when(tag == JSON_TAG, JSON).otherwise(STRING)
    )


def digest(entry: Column, missing: str | None = None) -> Column:
    """Cell of one entry of a field map. ``missing`` is the text of a field without a
    value; by default that is NULL, or the JSON text null under the json tag."""
    field = entry["value"]
    value = field["value"]
    tag = F.coalesce(field["type"], F.lit(DEFAULT_TAG))
    json_text = F.coalesce(F.to_json(value), F.lit("null"))
    stored = F.when(tag == JSON_TAG, json_text.cast("variant")).otherwise(value)
    if missing is not None:
        stored = F.when(value.isNull(), F.lit(missing).cast("variant")).otherwise(stored)
    return F.struct(
        F.lower(entry["key"]).alias("column"), tag.alias("tag"), stored.alias("value")
    )


def digests(fields: Column, columns: Column) -> Column:
    """Cells of a field map whose names are ``columns`` in lower case. Where every field has a tag
    and none the json tag, tags and values are laid side by side as they are."""
    entries = F.map_values(fields)
    tags = entries["type"]
    as_they_are = F.coalesce(~F.array_contains(tags, JSON_TAG), F.lit(False))
    zipped = F.arrays_zip(columns.alias("column"), tags.alias("tag"), entries["value"].alias("value"))
    return F.when(as_they_are, zipped).otherwise(F.transform(F.map_entries(fields), lambda entry: digest(entry)))


def text(value: Column) -> Column:
    """A cell's value as text. A number keeps the fraction it was written with: one without
    a fraction is an integer where it fits one, so a decimal of scale 0 that does was
    written as 5.0."""
    as_text = variants.text(value)
    schema = F.schema_of_variant(value)
    whole = schema.startswith("DECIMAL") & schema.endswith(",0)")
    return F.when(
        whole & as_text.try_cast("bigint").isNotNull(), F.concat(as_text, F.lit(".0"))
    ).otherwise(as_text)


def number_of_text(text: Column) -> Column:
    """Text as a double; NULL unless it is a number within range. Narrower than a plain
    cast, which also takes literals such as ``65.7d``."""
    value = F.trim(text).try_cast("double")
    finite = text.rlike(NUMBER) & (F.abs(value) < F.lit(float("inf")))
    return F.when(finite | text.rlike(NOT_FINITE), value)


def number(value: Column) -> Column:
    """A cell's value as a double; NULL for anything but numbers and numbers as text."""
    kind = variants.kind(value)
    return F.when(kind.isin("DECIMAL", "DOUBLE", "BIGINT"), as_double(value)).when(
        kind == "STRING", number_of_text(variants.text(value))
    )


def as_double(value: Column) -> Column:
    """The same for a value that is known to fit a DOUBLE column."""
    return F.try_variant_get(value, "$", "double")


def parsed(value: Column) -> Column:
    """A cell's JSON text as what it says."""
    return F.try_parse_json(text(value))


def fits_double(cell: Column) -> Column:
    value = cell["value"]
    kind = variants.kind(value)
    as_text = number_of_text(variants.text(value))
    return (
        F.when(kind.isin("DECIMAL", "DOUBLE", "BIGINT"), True)
        .when(kind == "STRING", as_text.isNotNull())
        .otherwise(~variants.has_value(value))
    )


def fits_string(cell: Column) -> Column:
    return ~variants.has_value(cell["value"]) | ~variants.is_nested(cell["value"])


def fits_json(cell: Column) -> Column:
    value = variants.text(cell["value"])
    written_as_json = (cell["tag"] == JSON_TAG) & (value != "")
    json_string = (variants.kind(cell["value"]) == "STRING") & strict_json.is_strict_text(value)
    return ~variants.has_value(cell["value"]) | written_as_json | json_string


def fits(cell: Column, storage_type: Column) -> Column:
    """Whether the cell can be stored in a column of that type."""
    return (
        F.when(storage_type == DOUBLE, fits_double(cell))
        .when(storage_type.isin(JSON, VARIANT), fits_json(cell))
        .otherwise(fits_string(cell))
    )
