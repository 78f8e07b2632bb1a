"""Payload text to records, and the structural check of a payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemill.functions import strict_json
from telemill.functions.variants import RECORD_TYPE
from telemill.session import configure

# Reasons that concern the payload as a whole; it then has neither rows nor messages.
STRUCTURE_REASONS = ("bad_json", "bad_payload_type", "structure", "empty_batch")


def decode(raw: DataFrame) -> DataFrame:
    """Adds ``root`` (object, list, other; NULL if the payload is not valid UTF-8 JSON),
    the parsed document ``doc`` and its ``records``. Each payload is parsed once."""
    configure(raw.sparkSession)
    names = raw.columns
    text, wrapped = F.col("_text"), F.col("_wrapped")
    return (
        raw.withColumn("_text", F.try_validate_utf8("payload"))
        .withColumn("_wrapped", strict_json.wrap(text))
        .withColumn(
            "root", F.when(strict_json.is_strict(text, wrapped), strict_json.root_kind(text))
        )
        .select(
            *names,
            "root",
            F.when(F.col("root").isNotNull(), F.try_variant_get(wrapped, "$[0]", "variant")).alias("doc"),
            _records(F.col("root"), wrapped).alias("records"),
        )
    )


def _records(root: Column, wrapped: Column) -> Column:
    """A record is NULL where the element is not an object; its ``fields`` are NULL where
    they are not an object, and so is each field that is not one."""
    one = F.array(F.try_variant_get(wrapped, "$[0]", RECORD_TYPE))
    many = F.try_variant_get(wrapped, "$[0]", f"array<{RECORD_TYPE}>")
    return F.when(root == "object", one).when(root == "list", many)


def judge(decoded: DataFrame) -> DataFrame:
    """Adds the number of ``violations`` of the payload structure and the ``reason`` to
    refuse the payload, NULL if its structure is sound."""
    root = F.col("root")
    violations = F.when(root == "other", 1).when(root.isNotNull(), _violations(F.col("records")))
    return decoded.withColumn("violations", violations).withColumn(
        "reason",
        F.when(root.isNull(), "bad_json")
        .when(root == "other", "bad_payload_type")
        .when(F.col("violations") > 0, "structure")
        .when(F.size("records") == 0, "empty_batch"),
    )


def _violations(records: Column) -> Column:
    def of_record(record: Column) -> Column:
        fields = record["fields"]
        no_fields = fields.isNull() | (F.cardinality(fields) == 0)
        not_objects = F.size(F.filter(F.map_values(fields), lambda field: field.isNull()))
        return F.when(no_fields, 1).otherwise(not_objects)

    return F.aggregate(records, F.lit(0), lambda total, record: total + of_record(record))


def elements(judged: DataFrame) -> DataFrame:
    """One row per record of the sound payloads: ``seq, topic, pos, record``."""
    kept = F.when(F.col("reason").isNull(), F.col("records"))
    exploded = judged.select("seq", "topic", F.posexplode_outer(kept).alias("pos", "record"))
    return exploded.where(F.col("pos").isNotNull())
