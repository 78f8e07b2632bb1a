"""From checked payloads to outcomes.

A payload has one outcome for its data table and one for each of its messages. An outcome
is either refused, with a reason, or carries the rows for one table. Everything is
computed on the payload's own row: no shuffle, and a list of any length stays in its task.

Outcome columns: ``seq, topic, recv_ts, payload`` (which staged outcomes carry along, so
that what is refused later needs no second read of the input), ``target`` (data or message), ``pos`` (element a message comes from), ``reason,
violations, route_schema, route_table`` and ``rows``, an array of
``struct<pos, ts, id, cells>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from telemill.functions import cells, names, variants
from telemill.options import Options

DATA, MESSAGE = "data", "message"

# A calendar date first: narrower than a plain cast, which also takes ``2024``.
TIMESTAMP = r"^\s*\d{4,6}-\d{1,2}-\d{1,2}(\D|$)"

# Other spellings of a timestamp that begins with its date, and how to write them that way.
SPELLINGS = (
    (r"^\s*(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
    (r"^\s*(\d{4})(\d{2})(\d{2})(?=\D|$)", "$1-$2-$3"),
    (r"^(\S+[ T])(\d{2})(\d{2})(\d{2})(?=[.\s]|$)", "$1$2:$3:$4"),
)
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
NAMED_MONTH = r"^\s*([A-Za-z]{3})[a-z]*\.? +(\d{1,2}),? +(\d{4})(.*)$"


def iso_spelling(text: Column) -> Column:
    """A timestamp with slashes, without separators or with the month's name, as one with
    dashes; other text as it is."""
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(text, NAMED_MONTH, 1)))
    parts = [F.regexp_extract(text, NAMED_MONTH, i) for i in (3, 2, 4)]
    named = F.concat(parts[0], F.lit("-"), month.cast("string"), F.lit("-"), parts[1], parts[2])
    other = text
    for pattern, replacement in SPELLINGS:
        other = F.regexp_replace(other, pattern, replacement)
    return F.when(text.rlike(TIMESTAMP), text).when(text.rlike(NAMED_MONTH) & (month > 0), named).otherwise(other)


def timestamp_text(record: Column, options: Options) -> Column:
    return variants.text_or(record["timestamp"], options.default_timestamp)


def timestamp(text: Column) -> Column:
    """A timestamp of its text; the usual spelling is not looked at any further. Others are written
    out once, in an array: twice they made a method too long for the JVM to compile."""

    def parsed(other: Column) -> Column:
        return F.when(other.rlike(TIMESTAMP), other.try_cast("timestamp_ntz"))

    rewritten = F.get(F.transform(F.array(iso_spelling(text)), parsed), F.lit(0))
    return F.when(text.rlike(TIMESTAMP), text.try_cast("timestamp_ntz")).otherwise(rewritten)


def device(record: Column, options: Options) -> Column:
    return variants.text_or(record["deviceid"], options.default_device)


def numbered_records() -> Column:
    """``struct<record, pos>`` for each record of a payload."""
    return F.transform("records", lambda record, pos: F.struct(record.alias("record"), pos.alias("pos")))


def headed(items: Column, options: Options) -> Column:
    """Numbered records as ``struct<record, pos, ts_text, id, ts>``. Each step's result is an array
    that is there before the next one reads it, so a text is taken out once for all its uses."""

    def texts(item: Column) -> Column:
        record = item["record"]
        text, id_ = timestamp_text(record, options), device(record, options)
        return F.struct(record.alias("record"), item["pos"].alias("pos"), text.alias("ts_text"), id_.alias("id"))

    def parsed(item: Column) -> Column:
        kept = [item[name].alias(name) for name in ("record", "pos", "ts_text", "id")]
        return F.struct(*kept, timestamp(item["ts_text"]).alias("ts"))

    return F.transform(F.transform(items, texts), parsed)


def fixed_columns_fault(deviceid: Column, ts_text: Column, ts: Column, id_: Column) -> Column:
    """Reason to refuse the timestamp or device id read from a record, or NULL."""
    return (
        F.when(ts.isNull(), F.when(ts_text.isNull(), "null_timestamp").otherwise("bad_timestamp"))
        .when(id_.isNull(), "null_deviceid")
        # The type is looked at only where the text could be a list or an object.
        .when(id_.rlike(r"^[\[{]") & variants.is_nested(deviceid), "bad_deviceid")
    )


def route_name(value: Column, name: Column, default: str) -> Column:
    """Database or table name a record asks for, given its text in lower case; NULL if it cannot be
    one. Numbers and nested values are no identifiers as text, and the two truth values are no names."""
    usable = names.is_identifier(name) & ~name.isin("true", "false")
    return F.when(value.isNull(), F.lit(default)).when(usable, name)


# Databases of the engine itself; they are refused whatever the prefix.
SYSTEM_SCHEMAS = ("global_temp", "system", "information_schema", "session", "builtin")
# Bytes of a name in a path: a database's folder has a suffix.
PATH_BYTES, SUFFIX_BYTES = 255, len(".db")


def schema_name(name: Column, options: Options) -> Column:
    """Schema a record asks for; NULL for one that cannot be made or is not for payloads."""
    full = F.concat(F.lit(options.database_prefix), name)
    reserved = (*SYSTEM_SCHEMAS, options.quarantine_schema.lower())
    return F.when((F.octet_length(full) <= PATH_BYTES - SUFFIX_BYTES) & ~name.isin(*reserved), name)


def table_name(name: Column) -> Column:
    return F.when(F.octet_length(name) <= PATH_BYTES, name)


def with_header(judged: DataFrame, options: Options) -> DataFrame:
    """Adds route, timestamp and device of the payload, all from its first record, and its field
    names; with a header per record also the ``heads``. What is read several times is a column of
    its own first."""
    first = F.get("records", F.lit(0))
    texts = judged.withColumns(
        {
            "_schema": F.lower(variants.text(first["schema"])),
            "_table": F.lower(variants.text(first["table"])),
            "header_text": timestamp_text(first, options),
            "header_id": device(first, options),
            "columns": folded_names(first),
        }
    )
    if options.header == "record":
        texts = texts.withColumn("heads", headed(numbered_records(), options))
    asked = texts.withColumns(
        {
            "_schema": route_name(first["schema"], F.col("_schema"), options.default_schema),
            "_table": route_name(first["table"], F.col("_table"), options.default_table),
        }
    )
    return asked.withColumns(
        {
            "route_schema": schema_name(F.col("_schema"), options),
            "route_table": table_name(F.col("_table")),
            "header_ts": timestamp(F.col("header_text")),
        }
    )


def folded_names(record: Column) -> Column:
    """Field names in lower case. Where all of them are, which one text of them tells, they are left alone."""
    keys = F.map_keys(record["fields"])
    text = F.array_join(keys, ",")
    return F.when(F.lower(text) == text, keys).otherwise(F.transform(keys, F.lower))


def no_identifiers(columns: Column) -> Column:
    """Whether a name is no identifier. Two texts of all names tell where each surely is one."""
    sure = ~F.array_join(columns, "").rlike(names.NO_WORD) & ~F.array_join(columns, ",").rlike(names.NO_BEGINNING)
    return F.when(sure, False).otherwise(F.exists(columns, lambda name: ~names.is_identifier(name)))


def repeated(columns: Column, keys: Column) -> Column:
    """Whether names are the same in lower case. The keys of a map are not the same before."""
    return F.when(columns == keys, False).otherwise(F.size(F.array_distinct(columns)) < F.size(columns))


def field_sets_equal(records: Column) -> Column:
    """Whether all elements of a list have the fields of the first one."""

    def sorted_names(record: Column) -> Column:
        return F.array_sort(folded_names(record))

    def same(first: Column) -> Column:
        return F.forall(records, lambda record: sorted_names(record) == first)

    first_names = F.array(sorted_names(F.get(records, F.lit(0))))
    return (F.size(records) == 1) | F.get(F.transform(first_names, same), F.lit(0))


def _data_fault(options: Options) -> Column:
    """Reason to refuse the rows of a sound payload for its data table, or NULL."""
    records = F.col("records")
    first = F.get(records, F.lit(0))
    columns = F.col("columns")
    fault = (
        F.when(F.col("route_schema").isNull() | F.col("route_table").isNull(), "bad_route")
        .when(~field_sets_equal(records), "field_set_mismatch")
        .when(no_identifiers(columns), "bad_column")
        .when(
            repeated(columns, F.map_keys(first["fields"]))
            | F.arrays_overlap(columns, F.array(*map(F.lit, options.reserved_columns))),
            "duplicate_column",
        )
    )
    if options.header == "record":
        faults = F.transform("heads", _own_fault)
        fixed = F.get(F.array_compact(faults), F.lit(0))
    else:
        fixed = fixed_columns_fault(first["deviceid"], F.col("header_text"), F.col("header_ts"), F.col("header_id"))
    return F.coalesce(fault, fixed)


def _own_fault(head: Column) -> Column:
    return fixed_columns_fault(head["record"]["deviceid"], head["ts_text"], head["ts"], head["id"])


def _data_rows(options: Options) -> Column:
    def row(record: Column, pos: Column, ts: Column, id_: Column) -> Column:
        digests = cells.digests(record["fields"], folded_names(record))
        return F.struct(pos.alias("pos"), ts.alias("ts"), id_.alias("id"), digests.alias("cells"))

    if options.header == "record":
        return F.transform("heads", lambda head: row(head["record"], head["pos"], head["ts"], head["id"]))
    return F.transform("records", lambda record, pos: row(record, pos, F.col("header_ts"), F.col("header_id")))


def _message_outcomes(options: Options) -> Column:
    """One outcome per record that carries a message, with the record's own timestamp and
    device and the listed fields it has."""

    def outcome(head: Column) -> Column:
        record, pos = head["record"], head["pos"]
        listed = F.filter(
            F.map_entries(record["fields"]), lambda entry: entry["key"].isin(*options.message_columns)
        )
        row = F.struct(
            pos.alias("pos"),
            head["ts"].alias("ts"),
            head["id"].alias("id"),
            F.transform(listed, lambda entry: cells.digest(entry, missing="")).alias("cells"),
        )
        return _outcome(
            target=F.lit(MESSAGE),
            pos=pos,
            reason=_own_fault(head),
            route_schema=F.lit(options.message_schema),
            route_table=F.lit(options.message_table),
            rows=F.array(row),
        )

    with_message = F.filter(
        numbered_records(),
        lambda item: F.map_contains_key(item["record"]["fields"], options.message_key),
    )
    if options.message_keep == "last":
        with_message = F.slice(F.reverse(with_message), 1, 1)
    return F.transform(headed(with_message, options), outcome)


def _outcome(
    target: Column,
    pos: Column,
    reason: Column,
    route_schema: Column,
    route_table: Column,
    rows: Column,
) -> Column:
    # A uniform type, so that the outcomes of a payload can stand in one array.
    return F.struct(
        target.alias("target"),
        pos.cast("int").alias("pos"),
        reason.cast("string").alias("reason"),
        route_schema.cast("string").alias("route_schema"),
        route_table.cast("string").alias("route_table"),
        rows.alias("rows"),
    )


def outcomes(judged: DataFrame, options: Options) -> DataFrame:
    """All outcomes of judged payloads."""
    sound = F.col("reason").isNull()
    with_fault = with_header(judged, options).withColumn(
        "data_reason", F.when(sound, _data_fault(options)).otherwise(F.col("reason"))
    )
    data = _outcome(
        target=F.lit(DATA),
        pos=F.lit(None),
        reason=F.col("data_reason"),
        route_schema=F.col("route_schema"),
        route_table=F.col("route_table"),
        rows=F.when(F.col("data_reason").isNull(), _data_rows(options)),
    )
    every = F.array(data)
    if options.message_switch:
        messages = F.when(sound, _message_outcomes(options))
        every = F.flatten(F.array_compact(F.array(every, messages)))
    # The outer form keeps the optimizer from adding a size filter on the array, which it
    # would push down as a second evaluation of the whole parse. The array is never empty.
    exploded = with_fault.select(
        "seq", "topic", "recv_ts", "payload", "violations", F.explode_outer(every).alias("outcome")
    )
    return exploded.select(
        "seq",
        "topic",
        "recv_ts",
        "payload",
        "outcome.target",
        "outcome.pos",
        "outcome.reason",
        "violations",
        "outcome.route_schema",
        "outcome.route_table",
        "outcome.rows",
    )
