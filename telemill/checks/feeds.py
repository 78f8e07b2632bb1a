"""Device messages derived from the ``events`` table, faults included."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fault of an object payload: the first rule whose number divides the event id.
FAULTS = (
    (101, "bad_json"),
    (103, "no_fields"),
    (107, "flat_fields"),
    (109, "scalar_root"),
    (113, "ts_missing"),
    (127, "ts_null"),
    (131, "id_missing"),
    (137, "route_missing"),
    (139, "bad_cell"),
    (149, "empty_list"),
)

# Fields of the widest record.
WIDE_FIELDS = 576

# Rows of a given table that one task makes messages of: a few bytes of a file that no reader splits
# become many of JSON, which the same task then parses.
ROWS_A_TASK, WIDE_ROWS_A_TASK = 20_000, 500

TOPIC_FILTERS = ("plant/#", "plant/error/+", "plant/+/0", "other/#")


def spread(rows: DataFrame, a_task: int = ROWS_A_TASK, *, by: tuple[Column, ...] = ()) -> DataFrame:
    """Rows of a given table dealt out evenly, or by a key, to more tasks the more they are."""
    return rows.repartition(max(1, -(-rows.count() // a_task)), *by)  # a file's footer has its count


def events(spark: SparkSession, folder: str, *by: Column) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/events.parquet"), by=by).withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


def _kind() -> Column:
    kind = F.lit("clean")
    for number, name in reversed(FAULTS):
        kind = F.when(F.col("event_id") % number == 0, name).otherwise(kind)
    return kind


def _text(value: str | Column) -> Column:
    return F.lit(value) if isinstance(value, str) else value.cast("string")


def _joined(*parts: str | Column) -> Column:
    return F.concat(*[_text(part) for part in parts])


def _second(ts: Column) -> Column:
    # By its text, which no session time zone can shift.
    return F.substring(ts.cast("string"), 1, 19)


def _member(name: str, value: Column, tag: str) -> Column:
    return _joined(f'"{name}":{{"value":', value, f',"type":"{tag}"}}')


def _string(value: Column) -> Column:
    return _joined('"', value, '"')


def _message_members() -> Column:
    return F.concat_ws(
        ",",
        _member("message", _string(_joined("err ", F.col("event_id"))), "str"),
        _member("level", F.col("event_id") % 5, "int"),
        _member("source", _string(F.lit("TCP")), "str"),
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def _record(*members: Column, fields: Column) -> Column:
    return _joined("{", F.concat_ws(",", *members, _joined('"fields":', fields)), "}")


def feed_obj(spark: SparkSession, folder: str) -> DataFrame:
    """One object payload per event, and the ``kind`` of its fault."""
    kind = F.col("kind")
    value = F.when(kind == "bad_cell", F.lit('"abc"')).otherwise(F.col("value").cast("string"))
    members = F.concat_ws(
        ",",
        _joined('"value":{"value":', value, ',"type":"float","unit":"mm"}'),
        _member("k", _k(), "int"),
        _member("props", F.col("props"), "json"),
        F.when(F.col("event_type") == "error", _message_members()),
    )
    fields = (
        F.when(kind == "no_fields", F.lit("{}"))
        .when(kind == "flat_fields", F.lit('{"value":5,"k":"x"}'))
        .otherwise(_joined("{", members, "}"))
    )
    # A member that is NULL is left out of the record.
    stamp = F.when(kind == "ts_null", F.lit('"timestamp":null')).when(
        kind != "ts_missing", _joined('"timestamp":"', _second(F.col("ts")), '"')
    )
    route = F.when(
        kind != "route_missing",
        _joined('"schema":"telemetry","table":"', F.col("event_type"), '"'),
    )
    device = F.when(kind != "id_missing", _joined('"deviceid":"dev-', F.col("user_id"), '"'))
    whole = _record(stamp, route, device, fields=fields)
    payload = (
        F.when(kind == "bad_json", F.expr("substring(whole, 1, length(whole) - 1)"))
        .when(kind == "scalar_root", F.lit("5"))
        .when(kind == "empty_list", F.lit("[]"))
        .otherwise(F.col("whole"))
    )
    topic = _joined("plant/", F.col("event_type"), "/", F.col("user_id") % 4)
    return (
        events(spark, folder)
        .withColumn("kind", _kind())
        .withColumn("whole", whole)
        .select(
            F.col("event_id").alias("seq"),
            topic.alias("topic"),
            payload.alias("payload"),
            F.col("ts").alias("recv_ts"),
            "kind",
        )
    )


def raw_obj(spark: SparkSession, folder: str) -> DataFrame:
    return feed_obj(spark, folder).drop("kind")


def raw_list(spark: SparkSession, folder: str) -> DataFrame:
    """One list payload per four consecutive events."""
    batch = F.floor(F.col("event_id") / 4)
    last = F.col("event_id") % 4 == 3
    lacks_k = (batch % 17 == 0) & last
    with_message = (batch % 17 != 0) & (batch % 10 == 0)
    members = F.concat_ws(
        ",",
        _joined('"value":{"value":', F.col("value"), ',"type":"float","unit":"mm"}'),
        F.when(~lacks_k, _member("k", _k(), "int")),
        F.when(with_message, _message_members()),
    )
    element = _record(
        _joined('"timestamp":"', _second(F.col("ts")), '"'),
        F.lit('"schema":"telemetry","table":"batch"'),
        _joined('"deviceid":"dev-', F.col("user_id"), '"'),
        fields=_joined("{", members, "}"),
    )
    # Dealt out by the key that they are gathered by, which no second shuffle then merges into few tasks.
    elements = events(spark, folder, batch).select(
        batch.alias("seq"), "ts", F.struct("event_id", element.alias("json")).alias("element")
    )
    # Four elements at most: the key is the event id divided by four.
    batches = elements.groupBy("seq").agg(
        F.array_sort(F.collect_list("element")).alias("elements"), F.min("ts").alias("recv_ts")
    )
    return batches.select(
        "seq",
        F.lit("plant/batch/0").alias("topic"),
        _joined("[", F.array_join("elements.json", ","), "]").alias("payload"),
        "recv_ts",
    )


def raw_moved(spark: SparkSession, folder: str, chunk: str) -> DataFrame:
    """One record per event, moved on by up to eleven months, or to the first two days for hours."""
    if chunk == "month":
        moved = F.col("ts") + F.make_ym_interval(F.lit(0), F.col("event_id") % 12)
    else:
        moved = F.col("ts") - F.make_dt_interval(F.dayofmonth("ts") - 1 - F.col("event_id") % 2)
    whole = _record(
        _joined('"timestamp":"', _second(moved), '"'),
        F.lit('"schema":"telemetry","table":"batch"'),
        _joined('"deviceid":"dev-', F.col("user_id"), '"'),
        fields=_joined("{", F.concat_ws(",", _member("value", F.col("value"), "float"), _member("k", _k(), "int")), "}"),
    )
    return events(spark, folder).select(
        F.col("event_id").alias("seq"), F.lit("plant/x/0").alias("topic"), whole.alias("payload"), F.col("ts").alias("recv_ts")
    )


# What is wrong with a delimited payload: the first rule whose number divides the batch.
DELIMITED_FAULTS = (
    (7, "empty_batch"), (11, "short_line"), (13, "bad_cell"), (17, "duplicate_column"), (19, "open_quote"), (23, "empty"),
)


def raw_delimited(spark: SparkSession, folder: str) -> DataFrame:
    """One payload of lines per four consecutive events, cells with separators and quotes in them."""
    batch, kind = F.floor(F.col("event_id") / 4), F.lit("clean")
    for number, name in reversed(DELIMITED_FAULTS):
        kind = F.when(batch % number == 0, name).otherwise(kind)
    last, first = F.col("event_id") % 4 == 3, F.col("event_id") % 4 == 0
    value = F.when((F.col("kind") == "bad_cell") & first, F.lit("abc")).otherwise(F.col("value").cast("string"))
    note = _joined('"say ""', F.col("event_type"), '"", twice"')
    cells = [
        _second(F.col("ts")), F.lit("telemetry"), F.lit("delimited"), _joined("dev-", F.col("user_id")), value,
        F.when(F.col("event_id") % 5 == 0, "").otherwise(_k()), _joined('"', F.replace("props", F.lit('"'), F.lit('""')), '"'),
        F.when((F.col("kind") == "open_quote") & last, F.lit('"open')).otherwise(note),
    ]
    whole = F.concat_ws(",", *cells)
    line = F.when((F.col("kind") == "short_line") & last, F.concat_ws(",", *cells[:-1])).otherwise(whole)
    lines = events(spark, folder, batch).withColumn("kind", kind).select(
        batch.alias("seq"), "kind", "ts", F.struct("event_id", line.alias("text")).alias("line")
    )
    # Four lines at most.
    batches = lines.groupBy("seq", "kind").agg(F.array_sort(F.collect_list("line")).alias("lines"), F.min("ts").alias("recv_ts"))
    k = F.when(F.col("kind") == "duplicate_column", "value:int").otherwise("k:int")
    header = _joined("timestamp,schema,table,deviceid,value:float,", k, ",props:json,note\n")
    payload = F.when(F.col("kind") == "empty", "").when(F.col("kind") == "empty_batch", header)
    return batches.select(
        "seq",
        F.lit("plant/delimited/0").alias("topic"),
        payload.otherwise(F.concat(header, F.array_join("lines.text", "\r\n"), F.lit("\n"))).alias("payload"),
        "recv_ts",
    )


def raw_evolving(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The events in three parts by time, each with more fields than the one before; the
    last one tags ``value`` as text."""
    source = events(spark, folder)
    cut = source.agg(F.min("event_id"), F.max("event_id")).first()
    third = (cut[1] - cut[0] + 1) // 3
    part = F.least(F.floor((F.col("event_id") - cut[0]) / third), F.lit(2))
    value_tag = F.when(part == 2, F.lit("str")).otherwise(F.lit("float"))
    members = F.concat_ws(
        ",",
        _joined('"value":{"value":', F.col("value"), ',"type":"', value_tag, '"}'),
        F.when(part >= 1, _member("k", _k(), "int")),
        F.when(part == 2, _member("props", F.col("props"), "json")),
    )
    whole = _record(
        _joined('"timestamp":"', _second(F.col("ts")), '"'),
        F.lit('"schema":"telemetry","table":"evolving"'),
        _joined('"deviceid":"dev-', F.col("user_id"), '"'),
        fields=_joined("{", members, "}"),
    )
    feed = source.select(
        F.col("event_id").alias("seq"),
        F.lit("plant/evolving/0").alias("topic"),
        whole.alias("payload"),
        F.col("ts").alias("recv_ts"),
        part.alias("part"),
    )
    return [feed.where(F.col("part") == number).drop("part") for number in range(3)]


MANY_COLUMNS = 2000


def raw_many(spark: SparkSession, folder: str) -> DataFrame:
    """One record per part with one field of many, that of its key's remainder."""
    key = F.col("p_partkey")
    field = _joined('"c', key % MANY_COLUMNS, '":{"value":', key, '.5,"type":"float"}')
    whole = _record(
        F.lit('"timestamp":"2024-01-01 00:00:00"'),
        F.lit('"schema":"telemetry","table":"many"'),
        _joined('"deviceid":"d', key, '"'),
        fields=_joined("{", field, "}"),
    )
    return spread(spark.read.parquet(f"{folder}/part.parquet").select("p_partkey")).select(
        key.cast("bigint").alias("seq"),
        F.lit("plant/many/0").alias("topic"),
        whole.alias("payload"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("recv_ts"),
    )


# Routes that cannot be stored, by the remainder of the event id.
BAD_ROUTES = {
    0: ("global_temp", "good"), 1: ("telemetry", "t" * 300), 2: ("quarantine", "rejects"), 3: ("telemetry", "plain"),
    4: ("telemetry", "τήλε"),
}

# Routes whose names are as long as a path takes, of which one record in so many has a bad cell.
# A schema's bytes are those left beside the prefix of ``fresh`` databases.
LONG_ROUTES = {
    5: ("telemetry", "t" * 244), 6: ("telemetry", "t" * 250), 7: ("telemetry", "t" * 255), 8: ("s" * 223, "good"),
    9: ("s" * 235, "t" * 255),
}
BAD_LONG_CELLS = 3


def raw_isolated(spark: SparkSession, folder: str) -> DataFrame:
    """One record per event, a few of them for tables that cannot take it."""
    kind = F.col("event_id") % 50
    route = F.lit('"schema":"telemetry","table":"good"')
    for number, (schema, table) in {**BAD_ROUTES, **LONG_ROUTES}.items():
        route = F.when(kind == number, f'"schema":"{schema}","table":"{table}"').otherwise(route)
    bad_cell = kind.isin(*LONG_ROUTES) & (F.floor(F.col("event_id") / 50) % BAD_LONG_CELLS == 0)
    value = F.when(bad_cell, F.lit('"abc"')).otherwise(F.col("value").cast("string"))
    whole = _record(
        _joined('"timestamp":"', _second(F.col("ts")), '"'),
        route,
        _joined('"deviceid":"dev-', F.col("user_id"), '"'),
        fields=_joined('{"value":{"value":', value, ',"type":"float"}}'),
    )
    return events(spark, folder).select(
        F.col("event_id").alias("seq"), F.lit("plant/x/0").alias("topic"), whole.alias("payload"), F.col("ts").alias("recv_ts")
    )


def raw_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """One record per part, on the first of January of every third year from 1830 on."""
    key = F.col("p_partkey")
    year = 1830 + 3 * (key % 100)
    whole = _record(
        _joined('"timestamp":"', year, '-01-01 00:00:00"'),
        F.lit('"schema":"telemetry","table":"sparse"'),
        _joined('"deviceid":"d', key % 100, '"'),
        fields=F.lit('{"value":{"value":1,"type":"int"}}'),
    )
    return spark.read.parquet(f"{folder}/part.parquet").select(
        key.cast("bigint").alias("seq"),
        F.lit("plant/sparse/0").alias("topic"),
        whole.alias("payload"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("recv_ts"),
    )


def raw_wide(spark: SparkSession, folder: str) -> DataFrame:
    """One record of 576 numeric fields per customer; field i is (customer key + i) / 4."""
    key = F.col("c_custkey")
    fields = F.transform(
        F.sequence(F.lit(1), F.lit(WIDE_FIELDS)),
        lambda i: _joined(
            '"c', i, '":{"name":"c', i, '","value":', (key + i) / 4, ',"type":"float","unit":"kg"}'
        ),
    )
    whole = _record(
        F.lit('"timestamp":"2024-01-01 00:00:00"'),
        F.lit('"schema":"telemetry","table":"wide"'),
        _joined('"deviceid":"d', key, '"'),
        fields=_joined("{", F.array_join(fields, ","), "}"),
    )
    return spread(spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey"), WIDE_ROWS_A_TASK).select(
        key.cast("bigint").alias("seq"),
        F.lit("plant/wide/0").alias("topic"),
        whole.alias("payload"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("recv_ts"),
    )
