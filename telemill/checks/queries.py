"""Queries over the given tables, one per operation of the library.

Each takes the session and the folder of the tables. Messages are derived from ``events``
(see feeds); what a query writes goes below the shared scratch folder.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from telemill.checks import feeds
from telemill.functions import cells as cell_rules
from telemill.operators import coerce, flatten, reads
from telemill.operators.decode import STRUCTURE_REASONS, decode, elements, judge
from telemill.operators.dictionary import ROUTE, column_dictionary, route_columns
from telemill.options import Options
from telemill.plans.load import LoadError, LoadReport, load, stage, unpark
from telemill.plans.parse import parse, parse_telemetry, register_parser
from telemill.session import scratch_dir
from telemill.sinks import days, parked, plain, quarantine, tables
from telemill.sinks.compact import compact
from telemill.sinks.publish import publish, write_messages
from telemill.sources.raw import read_raw, stream_raw
from telemill.sources.series import series
from telemill.sources.topics import fan_out, subscribe
from telemill.streaming.ingest import start_ingest

# Tables the object feed is routed to.
FEED_ROUTES = (
    ("telemetry", "click"),
    ("telemetry", "error"),
    ("telemetry", "purchase"),
    ("telemetry", "signup"),
    ("telemetry", "view"),
    ("public", "example"),
)

MESSAGES = ("public", "message")

MESSAGE_STORAGE = {
    "message": cell_rules.STRING,
    "level": cell_rules.DOUBLE,
    "source": cell_rules.STRING,
    "logpath": cell_rules.STRING,
}

LANDING_FILES = 4

# Lines of a text file that one task sorts and writes.
LINES_A_FILE = 250_000

# Times that tables by hours and by months are read for.
RANGES = {
    "hour": (datetime.datetime(2024, 1, 1, 22, 30), datetime.datetime(2024, 1, 2, 3, 0)),
    "month": (datetime.datetime(2024, 5, 10), datetime.datetime(2024, 6, 5, 12, 30)),
}


def fresh(spark: SparkSession, purpose: str) -> Options:
    """Options for databases of their own."""
    return Options(
        database_prefix=f"tm_{uuid.uuid4().hex[:12]}_", warehouse=scratch_dir(spark, purpose)
    )


_loaded: dict[tuple[str, str], tuple[Options, LoadReport]] = {}


def loaded_feed(spark: SparkSession, folder: str) -> tuple[Options, LoadReport]:
    """The object feed as tables; loaded once per application for the queries that read."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _loaded:
        options = fresh(spark, "feed")
        _loaded[key] = options, load(feeds.raw_obj(spark, folder), "feed", options)
    return _loaded[key]


def judged_obj(spark: SparkSession, folder: str) -> DataFrame:
    return judge(decode(feeds.raw_obj(spark, folder)))


def parsed_obj(spark: SparkSession, folder: str) -> DataFrame:
    return parse(feeds.raw_obj(spark, folder))


def parsed_list(spark: SparkSession, folder: str, options: Options | None = None) -> DataFrame:
    return parse(feeds.raw_list(spark, folder), options)


def by_table(outcomes: DataFrame) -> Iterator[tuple[DataFrame, dict[str, str]]]:
    """The outcomes for each of the feed's tables, with the types of its columns."""
    staged = stage(outcomes, scratch_dir(outcomes.sparkSession, "outcomes"))
    for row in route_columns(column_dictionary(staged)).toLocalIterator():
        mine = staged.where((F.col("route_schema") == row.route_schema) & (F.col("route_table") == row.route_table))
        yield mine, {entry.column: entry.storage for entry in row.columns}


def land(spark: SparkSession, raw: DataFrame, purpose: str) -> str:
    path = scratch_dir(spark, purpose)
    raw.repartition(LANDING_FILES).write.parquet(path)
    return path


# Sources


def raw_stream_scan(spark: SparkSession, folder: str) -> DataFrame:
    landing = land(spark, feeds.raw_obj(spark, folder), "landing")
    out = scratch_dir(spark, "scanned")
    (
        stream_raw(spark, landing)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_dir(spark, "progress"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return read_raw(spark, out)


def topic_filter(spark: SparkSession, folder: str) -> DataFrame:
    return subscribe(feeds.raw_obj(spark, folder), ["plant/error/+", "plant/+/0"]).select("seq", "topic")


def topic_fanout(spark: SparkSession, folder: str) -> DataFrame:
    return fan_out(feeds.raw_obj(spark, folder), list(feeds.TOPIC_FILTERS)).select("seq", "subscription")


def table_scan(spark: SparkSession, folder: str) -> DataFrame:
    options, _ = loaded_feed(spark, folder)
    return reads.scan(spark, "telemetry", "click", options)


def series_insert(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "series")
    statements = feeds.events(spark, folder).select("event_id")
    rows = series(statements, 10, F.col("event_id") * 10 + F.col("n"))
    tables.ensure_schema(spark, "public", options)
    name = tables.table_name("public", "series", options)
    spark.sql(f"CREATE TABLE {name} (id BIGINT, crt_time TIMESTAMP_NTZ) USING parquet")
    spark.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {{rows}}", rows=rows)
    return spark.table(name).select("id", F.col("crt_time").isNotNull().alias("timed"))


# Decode and check


def decode_json(spark: SparkSession, folder: str) -> DataFrame:
    decoded = decode(feeds.raw_obj(spark, folder))
    return decoded.select("seq", F.col("root").isNotNull().alias("valid"))


def payload_shape(spark: SparkSession, folder: str) -> DataFrame:
    return judged_obj(spark, folder).select("seq", "root")


def structure_violations(spark: SparkSession, folder: str) -> DataFrame:
    return judged_obj(spark, folder).select("seq", "violations")


def accepted_payloads(spark: SparkSession, folder: str) -> DataFrame:
    data = parsed_obj(spark, folder).where(F.col("target") == "data")
    sound = F.col("reason").isNull() | ~F.col("reason").isin(*STRUCTURE_REASONS)
    return data.where(sound).select("seq")


def rejected_payloads(spark: SparkSession, folder: str) -> DataFrame:
    options, _ = loaded_feed(spark, folder)
    kept = quarantine.read(spark, options).where(F.col("target") == "data")
    return kept.select("seq", "reason", "violations", "payload")


# Rows and cells


def batch_explode(spark: SparkSession, folder: str) -> DataFrame:
    return elements(judge(decode(feeds.raw_list(spark, folder)))).select(
        "seq", "pos", F.try_variant_get("record.deviceid", "$", "string").alias("deviceid")
    )


def batch_header(spark: SparkSession, folder: str) -> DataFrame:
    rows = flatten.rows(flatten.accepted(parsed_list(spark, folder), "data"))
    return rows.select("seq", "pos", F.col("ts").alias("timestamp"), F.col("id").alias("deviceid"))


def fixed_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = flatten.rows(flatten.accepted(parsed_obj(spark, folder), "data"))
    return rows.select("seq", F.col("ts").alias("timestamp"), F.col("id").alias("deviceid"))


def route(spark: SparkSession, folder: str) -> DataFrame:
    return flatten.accepted(parsed_obj(spark, folder), "data").select("seq", *ROUTE)


def flatten_long(spark: SparkSession, folder: str) -> DataFrame:
    cells = flatten.cells(flatten.rows(flatten.accepted(parsed_obj(spark, folder), "data")))
    return cells.select("seq", "column", "tag", "text")


def flatten_wide(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        flatten.wide(flatten.rows(outcomes), columns, Options(), "seq", "route_table")
        for outcomes, columns in by_table(flatten.accepted(parsed_obj(spark, folder), "data"))
    ]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def wide_record(spark: SparkSession, folder: str) -> DataFrame:
    rows = flatten.rows(flatten.accepted(parse(feeds.raw_wide(spark, folder)), "data"))
    names = [f"c{number}" for number in range(1, feeds.WIDE_FIELDS + 1)]
    wide = flatten.wide(rows, dict.fromkeys(names, cell_rules.DOUBLE), Options(), "seq", checked=True)
    cells = wide.select("seq", "deviceid", F.posexplode(F.array(*names)).alias("position", "value"))
    return cells.select("seq", "deviceid", F.element_at(F.array(*map(F.lit, names)), F.col("position") + 1).alias("name"), "value")


def batch_alignment(spark: SparkSession, folder: str) -> DataFrame:
    data = parsed_list(spark, folder).where(F.col("target") == "data")
    return data.select("seq", F.col("reason").isNull().alias("aligned"))


def type_mapping(spark: SparkSession, folder: str) -> DataFrame:
    cells = flatten.cells(flatten.rows(flatten.accepted(parsed_obj(spark, folder), "data")))
    mapped = cells.withColumn("storage", cell_rules.storage(F.col("tag")))
    return mapped.groupBy("column", "tag", "storage").agg(F.count("*").alias("cells"))


def json_cell(spark: SparkSession, folder: str) -> DataFrame:
    return flatten_long(spark, folder).where(F.col("tag") == "json").select("seq", "text")


def cell_coercion(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = flatten.accepted(parsed_obj(spark, folder), "data")
    return reduce(DataFrame.unionByName, [coerce.table_cells(*one) for one in by_table(outcomes)])


def message_fork(spark: SparkSession, folder: str) -> DataFrame:
    rows = flatten.rows(flatten.accepted(parsed_obj(spark, folder), "message"))
    return flatten.wide(rows, MESSAGE_STORAGE, Options(), "seq")


def message_last_in_batch(spark: SparkSession, folder: str) -> DataFrame:
    options = Options(message_keep="last")
    rows = flatten.rows(flatten.accepted(parsed_list(spark, folder, options), "message"))
    return flatten.wide(rows, MESSAGE_STORAGE, options, "seq", "pos")


def not_null_gate(spark: SparkSession, folder: str) -> DataFrame:
    data = parsed_obj(spark, folder).where(F.col("target") == "data")
    fixed = F.col("reason").isin("null_timestamp", "bad_timestamp", "null_deviceid", "bad_deviceid")
    return data.where(F.col("reason").isNull() | fixed).select(
        "seq", F.col("reason").isNull().alias("passed")
    )


# Tables


def ensure_schema(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "schemas")
    accepted = flatten.accepted(parsed_obj(spark, folder))
    for row in accepted.select("route_schema").distinct().toLocalIterator():
        tables.ensure_schema(spark, row.route_schema, options)
        tables.ensure_schema(spark, row.route_schema, options)
    prefix = options.database_prefix
    return (
        spark.sql(f"SHOW DATABASES LIKE '{prefix}*'")
        .select(F.expr(f"substring(namespace, {len(prefix) + 1})").alias("schema_name"))
    )


def plain_table_with_id(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "plain")
    source = feeds.events(spark, folder)
    half = source.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    tables.ensure_schema(spark, "public", options)
    columns = {"event_id": cell_rules.DOUBLE, "user_id": cell_rules.DOUBLE, "event_type": cell_rules.STRING, "value": cell_rules.DOUBLE, "props": cell_rules.JSON}
    tables.create_plain_table(spark, "public", "plain", columns, options)
    rows = source.select(*[F.col(name).cast(tables.SPARK_TYPES[storage]).alias(name) for name, storage in columns.items()])
    first, second = rows.where(F.col("event_id") <= half), rows.where(F.col("event_id") > half)
    for batch, part in (("first", first), ("second", second), ("second", second)):
        plain.append_plain(part, "public", "plain", ["event_id"], batch, options)
    return spark.table(tables.table_name("public", "plain", options)).drop(options.batch_column)


def interleaved_appends(spark: SparkSession, folder: str) -> DataFrame:
    """Appends to one plain table at the same time, one of them repeated: whether each has its own
    keys, without a gap, in its order, and all together every key once."""
    options = fresh(spark, "interleaved")
    tables.ensure_schema(spark, "public", options)
    tables.create_plain_table(spark, "public", "plain", {"event_id": cell_rules.DOUBLE}, options)
    events = feeds.events(spark, folder).select(F.col("event_id").cast("double").alias("event_id"))

    def append(number: int) -> None:
        part = events.where(F.col("event_id") % 4 == number % 4)
        plain.append_plain(part, "public", "plain", ["event_id"], f"part-{number % 4}", options)

    with ThreadPoolExecutor(5) as pool:
        list(pool.map(append, [0, 1, 2, 3]))
    append(4)
    rows = spark.table(tables.table_name("public", "plain", options))
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy(options.batch_column).orderBy("event_id")))
    ends = rows.groupBy(options.batch_column).agg(F.min("id").alias("first"))
    kept = placed.join(ends, options.batch_column).withColumn("in_order", F.col("id") == F.col("first") + F.col("place") - 1)
    each = kept.groupBy(F.col(options.batch_column).alias("append")).agg(
        F.count("*").alias("rows"), F.count_distinct("id").alias("keys"), F.min("in_order").alias("in_order")
    )
    total = rows.agg(
        F.lit("all").alias("append"), F.count("*").alias("rows"), F.count_distinct("id").alias("keys"),
        ((F.min("id") == 1) & (F.max("id") == F.count("*"))).alias("in_order"),
    )
    return each.union(total)


def time_partitioned_table(spark: SparkSession, folder: str) -> DataFrame:
    options, _ = loaded_feed(spark, folder)
    dated = [
        spark.table(tables.table_name(*one, options)).select(F.lit(one[1]).alias("table_name"), "ts_date")
        for one in (*FEED_ROUTES, MESSAGES)
    ]
    return reduce(DataFrame.unionByName, dated).groupBy("table_name", "ts_date").agg(F.count("*").alias("rows"))


def time_range(spark: SparkSession, folder: str) -> DataFrame:
    options, _ = loaded_feed(spark, folder)
    start, end = datetime.datetime(2024, 1, 10, 6), datetime.datetime(2024, 1, 12, 18)
    return reads.time_range(spark, "telemetry", "view", start, end, options)


def _evolve(spark: SparkSession, folder: str) -> Options:
    options = fresh(spark, "evolving")
    for number, raw in enumerate(feeds.raw_evolving(spark, folder)):
        load(raw, f"part-{number}", options)
    return options


def schema_evolution(spark: SparkSession, folder: str) -> DataFrame:
    return reads.scan(spark, "telemetry", "evolving", _evolve(spark, folder))


def ensure_then_append(spark: SparkSession, folder: str) -> DataFrame:
    options = _evolve(spark, folder)
    table = spark.table(tables.table_name("telemetry", "evolving", options))
    return table.select("timestamp", "deviceid", "value", "k", "props", "ts_date", "ingest_batch")


def many_columns(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "many")
    load(feeds.raw_many(spark, folder), "many", options)
    table = reads.scan(spark, "telemetry", "many", options)
    names = [name for name in table.columns if name not in ("timestamp", "deviceid")]
    filled = F.concat_ws(",", *[F.when(F.col(x).isNotNull(), F.lit(x)) for x in names])
    return table.select("deviceid", filled.alias("filled"), F.coalesce(*names).alias("value"))


def dictionary_rows(spark: SparkSession, folder: str) -> DataFrame:
    found = column_dictionary(parsed_obj(spark, folder))
    seq = F.floor(F.col("first_seen") / 2**31).cast("bigint").alias("first_seq")
    return found.select(*ROUTE, "column", "storage", seq)


def append_batch(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "lists")
    load(feeds.raw_list(spark, folder), "lists", options, staging=scratch_dir(spark, "staging"))
    return reads.scan(spark, "telemetry", "batch", options)


def _all_tables(spark: SparkSession, options: Options, routes: tuple = (*FEED_ROUTES, MESSAGES)) -> DataFrame:
    parts = [reads.scan(spark, *one, options).withColumn("table_name", F.lit(one[1])) for one in routes]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def routed_append(spark: SparkSession, folder: str) -> DataFrame:
    options, _ = loaded_feed(spark, folder)
    return _all_tables(spark, options)


# Reads


def latest_n(spark: SparkSession, folder: str) -> DataFrame:
    options, _ = loaded_feed(spark, folder)
    return reads.latest(
        spark, "telemetry", "error", order=["timestamp", "message"], limit=5, options=options
    )


def projection_list(spark: SparkSession, folder: str) -> DataFrame:
    options, _ = loaded_feed(spark, folder)
    return reads.latest(
        spark,
        "telemetry",
        "error",
        "timestamp, deviceid, message",
        order=["message"],
        limit=20,
        expressions=[(F.col("value") * 2).alias("doubled")],
        options=options,
    )


def latest_n_missing(spark: SparkSession, folder: str) -> DataFrame:
    options, _ = loaded_feed(spark, folder)

    def rows(case: str, table: str, order: str) -> DataFrame:
        found = reads.latest(spark, "telemetry", table, order=[order, "message"], options=options)
        if found.isEmpty():
            nothing = spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("timestamp"))
            found = nothing.withColumn("message", F.lit(None).cast("string"))
        return found.select(F.lit(case).alias("case_name"), "timestamp", "message")

    return (
        rows("present", "error", "timestamp")
        .unionByName(rows("no_table", "nowhere", "timestamp"))
        .unionByName(rows("no_column", "error", "id"))
    )


# Sinks and streams


def publish_fanout(spark: SparkSession, folder: str) -> DataFrame:
    rows = feeds.events(spark, folder).select("event_id", "user_id", "event_type")
    return publish(rows, ["topic/x", "topic/y"])


def stream_admission(spark: SparkSession, folder: str) -> DataFrame:
    landing = land(spark, feeds.raw_obj(spark, folder), "landing")
    out = scratch_dir(spark, "admitted")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.select("seq", F.lit(batch_id).alias("batch")).write.mode("overwrite").parquet(
            f"{out}/batch_id={batch_id}"
        )

    (
        stream_raw(spark, landing, max_files_per_trigger=1)
        .writeStream.foreachBatch(keep)
        .option("checkpointLocation", scratch_dir(spark, "progress"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    admitted = spark.read.schema("seq BIGINT, batch INT").parquet(f"{out}/batch_id=*")
    batches = admitted.select("batch").distinct().count()
    return admitted.select("seq", F.lit(batches).alias("batches"))


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "streamed")
    landing = land(spark, feeds.raw_obj(spark, folder), "landing")
    raw = stream_raw(spark, landing, max_files_per_trigger=LANDING_FILES // 2)
    start_ingest(raw, "feed", scratch_dir(spark, "progress"), options).awaitTermination()
    return _all_tables(spark, options)


def replay_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "replayed")
    raw = feeds.raw_list(spark, folder)
    load(raw, "again", options)
    load(raw, "again", options)
    return _all_tables(spark, options, (("telemetry", "batch"), MESSAGES))


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    raw = feeds.raw_obj(spark, folder)
    ends = raw.agg(F.min("seq"), F.max("seq")).first()
    middle = (ends[0] + ends[1]) // 2
    return raw.where(F.col("seq") <= middle), raw.where(F.col("seq") > middle)


def replay_changed(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "changed")
    for raw in _halves(spark, folder):
        load(raw, "again", options)
    kept = quarantine.read(spark, options).select(F.lit("rejects").alias("table_name"), "seq", "target", "reason")
    return _all_tables(spark, options).unionByName(kept, allowMissingColumns=True)


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "restarted")
    for half in _halves(spark, folder):
        landing = land(spark, half, "landing")
        start_ingest(stream_raw(spark, landing), "feed", scratch_dir(spark, "progress"), options).awaitTermination()
    return _all_tables(spark, options)


def isolated_routes(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "isolated")
    tables.ensure_schema(spark, "telemetry", options)
    tables.create_plain_table(spark, "telemetry", "plain", {"value": cell_rules.DOUBLE}, options)
    load(feeds.raw_isolated(spark, folder), "one", options)
    routes = [("telemetry", "good"), *feeds.LONG_ROUTES.values()]
    stored = [
        reads.scan(spark, *one, options).select(F.lit(".".join(one)).alias("outcome"), "deviceid", "value") for one in routes
    ]
    refused = quarantine.read(spark, options).select(F.col("reason").alias("outcome"), "seq")
    return reduce(DataFrame.unionByName, stored).unionByName(refused, allowMissingColumns=True)


def _with_odd_table(spark: SparkSession, purpose: str) -> Options:
    """A table for clicks exists whose values are whole numbers; loads do not make such ones."""
    options = fresh(spark, purpose)
    tables.ensure_schema(spark, "telemetry", options)
    name = tables.table_name("telemetry", "click", options)
    spark.sql(
        f"CREATE TABLE {name} (timestamp TIMESTAMP_NTZ, deviceid STRING, value INT, ts_date DATE, ingest_batch STRING) "
        "USING parquet PARTITIONED BY (ts_date, ingest_batch)"
    )
    return options


def _unparked(spark: SparkSession, options: Options) -> DataFrame:
    """What is parked, and all tables once the odd one has made way and its rows are loaded."""
    waiting = parked.waiting(spark, options).groupBy(F.concat(F.lit("parked "), "route_table").alias("table_name"))
    waiting = waiting.agg(F.sum("outcomes").cast("double").alias("value"), F.sum("rows").cast("double").alias("k"))
    before = staged_rows(waiting, "waiting")
    spark.sql(f"DROP TABLE {tables.table_name('telemetry', 'click', options)}")
    unpark(spark, "telemetry", "click", options)
    left = parked.waiting(spark, options).agg(F.lit("left").alias("table_name"), F.count("*").cast("double").alias("value"))
    return _all_tables(spark, options).unionByName(before, allowMissingColumns=True).unionByName(left, allowMissingColumns=True)


def staged_rows(rows: DataFrame, purpose: str) -> DataFrame:
    path = scratch_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def parked_tables(spark: SparkSession, folder: str) -> DataFrame:
    options = _with_odd_table(spark, "parked")
    load(feeds.raw_obj(spark, folder), "feed", options)
    return _unparked(spark, options)


def parked_stream(spark: SparkSession, folder: str) -> DataFrame:
    options = _with_odd_table(spark, "parked")
    landing = land(spark, feeds.raw_obj(spark, folder), "landing")
    raw = stream_raw(spark, landing, max_files_per_trigger=LANDING_FILES // 2)
    start_ingest(raw, "feed", scratch_dir(spark, "progress"), options).awaitTermination()
    return _unparked(spark, options)


def committed_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table before and after the repeat of a load that broke off between two tables."""
    options = replace(fresh(spark, "committed"), park_failures=False, parallel_routes=1)
    first, second = _halves(spark, folder)
    load(first, "first", options)
    odd = tables.table_name("public", "message", options)
    kept = f"{odd[:-1]}_kept`"
    spark.sql(f"ALTER TABLE {odd} RENAME TO {kept}")
    spark.sql(f"CREATE TABLE {odd} (timestamp TIMESTAMP_NTZ, deviceid STRING, level INT, ts_date DATE, ingest_batch STRING) USING parquet PARTITIONED BY (ts_date, ingest_batch)")
    with suppress(LoadError):
        load(second, "second", options)
    spark.sql(f"DROP TABLE {odd}")
    spark.sql(f"ALTER TABLE {kept} RENAME TO {odd}")

    def rows(when: str) -> DataFrame:
        found = _all_tables(spark, options).groupBy("table_name").agg(F.count("*").alias("rows"), F.sum("value").alias("total"))
        newest = reads.latest(spark, "telemetry", "view", order=["timestamp", "value"], limit=3, options=options)
        found = found.unionByName(newest.select(F.lit("newest view").alias("table_name"), F.lit(1).cast("bigint").alias("rows"), F.col("value").alias("total")))
        return staged_rows(found.select(F.lit(when).alias("state"), "*"), "counted")

    broken = rows("broken off")
    load(second, "second", options)
    return broken.unionByName(rows("repeated"))


def compacted(spark: SparkSession, folder: str) -> DataFrame:
    options = fresh(spark, "compacted")
    for number in range(3):
        load(feeds.raw_obj(spark, folder).where(F.col("seq") % 3 == number), f"part-{number}", options)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda route: compact(spark, *route, ["part-0", "part-1"], options), (*FEED_ROUTES, MESSAGES)))
    parts = [
        spark.table(tables.table_name(*one, options)).withColumn("table_name", F.lit(one[1])) for one in (*FEED_ROUTES, MESSAGES)
    ]
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    merged = F.when(F.col("ingest_batch") == "part-2", "part-2").otherwise(F.substring("ingest_batch", 1, 7))
    return rows.withColumn("ingest_batch", merged)


def ledger_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Notes and refusals after two merges, the second of the first's result and one more load, and
    a repeat of a load that was left out and of one that was not."""
    options = fresh(spark, "merged")
    raw = feeds.raw_obj(spark, folder)

    def part(number: int) -> None:
        load(raw.where(F.col("seq") % 4 == number), f"part-{number}", options)

    for number in range(4):
        part(number)
    merged = quarantine.merge_notes(spark, ["part-0", "part-1"], options)
    quarantine.merge_notes(spark, [merged, "part-2"], options)
    part(3)
    repeated = "stored"
    with suppress(ValueError):
        part(0)
        repeated = "stored twice"
    refused, noted = quarantine.read(spark, options), quarantine.ledger(spark, options)
    folders = [
        rows.agg(F.lit(f"{name} folders").alias("entry"), F.count_distinct("ingest_batch").alias("seq"))
        for name, rows in (("refused", refused), ("noted", noted))
    ]
    closed = F.when(F.col("merged").isNull(), "open").otherwise("closed")
    parts = [
        refused.select(F.lit("refused").alias("entry"), "load", "seq", F.col("target").alias("name"), F.col("reason").alias("state")),
        noted.where("route_table IS NOT NULL").select(F.lit("noted").alias("entry"), "load", F.col("route_table").alias("name"), closed.alias("state")),
        *folders,
        spark.range(1).select(F.lit("repeated").alias("entry"), F.lit("part-0").alias("load"), F.lit(repeated).alias("state")),
    ]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _chunked(spark: SparkSession, folder: str, chunk: str) -> Options:
    """A feed as two loads that were merged and one that was not, one repeated with other rows."""
    key = (spark.sparkContext.applicationId, folder, chunk)
    if key in _chunks:
        return _chunks[key]
    options = replace(fresh(spark, chunk), chunk=chunk, header="record")
    raw = feeds.raw_moved(spark, folder, chunk)
    load(raw.where("seq % 3 < 2"), "first", options)
    for number, name in enumerate(("first", "second", "third")):
        load(raw.where(F.col("seq") % 3 == number), name, options)
    compact(spark, "telemetry", "batch", ["first", "second"], options)
    _chunks[key] = options
    return options


_chunks: dict[tuple[str, str, str], Options] = {}


def _partitions(spark: SparkSession, folder: str, chunk: str) -> DataFrame:
    table = spark.table(tables.table_name("telemetry", "batch", _chunked(spark, folder, chunk)))
    merged = F.when(F.col("ingest_batch") == "third", "third").otherwise(F.substring("ingest_batch", 1, 7))
    hours = [F.hour("timestamp").alias("hour"), "ts_hour"] if chunk == "hour" else []
    return table.select("timestamp", "deviceid", "value", "k", "ts_date", *hours, merged.alias("ingest_batch"))


def hourly_table(spark: SparkSession, folder: str) -> DataFrame:
    return _partitions(spark, folder, "hour")


def monthly_table(spark: SparkSession, folder: str) -> DataFrame:
    return _partitions(spark, folder, "month")


def _read_back(spark: SparkSession, folder: str, chunk: str) -> DataFrame:
    """The newest rows, and those of a time that begins and ends within partitions; others are not read."""
    options = _chunked(spark, folder, chunk)
    newest = reads.latest(spark, "telemetry", "batch", order=["timestamp", "deviceid", "value"], limit=9, options=options)
    some = reads.time_range(spark, "telemetry", "batch", *RANGES[chunk], options)
    before = len(spark.table(tables.table_name("telemetry", "batch", options)).inputFiles())
    if not 0 < len(some.inputFiles()) < before or len(newest.inputFiles()) >= before:
        raise AssertionError("a read opens files of other partitions")
    wanted = ["timestamp", "deviceid", "value", "k"]
    return newest.select(F.lit("newest").alias("which"), *wanted).union(some.select(F.lit("range"), *wanted))


def hourly_reads(spark: SparkSession, folder: str) -> DataFrame:
    return _read_back(spark, folder, "hour")


def monthly_reads(spark: SparkSession, folder: str) -> DataFrame:
    return _read_back(spark, folder, "month")


def variant_columns(spark: SparkSession, folder: str) -> DataFrame:
    """A filter on a path of a column that holds JSON parsed, and that column as text."""
    options = replace(fresh(spark, "variants"), json_as="variant")
    load(feeds.raw_obj(spark, folder), "feed", options)
    k = F.variant_get("props", "$.k", "bigint")
    found = [reads.scan(spark, *one, options).where(k > 50).withColumn("table_name", F.lit(one[1])) for one in FEED_ROUTES]
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), found)
    return rows.select("table_name", "timestamp", "deviceid", "value", k.alias("k"), F.to_json("props").alias("props"))


def delimited_payloads(spark: SparkSession, folder: str) -> DataFrame:
    options = replace(fresh(spark, "delimited"), header="record")
    load(feeds.raw_delimited(spark, folder), "lines", options, parser="delimited")
    stored = reads.scan(spark, "telemetry", "delimited", options).withColumn("outcome", F.lit("stored"))
    refused = quarantine.read(spark, options).select(F.col("reason").alias("outcome"), "seq", "violations")
    return stored.unionByName(refused, allowMissingColumns=True)


def day_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per day and table as noted: of loads that were repeated with other rows and merged."""
    options = fresh(spark, "counted")
    raw = feeds.raw_list(spark, folder)
    load(raw.where("seq % 2 = 0"), "first", options)
    load(raw, "second", options)
    load(raw.where("seq % 2 = 1"), "second", options)
    compact(spark, "telemetry", "batch", ["first", "second"], options)
    parts = [days.counts(spark, *one, options).withColumn("table_name", F.lit(one[1])) for one in (("telemetry", "batch"), MESSAGES)]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "day").agg(F.sum("rows").alias("rows"))


def latest_sparse(spark: SparkSession, folder: str) -> DataFrame:
    """The newest rows of a table with a row every few years."""
    options = fresh(spark, "sparse")
    load(feeds.raw_sparse(spark, folder), "sparse", options)
    return reads.latest(spark, "telemetry", "sparse", order="timestamp", limit=7, options=options)


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The feed as lines of a few text files, numbered over all of them."""
    path = f"{scratch_dir(spark, 'lines')}/plant"
    feed = feeds.raw_obj(spark, folder)
    files = max(2, -(-feed.count() // LINES_A_FILE))
    feed.repartitionByRange(files, "seq").sortWithinPartitions("seq").select("payload").write.text(path)
    return read_raw(spark, path, "text").select("seq", "topic", "payload")


def text_stream(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'lines')}/plant"
    feeds.raw_obj(spark, folder).select("payload").repartition(LANDING_FILES).write.text(path)
    options = fresh(spark, "lines")
    start_ingest(stream_raw(spark, path, "text"), "lines", scratch_dir(spark, "progress"), options).awaitTermination()
    return _all_tables(spark, options)


def write_messages_stream(spark: SparkSession, folder: str) -> DataFrame:
    landing, out = land(spark, feeds.raw_obj(spark, folder), "landing"), scratch_dir(spark, "outgoing")
    sent = publish(stream_raw(spark, landing).select("seq", "topic", "payload"), ["topic/x", "topic/y"])
    write_messages(sent, out, checkpoint=scratch_dir(spark, "progress")).awaitTermination()
    got = spark.read.schema("topic STRING, payload STRING").json(out)
    message = F.from_json("payload", "seq BIGINT, topic STRING, payload STRING")
    return got.select(F.col("topic").alias("sent_to"), message.alias("message")).select("sent_to", "message.*")


def ingest_metrics(spark: SparkSession, folder: str) -> DataFrame:
    _, report = loaded_feed(spark, folder)
    stored = [("stored", table, count) for (_, table), count in report.stored.items()]
    refused = [("refused", reason, count) for reason, count in report.refused.items()]
    return spark.createDataFrame(stored + refused, "metric STRING, name STRING, value BIGINT")


def parser_registry(spark: SparkSession, folder: str) -> DataFrame:

    def errors_only(raw: DataFrame, options: Options) -> DataFrame:
        return parse_telemetry(subscribe(raw, ["plant/error/#"]), options)

    register_parser("error_topics", errors_only)
    parsed = parse(feeds.raw_obj(spark, folder), parser="ERROR_TOPICS")
    return parsed.select("seq", "target", "reason")


QUERIES = {
    "raw_stream_scan": raw_stream_scan,
    "topic_filter": topic_filter,
    "topic_fanout": topic_fanout,
    "table_scan": table_scan,
    "series_insert": series_insert,
    "decode_json": decode_json,
    "payload_shape": payload_shape,
    "structure_violations": structure_violations,
    "accepted_payloads": accepted_payloads,
    "rejected_payloads": rejected_payloads,
    "batch_explode": batch_explode,
    "batch_header": batch_header,
    "fixed_columns": fixed_columns,
    "route": route,
    "flatten_long": flatten_long,
    "flatten_wide": flatten_wide,
    "wide_record": wide_record,
    "batch_alignment": batch_alignment,
    "type_mapping": type_mapping,
    "json_cell": json_cell,
    "cell_coercion": cell_coercion,
    "message_fork": message_fork,
    "message_last_in_batch": message_last_in_batch,
    "not_null_gate": not_null_gate,
    "ensure_schema": ensure_schema,
    "plain_table_with_id": plain_table_with_id,
    "time_partitioned_table": time_partitioned_table,
    "time_range": time_range,
    "schema_evolution": schema_evolution,
    "many_columns": many_columns,
    "column_dictionary": dictionary_rows,
    "append_batch": append_batch,
    "ensure_then_append": ensure_then_append,
    "routed_append": routed_append,
    "latest_n": latest_n,
    "projection_list": projection_list,
    "latest_n_missing": latest_n_missing,
    "publish_fanout": publish_fanout,
    "stream_admission": stream_admission,
    "stream_ingest": stream_ingest,
    "replay_idempotent": replay_idempotent,
    "replay_changed": replay_changed,
    "stream_restart": stream_restart,
    "isolated_routes": isolated_routes,
    "parked_tables": parked_tables,
    "parked_stream": parked_stream,
    "committed_loads": committed_loads,
    "day_counts": day_counts,
    "latest_sparse": latest_sparse,
    "text_lines": text_lines,
    "text_stream": text_stream,
    "interleaved_appends": interleaved_appends,
    "compacted": compacted,
    "ledger_compacted": ledger_compacted,
    "hourly_table": hourly_table,
    "monthly_table": monthly_table,
    "hourly_reads": hourly_reads,
    "monthly_reads": monthly_reads,
    "variant_columns": variant_columns,
    "delimited_payloads": delimited_payloads,
    "write_messages": write_messages_stream,
    "ingest_metrics": ingest_metrics,
    "parser_registry": parser_registry,
}
