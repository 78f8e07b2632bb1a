"""Loads: tables made, types kept, whole payloads refused, and repeats without duplicates."""

import dataclasses
import datetime
import json
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from telemill import Options, latest, load, register_parser, scan, start_ingest, time_range, unpark
from telemill.functions.names import route_id
from telemill.functions.strict_json import SENTINEL
from telemill.plans.load import LoadError
from telemill.operators.delimited import judged as parse_delimited
from telemill.plans.parse import parse, parse_telemetry
from telemill.sinks import days, jdbc, parked, plain, quarantine, tables
from telemill.sinks.compact import compact
from telemill.sinks.publish import publish
from telemill.sources.raw import RAW_SCHEMA, read_raw, stream_raw
from telemill.sources.series import series
from telemill.sources.topics import fan_out


@pytest.fixture
def options(tmp_path):
    return Options(database_prefix=f"t_{uuid.uuid4().hex[:10]}_", warehouse=str(tmp_path / "tables"))


def raw_of(spark, payloads, first=0):
    rows = [
        (first + number, "plant/x", payload if isinstance(payload, str) else json.dumps(payload),
         datetime.datetime(2024, 1, 1))
        for number, payload in enumerate(payloads)
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def record(day=1, device="d", table="t", **fields):
    return {
        "timestamp": f"2024-01-{day:02d} 00:00:00", "schema": "s", "table": table, "deviceid": device,
        "fields": {
            name: value if isinstance(value, dict) else {"value": value, "type": "float"}
            for name, value in fields.items()
        },
    }


def values(df, *names):
    return sorted(tuple(row) for row in df.select(*names).collect())


def test_types_stay_and_columns_are_added(spark, options):
    load(raw_of(spark, [record(a=1.5)]), "one", options)
    text = {"value": "2.5", "type": "str"}
    load(raw_of(spark, [record(2, a=text, b={"value": {"z": 1}, "type": "json"})]), "two", options)
    table = scan(spark, "s", "t", options)
    assert dict(table.dtypes) == {
        "timestamp": "timestamp_ntz", "deviceid": "string", "a": "double", "b": "string"
    }
    assert values(table, "a", "b") == [(1.5, None), (2.5, '{"z":1}')]
    assert tables.stored_columns(spark, "s", "t", options) == {"a": "DOUBLE", "b": "JSON"}


def test_one_bad_cell_refuses_the_payload_and_keeps_its_message(spark, options):
    batch = [record(1, a=1.0, message={"value": "m1"}), record(2, a="bad", message={"value": "m2"})]
    report = load(raw_of(spark, [batch, [record(3, a=3.0)]]), "one", options)
    assert report.stored == {("s", "t"): 1, ("public", "message"): 2}
    assert report.refused == {"cast_failed": 1}
    assert values(scan(spark, "public", "message", options), "message") == [("m1",), ("m2",)]
    kept = quarantine.read(spark, options).collect()
    assert [(row.seq, row.target, row.reason, row.scope) for row in kept] == [(0, "data", "cast_failed", "s.t")]
    assert json.loads(kept[0].payload) == batch


def test_refused_payloads_are_kept_whole(spark, options):
    payloads = ["{", "[]", {"fields": {"x": 1}}, record(a=1.0)]
    report = load(raw_of(spark, payloads), "one", options)
    assert report.refused == {"bad_json": 1, "empty_batch": 1, "structure": 1}
    kept = values(quarantine.read(spark, options), "seq", "reason", "payload")
    assert kept == [(0, "bad_json", "{"), (1, "empty_batch", "[]"), (2, "structure", '{"fields": {"x": 1}}')]


def test_all_payloads_of_a_table_refused(spark, options):
    load(raw_of(spark, [record(a=1.0)]), "one", options)
    report = load(raw_of(spark, [record(a="x"), record(a="y")]), "two", options)
    assert report.stored == {("s", "t"): 0}
    assert report.refused == {"cast_failed": 2}


@pytest.mark.parametrize("staged", [False, True])
def test_repeat_of_a_load_leaves_no_duplicates(spark, options, tmp_path, staged):
    raw = raw_of(spark, [record(day, a=float(day), **{f"c{day}": 1.0}) for day in (1, 2, 3)] + ["{"])
    for attempt in range(2):
        staging = str(tmp_path / f"staging-{attempt}") if staged else None
        report = load(raw, "same", options, staging=staging)
        assert report.stored == {("s", "t"): 3}
    load(raw, "other", options)
    assert scan(spark, "s", "t", options).count() == 6
    assert quarantine.read(spark, options).count() == 2


def test_staged_and_kept_loads_agree(spark, options, tmp_path):
    payloads = [record(1 + n % 28, table=f"t{n % 3}", device=f"d{n}", a=n, b={"value": f"v{n}"}) for n in range(90)]
    payloads[5] = record(a="x", table="t0")
    load(raw_of(spark, payloads), "kept", options)
    load(raw_of(spark, payloads), "staged", options, staging=str(tmp_path / "staging"))
    for name in ("t0", "t1", "t2"):
        rows = spark.table(tables.table_name("s", name, options))
        kept, staged = (
            values(rows.where(F.col("ingest_batch") == x), "timestamp", "deviceid", "a", "b")
            for x in ("kept", "staged")
        )
        assert kept == staged and kept


def test_any_number_of_columns_is_stored(spark, options):
    payloads = [record(**{f"c{n}": float(n) for n in range(start, start + 700)}) for start in (0, 700, 1400)]
    report = load(raw_of(spark, payloads), "one", options)
    assert (report.stored, report.refused) == ({("s", "t"): 3}, {})
    assert len(scan(spark, "s", "t", options).columns) == 2102


def test_a_repeat_with_other_rows_replaces_all_of_the_load(spark, options):
    first = [record(1, a=1.0), record(1, a="x"), record(1, table="gone", a=1.0), record(3, table="worse", a=1.0)]
    load(raw_of(spark, first), "same", options)
    load(raw_of(spark, [record(1, a=7.0)]), "other", options)
    report = load(raw_of(spark, [record(2, a=2.0), record(2, a="bad"), record(3, table="worse", a="y")], 10), "same", options)
    assert report.stored == {("s", "t"): 1, ("s", "worse"): 0}
    assert report.refused == {"cast_failed": 2}
    assert values(scan(spark, "s", "t", options), "a") == [(2.0,), (7.0,)]
    assert scan(spark, "s", "gone", options).count() == scan(spark, "s", "worse", options).count() == 0
    assert values(quarantine.read(spark, options), "seq", "reason") == [(11, "cast_failed"), (12, "cast_failed")]
    assert load(raw_of(spark, []), "same", options).stored == {}
    assert values(scan(spark, "s", "t", options), "a") == [(7.0,)]
    assert quarantine.read(spark, options).count() == 0


def test_repeated_numbers_do_not_mix_payloads(spark, options):
    raw = raw_of(spark, [record(a=1.0)]).union(raw_of(spark, [record(a="bad")]))
    report = load(raw, "one", options)
    assert report.refused == {"cast_failed": 1}
    assert [json.loads(row.payload)["fields"]["a"]["value"] for row in quarantine.read(spark, options).collect()] == ["bad"]


def test_one_bad_table_harms_only_itself(spark, options):
    tables.ensure_schema(spark, "s", options)
    tables.create_plain_table(spark, "s", "plain", {"a": "DOUBLE"}, options)
    report = load(raw_of(spark, [record(a=1.0), record(table="plain", a=2.0)]), "one", options)
    assert report.stored == {("s", "t"): 1, ("s", "plain"): 0}
    assert report.refused == {"bad_table": 1}
    assert spark.table(tables.table_name("s", "plain", options)).columns == ["id", "a", "ingest_batch"]


def test_loads_widen_a_table_together(spark, options):
    def one(number):
        return load(raw_of(spark, [record(number + 1, a=1.0, **{f"c{number}": 2.0})], number), f"load-{number}", options)

    with ThreadPoolExecutor(4) as pool:
        reports = list(pool.map(one, range(4)))
    assert all(report.stored == {("s", "t"): 1} for report in reports)
    table = scan(spark, "s", "t", options)
    assert set(table.columns) == {"timestamp", "deviceid", "a", "c0", "c1", "c2", "c3"}
    assert table.where("coalesce(c0, c1, c2, c3) = 2").count() == 4


def test_a_new_checkpoint_keeps_what_is_stored(spark, options, tmp_path):
    for number in range(2):
        landing = str(tmp_path / f"landing-{number}")
        raw_of(spark, [record(a=float(number))]).write.parquet(landing)
        start_ingest(stream_raw(spark, landing), "plant", str(tmp_path / f"progress-{number}"), options).awaitTermination()
    assert values(scan(spark, "s", "t", options), "a") == [(0.0,), (1.0,)]


def test_compaction_keeps_rows_and_closes_loads(spark, options):
    for number in range(3):
        load(raw_of(spark, [record(1 + n % 2, a=float(n)) for n in range(4)]), f"b{number}", options)
    for _ in range(2):
        compact(spark, "s", "t", ["b0", "b1"], options)
    table = spark.table(tables.table_name("s", "t", options))
    assert table.count() == 12
    assert table.select("ts_date", "ingest_batch").distinct().count() == 4
    with pytest.raises(ValueError, match="closed"):
        load(raw_of(spark, [record(a=1.0)]), "b0", options)
    load(raw_of(spark, [record(a=5.0)]), "b2", options)
    assert table.sparkSession.table(tables.table_name("s", "t", options)).count() == 9


def test_latest_over_sparse_and_early_days(spark, options):
    stamps = [f"{year:04d}-01-01 00:00:00" for year in range(1825, 2025)] + ["0000-01-01 00:00:00"]
    load(raw_of(spark, [{**record(a=n), "timestamp": stamp} for n, stamp in enumerate(stamps)]), "one", options)
    newest = latest(spark, "s", "t", "a", order="timestamp", limit=2, options=options)
    assert [row.a for row in newest.collect()] == [199.0, 198.0]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "ts_date" in plan.split("PartitionFilters")[1][:80]
    assert latest(spark, "s", "t", "a", order="timestamp", limit=300, options=options).count() == 201


def test_bounds_with_a_zone_are_refused(spark, options):
    load(raw_of(spark, [record(a=1.0)]), "one", options)
    with pytest.raises(ValueError):
        time_range(spark, "s", "t", datetime.datetime.now(datetime.UTC), datetime.datetime.now(datetime.UTC), options)


def test_an_empty_load(spark, options):
    report = load(raw_of(spark, [record(a=1.0)]).where("seq < 0"), "none", options)
    assert (report.stored, report.refused) == ({}, {})


def test_a_message_without_listed_columns(spark, options):
    bare = Options(database_prefix=options.database_prefix, warehouse=options.warehouse, message_columns=("level",))
    report = load(raw_of(spark, [record(message={"value": "m"})]), "one", bare)
    assert report.stored == {("s", "t"): 1, ("public", "message"): 1}


def test_a_hot_table_and_a_hot_day(spark, options, tmp_path):
    payloads = [record(1 if n % 3 else 2, table="hot" if n % 3 else "cold", a=n) for n in range(3000)]
    load(raw_of(spark, payloads).repartition(8), "one", options, staging=str(tmp_path / "staging"))
    assert scan(spark, "s", "hot", options).agg(F.count("*"), F.sum("a")).first()[:] == (
        2000, float(sum(n for n in range(3000) if n % 3))
    )
    assert scan(spark, "s", "cold", options).count() == 1000


def test_stream_equals_batch(spark, options, tmp_path):
    payloads = [record(1 + n % 5, device=f"d{n}", a=n, message={"value": f"m{n}"}) for n in range(40)] + ["{", "7"]
    landing = str(tmp_path / "landing")
    raw_of(spark, payloads).repartition(4).write.parquet(landing)
    streamed = Options(database_prefix=options.database_prefix + "s_", warehouse=options.warehouse)
    reports = []
    for _ in range(2):  # the second start finds nothing new
        raw = stream_raw(spark, landing, max_files_per_trigger=1)
        start_ingest(raw, "feed", str(tmp_path / "progress"), streamed, on_batch=reports.append).awaitTermination()
    assert len(reports) == 4
    load(read_raw(spark, landing), "batch", options)
    for schema, table, names in (("s", "t", ("timestamp", "deviceid", "a", "message")),
                                 ("public", "message", ("timestamp", "deviceid", "message"))):
        assert values(scan(spark, schema, table, streamed), *names) == values(scan(spark, schema, table, options), *names)
    assert values(quarantine.read(spark, streamed), "seq") == [(40,), (41,)]


def test_two_streams_share_a_table(spark, options, tmp_path):
    for name, first in (("east", 0), ("west", 100)):
        landing = str(tmp_path / name)
        raw_of(spark, [record(device=name, a=n) for n in range(5)], first).write.parquet(landing)
        start_ingest(stream_raw(spark, landing), name, str(tmp_path / f"progress-{name}"), options).awaitTermination()
    assert scan(spark, "s", "t", options).groupBy("deviceid").count().count() == 2
    assert scan(spark, "s", "t", options).count() == 10


def test_latest(spark, options):
    days = [record(day, device=f"d{day}", a=day if day % 2 else {"value": None, "type": "float"}) for day in range(1, 21)]
    load(raw_of(spark, days), "one", options)

    def read(*args, **named):
        return latest(spark, "s", "t", *args, options=options, **named)

    newest = read("deviceid, a", order="timestamp", limit=3)
    assert [row.deviceid for row in newest.collect()] == ["d20", "d19", "d18"]
    assert newest.columns == ["deviceid", "a"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "ts_date" in plan.split("PartitionFilters")[1][:80]
    # NULLs come first in descending order.
    assert [row.a for row in read(order=["a", "timestamp"], limit=11).collect()] == [None] * 10 + [19.0]
    assert [row.deviceid for row in read(order=["a", "timestamp"], limit=1).collect()] == ["d20"]
    assert read(limit=500, order="timestamp").count() == 20
    assert read("deviceid", order="timestamp", limit=1, expressions=[(F.col("a") + 1).alias("b")]).columns == ["deviceid", "b"]
    assert read().count() == 0  # there is no column id
    assert read("nothing", order="timestamp").count() == 0
    assert latest(spark, "nowhere", "t", options=options).count() == 0


def test_time_range_reads_only_its_days(spark, options):
    load(raw_of(spark, [record(day, a=day) for day in range(1, 21)]), "one", options)
    found = time_range(spark, "s", "t", datetime.datetime(2024, 1, 5), datetime.datetime(2024, 1, 8), options)
    assert values(found, "a") == [(5.0,), (6.0,), (7.0,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ts_date" in plan.split("PartitionFilters")[1][:120]
    assert "GreaterThanOrEqual(timestamp" in plan


def test_payloads_are_parsed_once(spark):
    raw = raw_of(spark, [record(a=1.0)])
    accepted = parse(raw).where("reason IS NULL").select(F.explode_outer("rows").alias("row")).where("row.pos = 0")
    plan = accepted._jdf.queryExecution().optimizedPlan().toString()
    # The wrapped text stands in the plan once, whatever is filtered on later.
    assert plan.count(f",{SENTINEL}]") == 1


def test_plain_table_keys(spark, options):
    tables.ensure_schema(spark, "p", options)
    tables.create_plain_table(spark, "p", "plain", {"name": "STRING", "v": "DOUBLE"}, options)
    # One value holds most rows: it is split over ranges, and keys stay without gaps.
    rows = spark.range(0, 3000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("name"),
        F.lit(1.0).alias("v"),
    )
    plain.append_plain(rows, "p", "plain", ["name"], "first", options)
    for _ in range(2):  # the second attempt replaces the first
        plain.append_plain(rows.limit(10), "p", "plain", ["name"], "second", options)
    table = spark.table(tables.table_name("p", "plain", options))
    assert table.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first()[:] == (1, 3010, 3010)
    first = table.where("id <= 3000").orderBy("id").select("name").collect()
    assert [row.name for row in first] == sorted(row.name for row in first)


def test_parser_registry(spark):
    register_parser("Only_T", lambda raw, options: parse_telemetry(raw.where("seq > 0"), options))
    raw = raw_of(spark, [record(a=1.0), record(a=2.0)])
    assert [row.seq for row in parse(raw, parser="ONLY_t").collect()] == [1]
    with pytest.raises(ValueError):
        parse(raw, parser="unknown")


def test_other_landing_formats(spark, tmp_path):
    raw = raw_of(spark, [record(a=1.0), "{"])
    raw.write.json(str(tmp_path / "json"))
    assert values(read_raw(spark, str(tmp_path / "json"), "json"), "seq", "topic", "payload") == values(raw, "seq", "topic", "payload")
    renamed = raw.withColumnsRenamed({"seq": "n", "payload": "body"})
    renamed.withColumn("body", F.col("body").cast("binary")).write.parquet(str(tmp_path / "renamed"))
    assert values(read_raw(spark, str(tmp_path / "renamed"), seq="n", payload="body"), "seq") == [(0,), (1,)]
    raw.select("payload").write.text(str(tmp_path / "lines" / "plant"))
    lines = read_raw(spark, str(tmp_path / "lines" / "plant"), "text")
    assert values(lines, "topic", "payload") == sorted(("plant", row.payload) for row in raw.collect())
    numbers = values(lines, "seq", "payload")
    assert len(set(numbers)) == 2
    assert values(lines.repartition(3), "seq", "payload") == numbers


def test_fan_out_and_publish(spark):
    raw = raw_of(spark, ["{}", "[]"])
    assert values(fan_out(raw, ["plant/#", "other"], "all"), "seq", "subscription") == [
        (0, "other"), (0, "plant/#"), (1, "other"), (1, "plant/#")
    ]
    assert fan_out(raw, ["other"]).count() == 0
    sent = publish(spark.createDataFrame([(1, None)], "a INT, b STRING"), ["x", "y"])
    assert values(sent, "topic", "payload") == [("x", '{"a":1,"b":null}'), ("y", '{"a":1,"b":null}')]


def test_series(spark):
    rows = series(spark.range(3), 100)
    assert rows.count() == 300
    assert rows.where("id < 0 OR id >= 100000000 OR crt_time IS NULL").count() == 0


def test_jdbc_writer_options(monkeypatch, spark):
    # No database may be started here: only what is handed to the writer is checked.
    seen = {}
    from pyspark.sql import DataFrameWriter

    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.update(saved=True))
    monkeypatch.setattr(DataFrameWriter, "option", lambda self, k, v: seen.update({k: v}) or self)
    jdbc.write_jdbc(spark.range(3), "jdbc:postgresql://host/db", "public.t", 500, 2, {"user": "u"})
    assert seen == {"url": "jdbc:postgresql://host/db", "dbtable": "public.t", "batchsize": 500, "saved": True}


def odd_table(spark, options, table="t"):
    """A table whose column ``a`` is of a type that loads do not make."""
    tables.ensure_schema(spark, "s", options)
    name = tables.table_name("s", table, options)
    spark.sql(f"CREATE TABLE {name} (timestamp TIMESTAMP_NTZ, deviceid STRING, a INT, ts_date DATE, ingest_batch STRING) USING parquet PARTITIONED BY (ts_date, ingest_batch)")
    return name


def test_what_a_table_cannot_take_is_parked(spark, options):
    name = odd_table(spark, options)
    raw = raw_of(spark, [record(1, a=1.0), [record(2, a=2.0), record(3, a=3.0)], record(table="fine", a=4.0), record(a="bad")])
    for _ in range(2):  # a repeat parks the same once
        report = load(raw, "one", options)
        assert report.stored == {("s", "fine"): 1} and list(report.parked) == [("s", "t")]
    load(raw_of(spark, [record(5, a=5.0)]), "two", options)
    waiting = parked.waiting(spark, options)
    assert values(waiting, "ingest_batch", "outcomes", "rows") == [("one", 3, 4), ("two", 1, 1)]
    assert all("a" in row.error for row in waiting.collect())
    assert values(scan(spark, "s", "fine", options), "a") == [(4.0,)]
    with pytest.raises(tables.OtherType):
        unpark(spark, "s", "t", options)
    assert waiting.count() == 2
    spark.sql(f"DROP TABLE {name}")
    reports = unpark(spark, "s", "t", options)
    assert list(reports) == ["one", "two"] and reports["one"].refused == {"cast_failed": 1}
    assert values(scan(spark, "s", "t", options), "a") == [(1.0,), (2.0,), (3.0,), (5.0,)]
    assert parked.waiting(spark, options).count() == 0 and unpark(spark, "s", "t", options) == {}
    # The load can still be repeated, and finds its rows.
    assert load(raw, "one", options).stored == {("s", "t"): 3, ("s", "fine"): 1}
    assert scan(spark, "s", "t", options).count() == 4


def test_a_load_that_no_longer_fails_leaves_nothing_parked(spark, options):
    name = odd_table(spark, options)
    raw = raw_of(spark, [record(a=1.0)])
    load(raw, "one", options)
    spark.sql(f"DROP TABLE {name}")
    assert load(raw, "one", options).parked == {}
    assert parked.waiting(spark, options).count() == 0
    assert scan(spark, "s", "t", options).count() == 1


def test_a_broken_load_is_not_seen(spark, options, monkeypatch):
    strict = dataclasses.replace(options, park_failures=False, parallel_routes=1)
    load(raw_of(spark, [record(1, a=1.0), record(1, table="u", a=1.0)]), "one", strict)
    noted = days.note

    def broken(spark_, schema, table, *rest):
        if table == "u":
            raise RuntimeError("gone")
        noted(spark_, schema, table, *rest)

    raw = raw_of(spark, [record(2, a=2.0), record(2, table="u", a=2.0)])
    monkeypatch.setattr(days, "note", broken)
    with pytest.raises(LoadError):
        load(raw, "two", strict)
    start, end = datetime.datetime(2024, 1, 1), datetime.datetime(2025, 1, 1)
    for table in ("t", "u"):
        assert spark.table(tables.table_name("s", table, options)).count() == 2  # written, but not to be seen
        assert values(scan(spark, "s", table, options), "a") == [(1.0,)]
        assert values(time_range(spark, "s", table, start, end, options), "a") == [(1.0,)]
        assert [row.a for row in latest(spark, "s", table, order="timestamp", options=options).collect()] == [1.0]
    monkeypatch.undo()
    load(raw, "two", strict)
    for table in ("t", "u"):
        assert values(scan(spark, "s", table, options), "a") == [(1.0,), (2.0,)]


def test_readers_see_a_merge_at_once(spark, options, monkeypatch):
    for number in range(2):
        load(raw_of(spark, [record(1, a=float(number))]), f"b{number}", options)
    seen = []
    for module, name in ((tables, "overwrite_partitions"), (tables, "drop_chunks")):
        real = getattr(module, name)

        def watched(*args, real=real):
            seen.append(values(scan(spark, "s", "t", options), "a"))
            real(*args)
            seen.append(values(scan(spark, "s", "t", options), "a"))

        monkeypatch.setattr(module, name, watched)
    compact(spark, "s", "t", ["b0", "b1"], options)
    monkeypatch.undo()
    assert len(seen) > 6 and all(rows == [(0.0,), (1.0,)] for rows in seen)


def test_days_are_noted_and_latest_reads_them(spark, options):
    def noted():
        rows = days.counts(spark, "s", "t", options).groupBy("day").agg(F.sum("rows").alias("rows"))
        return [(row.day.day, row.rows) for row in rows.orderBy("day").collect()]

    load(raw_of(spark, [record(day, a=1.0) for day in (1, 1, 2, 9)]), "one", options)
    load(raw_of(spark, [record(day, a=2.0) for day in (2, 9)]), "two", options)
    assert noted() == [(1, 2), (2, 2), (9, 2)]
    load(raw_of(spark, [record(3, a=3.0), record(3, a="bad")]), "two", options)
    assert noted() == [(1, 2), (2, 1), (3, 1), (9, 1)]
    compact(spark, "s", "t", ["one", "two"], options)
    assert noted() == [(1, 2), (2, 1), (3, 1), (9, 1)]
    assert days.first_needed(spark, "s", "t", 2, options) == (True, (datetime.date(2024, 1, 3) - datetime.date(1970, 1, 1)).days)
    newest = latest(spark, "s", "t", "a", order="timestamp", limit=2, options=options)
    assert len(newest.inputFiles()) == 2 and newest.count() == 2
    # A table that nothing is noted of is looked through as before.
    days.forget(spark, "s", "t", days.counts(spark, "s", "t", options).first()["ingest_batch"], options)
    assert latest(spark, "s", "t", order="timestamp", limit=2, options=options).count() == 2


def test_names_too_long_for_a_path(spark, options):
    with pytest.raises(ValueError, match="name"):
        load(raw_of(spark, [record(a=1.0)]), "x" * 201, options)
    with pytest.raises(ValueError):
        start_ingest(spark.readStream.format("rate").load(), "é" * 60, "/nowhere", options)
    schema = "s" * (251 - len(options.database_prefix))
    payloads = [{**record(a=value), "schema": schema, "table": "t" * 255} for value in (1.0, "bad")]
    report = load(raw_of(spark, payloads), "x" * 200, options)
    assert (list(report.stored.values()), report.refused) == ([1], {"cast_failed": 1})
    assert quarantine.read(spark, options).first()["scope"] == route_id(schema, "t" * 255)
    assert load(raw_of(spark, [{**record(a=1.0), "table": "τήλε"}]), "latin", options).refused == {"bad_route": 1}


def test_reasons_of_another_parser_are_counted(spark, options):
    def own(raw, options):
        return parse_telemetry(raw, options).withColumn("reason", F.when(F.col("seq") == 0, "unwanted").otherwise(F.col("reason")))

    register_parser("own_reasons", own)
    report = load(raw_of(spark, [record(a=1.0), "{", record(a=2.0)]), "one", options, parser="own_reasons")
    assert report.refused == {"unwanted": 1, "bad_json": 1}


def test_lines_are_numbered_over_splits(spark, tmp_path):
    folder = tmp_path / "plant"
    folder.mkdir()
    lines = [f'{{"n":{n},"t":"{"x" * (n % 90)}"}}' + ("\r" if n % 5 == 0 else "") for n in range(3000)]
    (folder / "a").write_bytes("\n".join(lines[:2500]).encode())
    (folder / "b").write_bytes(("\n".join(lines[2500:]) + "\n").encode())
    (folder / "c").write_bytes(b"")
    for size in ("128m", "4k", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k" if size != "128m" else "4m")
        try:
            read = read_raw(spark, str(folder), "text")
            found = values(read, "seq", "topic", "payload")
            assert found == [(n, "plant", line.rstrip("\r")) for n, line in enumerate(lines)]
            if size == "1k":
                assert spark.read.text(str(folder)).select(F.spark_partition_id()).distinct().count() > 8
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_key_ranges(spark, options):
    tables.ensure_schema(spark, "p", options)
    tables.create_plain_table(spark, "p", "plain", {"v": "DOUBLE"}, options)

    def rows(n):
        return spark.range(n).select(F.col("id").cast("double").alias("v"))

    def keys():
        table = spark.table(tables.table_name("p", "plain", options))
        return {row.b: (row.lo, row.hi, row.n) for row in table.groupBy(F.col("ingest_batch").alias("b")).agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count_distinct("id").alias("n")).collect()}

    plain.append_plain(rows(10), "p", "plain", ["v"], "one", options)
    plain.append_plain(rows(5), "p", "plain", ["v"], "two", options)
    plain.append_plain(rows(10), "p", "plain", ["v"], "one", options)
    assert keys() == {"one": (1, 10, 10), "two": (11, 15, 5)}
    plain.append_plain(rows(4), "p", "plain", ["v"], "two", options)
    plain.append_plain(rows(12), "p", "plain", ["v"], "one", options)
    assert keys() == {"one": (16, 27, 12), "two": (11, 14, 4)}


def test_notes_are_merged_and_loads_closed(spark, options):
    loads = [f"l {n}/%" for n in range(3)]
    for n, name in enumerate(loads):
        load(raw_of(spark, [record(a=float(n)), "{", record(a="bad")], first=10 * n), name, options)
    load(raw_of(spark, ["{"], first=90), "refused only", options)
    expected = values(quarantine.read(spark, options), "load", "seq", "reason")
    assert len(expected) == 7
    merged = quarantine.merge_notes(spark, [loads[0], "refused only"], options)
    assert values(quarantine.read(spark, options), "load", "seq", "reason") == expected
    again = quarantine.merge_notes(spark, [merged, loads[1]], options)
    assert values(quarantine.read(spark, options), "load", "seq", "reason") == expected
    assert {row[0] for row in quarantine.read(spark, options).select("ingest_batch").collect()} == {again, loads[2]}
    for name in (loads[0], loads[1], "refused only"):
        with pytest.raises(ValueError, match="closed"):
            load(raw_of(spark, [record(a=1.0)]), name, options)
    load(raw_of(spark, [record(a=7.0)]), loads[2], options)
    assert values(scan(spark, "s", "t", options), "a") == [(0.0,), (1.0,), (7.0,)]
    assert quarantine.read(spark, options).count() == 5
    # Rows of closed loads can still be merged.
    compact(spark, "s", "t", loads[:2], options)
    assert values(scan(spark, "s", "t", options), "a") == [(0.0,), (1.0,), (7.0,)]


@pytest.mark.parametrize("step", (3, 5))
def test_a_merge_of_notes_that_breaks_off(spark, options, monkeypatch, step):
    for n in range(2):
        load(raw_of(spark, [record(a=float(n)), "{"], first=10 * n), f"b{n}", options)
    expected = values(quarantine.read(spark, options), "load", "seq", "reason")
    calls = []
    for module, name in ((tables, "overwrite_partitions"), (tables, "drop_partitions")):
        real = getattr(module, name)

        def broken(*args, real=real):
            calls.append(1)
            if len(calls) == step:
                raise RuntimeError("lost")
            real(*args)

        monkeypatch.setattr(module, name, broken)
    with pytest.raises(RuntimeError):
        quarantine.merge_notes(spark, ["b0", "b1"], options)
    monkeypatch.undo()
    assert values(quarantine.read(spark, options), "load", "seq", "reason") == expected
    load(raw_of(spark, [record(a=5.0), "{"], first=50), "b2", options)
    merged = quarantine.merge_notes(spark, ["b0", "b1", "b2"], options)
    kept = quarantine.read(spark, options)
    assert values(kept, "load", "seq", "reason") == [*expected, ("b2", 51, "bad_json")]
    if step < 4:  # it was undone, so all three loads are merged now
        assert {row[0] for row in kept.select("ingest_batch").collect()} == {merged}
    for name in ("b0", "b2"):
        with pytest.raises(ValueError, match="closed"):
            load(raw_of(spark, [record(a=1.0)]), name, options)


def test_a_broken_load_is_not_merged(spark, options):
    strict = dataclasses.replace(options, park_failures=False)
    load(raw_of(spark, [record(a=1.0)]), "one", strict)
    spark.sql(f"DROP TABLE {tables.table_name('s', 't', strict)}")
    spark.sql(f"CREATE TABLE {tables.table_name('s', 't', strict)} (timestamp TIMESTAMP_NTZ, deviceid STRING, a INT, ts_date DATE, ingest_batch STRING) USING parquet PARTITIONED BY (ts_date, ingest_batch)")
    with pytest.raises(LoadError):
        load(raw_of(spark, [record(a=1.0)]), "two", strict)
    with pytest.raises(ValueError, match="not complete"):
        quarantine.merge_notes(spark, ["one", "two"], strict)


def test_widths_of_partitions(spark, options):
    stamps = ["2024-01-31 23:59:59", "2024-02-01 00:00:00", "2024-02-01 05:30:00", "1969-12-31 23:00:00", "2024-02-29 05:00:00"]
    payloads = [{**record(a=float(n)), "timestamp": stamp} for n, stamp in enumerate(stamps)]
    expected = {
        "hour": [("1969-12-31", 23), ("2024-01-31", 23), ("2024-02-01", 0), ("2024-02-01", 5), ("2024-02-29", 5)],
        "month": [("1969-12-01",), ("2024-01-01",), ("2024-02-01",), ("2024-02-01",), ("2024-02-01",)],
    }
    for chunk, keys in expected.items():
        mine = dataclasses.replace(options, chunk=chunk, database_prefix=f"{options.database_prefix}{chunk}_")
        load(raw_of(spark, payloads), "one", mine)
        load(raw_of(spark, payloads[:2]), "two", dataclasses.replace(mine, chunk="day"))  # a table keeps its width
        load(raw_of(spark, payloads[2:]), "two", dataclasses.replace(mine, chunk="day"))
        table = tables.table_name("s", "t", mine)
        own = spark.table(table).where("ingest_batch = 'one'").withColumn("ts_date", F.col("ts_date").cast("string"))
        assert values(own, *(["ts_date", "ts_hour"] if chunk == "hour" else ["ts_date"])) == keys
        assert spark.table(table).count() == 8
        compact(spark, "s", "t", ["one", "two"], mine)
        assert spark.table(table).select("ingest_batch").distinct().count() == 1
        both = time_range(spark, "s", "t", datetime.datetime(2024, 1, 31, 23, 30), datetime.datetime(2024, 2, 1, 5, 30), mine)
        assert values(both, "a") == [(0.0,), (1.0,)]
        assert set(both.columns) == {"timestamp", "deviceid", "a"}
        newest = latest(spark, "s", "t", "a", order="timestamp", limit=3, options=mine)
        assert [row.a for row in newest.collect()] == [4.0, 4.0, 2.0]
    with pytest.raises(ValueError, match="width"):
        tables.create_time_table(spark, "s", "t", {}, dataclasses.replace(options, chunk="week"))


def test_json_as_variant(spark, options):
    mine = dataclasses.replace(options, json_as="variant")

    def json_field(value):
        return record(j={"value": value, "type": "json"})

    odd = [{"a": [1, {"b": "x"}]}, None, "text", 5, [], record(j={"value": '{"q":1}', "type": "str"})]
    load(raw_of(spark, [x if isinstance(x, dict) and "fields" in x else json_field(x) for x in odd]), "one", mine)
    report = load(raw_of(spark, [record(j={"value": "no json", "type": "str"}), json_field({"z": 2})]), "two", mine)
    assert report.refused == {"cast_failed": 1}
    table = scan(spark, "s", "t", options)
    assert dict(table.dtypes)["j"] == "variant"
    found = {row[0] for row in table.select(F.to_json("j")).collect()}
    assert found == {'{"a":[1,{"b":"x"}]}', "null", '"text"', "5", "[]", '{"q":1}', '{"z":2}'}
    compact(spark, "s", "t", ["one", "two"], mine)
    assert scan(spark, "s", "t", options).where(F.try_variant_get("j", "$.a[1].b", "string") == "x").count() == 1


def test_delimited_payloads(spark):
    def judged(*payloads, separator=","):
        rows = parse_delimited(raw_of(spark, payloads), separator).orderBy("seq").collect()
        return [(row.reason, row.violations) for row in rows]

    head = "timestamp,table,a:float,j:json,t"
    assert judged(
        head + "\n2024-01-01 00:00:00,t,1,5,x\n\n", head + '\r\n,,,,\r\n,,,"{""k"":""a,b""}",""\r\n',
        head, "", "\n \n", "a,,b\n1,2,3", 'a,"b\n1,2', "a:int,a:float\n1,2", "timestamp,a\n1\n1,2,3\n1,2",
        'a,j:json\n"x"y,{\nx"y,5\n"x""y",""', "timestamp,deviceid\n1,2\n3,4", '{"timestamp":"2024-01-01 00:00:00"}',
    ) == [
        (None, 0), (None, 0), ("empty_batch", 0), ("bad_payload_type", 1), ("bad_payload_type", 1), ("bad_payload_type", 1),
        ("bad_payload_type", 1), ("duplicate_column", None), ("structure", 2), ("structure", 4), ("structure", 2),
        ("bad_payload_type", 1),
    ]
    assert judged("a;b\n1;2", "a\n" + '"' + '""' * 50000 + '"', separator=";") == [(None, 0), (None, 0)]
    with pytest.raises(ValueError):
        judged("a", separator='"')
    long = raw_of(spark, ["\n".join(["timestamp,a:float,b:str"] + [f"2024-01-01 00:00:00,{n},\"q\"\"{n}\"" for n in range(5000)])])
    found = parse(long, parser="delimited").select(F.explode("rows.cells").alias("cells"))
    cells = found.select(F.to_json(F.col("cells")[1]["value"]).alias("b"), F.col("cells")[0]["value"].cast("double").alias("a")).collect()
    assert len(cells) == 5000 and cells[4999] == ('"q\\"4999"', 4999.0)
