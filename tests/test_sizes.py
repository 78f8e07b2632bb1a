"""Work that is dealt out by its size, with the rows it had before."""

import re

import pytest
from pyspark.sql import functions as F

from telemill import Options, parse, register_parser
from telemill.checks import feeds, queries
from telemill.functions import cells as cell_rules, names, strict_json
from telemill.operators import flatten, outcomes
from telemill.plans import load as loads
from telemill.plans.parse import parse_telemetry
from telemill.streaming.ingest import start_ingest
from telemill.session import scratch_dir
from telemill.sources.raw import stream_raw


@pytest.fixture
def folder(spark, tmp_path):
    """Tables in one file each, which no reader splits."""
    numbers = spark.range(1200).coalesce(1)
    numbers.select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    numbers.select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    event = "id AS event_id", "timestamp_ntz '2024-01-02 03:04:05' AS ts", "id AS user_id", "'error' AS event_type"
    numbers.selectExpr(*event, "id / 4 AS value", "'{\"k\":1}' AS props").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_wide_records_are_made_by_as_many_tasks_as_they_need(spark, folder):
    raw = feeds.raw_wide(spark, folder)
    assert raw.rdd.getNumPartitions() == 3
    assert raw.agg(F.count("*"), F.sum("seq")).first()[:] == (1200, 1199 * 600)


def test_events_are_dealt_out(spark, folder, monkeypatch):
    monkeypatch.setattr(feeds.spread, "__defaults__", (500,))
    raw = feeds.raw_obj(spark, folder)
    assert raw.rdd.getNumPartitions() == 3
    assert raw.count() == 1200


def test_rows_of_many_columns_are_dealt_out_by_their_cells(spark, folder, monkeypatch):
    mine = flatten.accepted(parse(feeds.raw_many(spark, folder).coalesce(1)))
    monkeypatch.setattr(loads, "CELLS_A_TASK", 200_000)
    dealt = loads.dealt(mine, 500)
    assert dealt.rdd.getNumPartitions() == 3
    assert sorted(row.seq for row in dealt.collect()) == list(range(1200))
    assert loads.dealt(mine, 50) is mine


def test_a_wide_projection_casts_once(spark):
    cells = F.expr(
        "array(named_struct('column', 'b', 'tag', 'str', 'value', cast(concat('x', id) AS variant)), "
        "named_struct('column', 'a', 'tag', 'int', 'value', cast(id + 1.5D AS variant)))"
    )
    rows = spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit("d").alias("id"), cells.alias("cells"))
    wide = flatten.wide(rows, {"a": "DOUBLE", "b": "STRING", "c": "DOUBLE", "d": "STRING"}, Options(), checked=True)
    assert wide.select("a", "b", "c", "d").first()[:] == (1.5, "x0", None, None)
    # Each cast of a column from the whole variant copies all of its cells.
    plan = wide.select("a", "c")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") == 1, plan
    assert flatten.wide(rows, {}, Options()).columns == ["timestamp", "deviceid"]


def test_usual_fields_are_digested_without_a_look_at_each(spark):
    texts = [
        '{"a":{"type":"int","value":1},"b":{"type":"x","value":null},"c":{"type":"str"}}',
        '{"A":{"type":"int","value":1},"b":{"type":"json","value":{"x":[1]}},"\u03a3":{"type":"str","value":"y"}}',
        '{"a":{"type":null,"value":1.50},"b":{"value":[1]}}',
        '{"a":{"type":"json"},"b":{"type":"float","value":2}}',
        "{}",
    ]
    fields = F.try_variant_get(F.parse_json("text"), "$", "map<string, struct<type: string, value: variant>>")
    found = spark.createDataFrame([(text,) for text in texts], "text string").select(F.struct(fields.alias("fields")).alias("record"))
    own = outcomes.folded_names(F.col("record"))
    each = F.transform(F.map_entries("record.fields"), lambda entry: cell_rules.digest(entry))
    both = found.select(cell_rules.digests(F.col("record.fields"), own).alias("now"), each.alias("before"))
    assert both.schema["now"].dataType.simpleString() == both.schema["before"].dataType.simpleString()
    rows = both.select(F.to_json("now"), F.to_json("before")).collect()
    assert len(rows) == len(texts) and all(now == before for now, before in rows), rows


def test_names_are_judged_together_as_each_by_itself(spark):
    lists = [["a", "b_1", "_"], ["a,b"], ["a", ""], ["1a"], ["a", "1a"], ["a\n"], ["é", "τη"], ["a\u0301"], ["\u0301a"], ["a b"], [","], []]
    rows = spark.createDataFrame([(x,) for x in lists], "names array<string>").select(
        outcomes.no_identifiers(F.col("names")), F.exists("names", lambda name: ~names.is_identifier(name)), "names"
    )
    assert all(together == each for together, each, _ in rows.collect()), rows.collect()
    twice = [({"a": 1, "b": 2}, False), ({"a": 1, "A": 2}, True), ({"B": 1, "a": 2}, False), ({"Σ": 1, "σ": 2}, True), ({}, False)]
    maps = spark.createDataFrame(twice, "fields map<string, int>, expected boolean")
    folded = outcomes.folded_names(F.struct("fields"))
    judged = maps.select(outcomes.repeated(folded, F.map_keys("fields")), "expected", folded, F.transform(F.map_keys("fields"), F.lower))
    assert all(found == expected and now == before for found, expected, now, before in judged.collect()), judged.collect()


def test_a_message_has_its_texts_taken_out_once(spark, folder):
    found = parse(feeds.raw_obj(spark, folder))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("record.timestamp, $, StringType") == 1
    stored = found.where("target = 'message' AND reason IS NULL").select("rows").first().rows[0]
    assert str(stored.ts) == "2024-01-02 03:04:05" and stored.id.startswith("dev-")


def test_micro_batches_are_dealt_out_before_they_are_parsed(spark, folder):
    plans = []

    def watched(raw, options):
        plans.append(raw._jdf.queryExecution().logical().toString())
        return parse_telemetry(raw, options)

    register_parser("watched", watched)
    landing = queries.land(spark, feeds.raw_obj(spark, folder), "landing")
    options = queries.fresh(spark, "watched")
    start_ingest(stream_raw(spark, landing), "feed", scratch_dir(spark, "progress"), options, parser="watched").awaitTermination()
    assert plans and all("RepartitionByExpression" in plan for plan in plans)
    assert queries.reads.scan(spark, "public", "message", options).count() > 1000


def test_lines_are_written_by_as_many_tasks_as_they_need(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "LINES_A_FILE", 300)
    found = queries.text_lines(spark, folder)
    assert len(found.inputFiles()) >= 4
    expected = feeds.raw_obj(spark, folder).select("seq", "payload").collect()
    assert sorted((row.seq, row.payload) for row in found.collect()) == sorted(tuple(row) for row in expected)


@pytest.mark.parametrize("feed", [feeds.raw_obj, feeds.raw_list])
def test_the_parse_is_compiled(spark, folder, feed, capsys):
    # The JVM leaves a method of more than 8,000 bytes to its interpreter.
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parse(feed(spark, folder)).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000, sizes


def test_the_usual_payload_is_not_written_out_again(spark, folder):
    text = F.col("payload")
    row = feeds.raw_obj(spark, folder).select(strict_json.is_strict(text, strict_json.wrap(text)))
    plan = row._jdf.queryExecution().optimizedPlan().toString()
    assert "$[1], LongType" in plan, plan
    # A path that leads nowhere ends in an exception within the engine, for every payload.
    assert "$[2]" not in plan, plan


@pytest.mark.parametrize("feed", [feeds.raw_list, feeds.raw_delimited])
def test_lists_are_gathered_where_they_were_dealt(spark, folder, feed, monkeypatch):
    monkeypatch.setattr(feeds.spread, "__defaults__", (100,))
    raw = feed(spark, folder)
    assert raw.select(F.spark_partition_id()).distinct().count() > 6
    assert (raw.count(), raw.select("seq").distinct().count()) == (300, 300)
    assert raw._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
