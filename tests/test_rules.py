"""Case tables for the JSON dialect, structure, defaults, routes, names and cells."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from telemill import Options, parse
from telemill.functions import cells as cell_rules
from telemill.functions import strict_json
from telemill.functions.names import topic_regex
from telemill.operators import coerce, flatten
from telemill.operators.decode import decode, judge
from telemill.operators.dictionary import column_dictionary


def raw_of(spark, payloads):
    rows = [(number, "t", payload, None) for number, payload in enumerate(payloads)]
    return spark.createDataFrame(rows, "seq BIGINT, topic STRING, payload STRING, recv_ts TIMESTAMP_NTZ")


def data_of(spark, payloads, options=None):
    found = parse(raw_of(spark, payloads), options).where("target = 'data'").orderBy("seq")
    return found.collect()


def record(fields=None, **members):
    whole = {"timestamp": "2024-01-02 03:04:05", "schema": "s", "table": "t", "deviceid": "d"}
    whole.update(members)
    whole["fields"] = {"x": {"value": 1, "type": "int"}} if fields is None else fields
    return {key: value for key, value in whole.items() if value != "MISSING"}


STRICT = [
    '{"fields":{"x":{}}}', "5", "null", '"a"', "[]", " [1] ", '{"a":1} xx', '{"a":1}{"b":2}', "[1] ]",
    "[1] ] x", '{"a":1}}', '{"a":1}} xx', "1,2", '1,"b":2', "1],[2", "", "  ", "{'a':1}", '{"a":1,}',
    "[1,]", "01", "+1", ".5", "1.", "-", "-0", "1E5", "tru", "}", "]", '"a\tb"', "// c\n1",
    '{"x":1,"x":2}', f'"a",{strict_json.SENTINEL}]', f'"{strict_json.SENTINEL}"',
    f'{{"a":{strict_json.SENTINEL}}}', '﻿{"a":1}', '{"a":"\\ud83d\\ude00"}', '{"αβ":"ü"}',
]


def is_json(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


def test_a_sentinel_in_escapes_is_no_sentinel(spark):
    digits = "\\u0032" + strict_json.SENTINEL[1:]
    payloads = [f'1,"{digits}"],[2', f'1,"{digits}"],', f'"{digits}"', f'[1,"{digits}"]', "1,2.71828182845904523e17],", "1,true],"]
    text = F.col("payload")
    found = raw_of(spark, payloads).orderBy("seq").select(strict_json.is_strict(text, strict_json.wrap(text))).collect()
    assert [row[0] for row in found] == [False, False, True, True, False, False]


def test_strict_json_agrees_with_the_standard_parser(spark):
    expected = [is_json(text) for text in STRICT]
    found = decode(raw_of(spark, STRICT)).orderBy("seq").collect()
    assert [row.root is not None for row in found] == expected
    plain = raw_of(spark, STRICT).orderBy("seq").select(strict_json.is_strict_text(F.col("payload")))
    assert [row[0] for row in plain.collect()] == expected


def test_nan_is_refused(spark):
    assert data_of(spark, ['{"fields":{"x":{"value":NaN}}}'])[0].reason == "bad_json"


def test_invalid_utf8_is_refused(spark):
    raw = spark.createDataFrame([(1, bytearray(b'{"a":"\xff"}'))], "seq BIGINT, payload BINARY")
    raw = raw.select("seq", F.lit("t").alias("topic"), F.col("payload").cast("string"),
                     F.lit(None).cast("timestamp_ntz").alias("recv_ts"))
    assert parse(raw).first().reason == "bad_json"


@pytest.mark.parametrize(
    "payload, violations, reason",
    [
        ('{"fields":{"x":{}}}', 0, None),
        ('{"fields":{"x":5,"y":{},"z":null}}', 2, "structure"),
        ('{"fields":{}}', 1, "structure"),
        ('{"fields":null}', 1, "structure"),
        ("{}", 1, "structure"),
        ('{"fields":[1]}', 1, "structure"),
        ("5", 1, "bad_payload_type"),
        ("null", 1, "bad_payload_type"),
        ('"a"', 1, "bad_payload_type"),
        ("[]", 0, "empty_batch"),
        ('[{"fields":{"x":{"value":1}}},7,{}]', 2, "structure"),
        ('[{"fields":{"x":1,"y":2}},null,[],{"fields":{"x":{}}}]', 4, "structure"),
        ('{"Fields":{"x":{}}}', 1, "structure"),
    ],
)
def test_structure(spark, payload, violations, reason):
    row = judge(decode(raw_of(spark, [payload]))).first()
    assert (row.violations, row.reason) == (violations, reason)


def test_missing_and_null_differ(spark):
    cases = [
        (record(timestamp="MISSING"), None),
        (record(timestamp=None), "null_timestamp"),
        (record(timestamp="yesterday"), "bad_timestamp"),
        (record(timestamp=2024), "bad_timestamp"),
        (record(timestamp="2024"), "bad_timestamp"),
        (record(deviceid="MISSING"), None),
        (record(deviceid=None), "null_deviceid"),
        (record(deviceid={"a": 1}), "bad_deviceid"),
        (record(deviceid="{x"), None),
        (record(deviceid=7), None),
        (record(schema="MISSING", table="MISSING"), None),
        (record(schema=None), "bad_route"),
        (record(table=None), "bad_route"),
        (record(table="a b"), "bad_route"),
        (record(table="1a"), "bad_route"),
        (record(schema=True), "bad_route"),
        (record(table="Übung"), None),
    ]
    found = data_of(spark, [json.dumps(case) for case, _ in cases])
    assert [row.reason for row in found] == [reason for _, reason in cases]
    rows = {row.seq: row for row in found}
    assert str(rows[0].rows[0].ts) == "1970-01-01 08:00:00"
    assert rows[5].rows[0].id == "id"
    assert rows[9].rows[0].id == "7"
    assert (rows[10].route_schema, rows[10].route_table) == ("public", "example")
    assert rows[16].route_table == "übung"


def test_column_names(spark):
    cases = [
        ({"αβ": {"value": 1.5, "type": "int"}}, None),
        ({"T": {"value": 1}, "t": {"value": 2}}, "duplicate_column"),
        ({"Timestamp": {"value": 1}}, "duplicate_column"),
        ({"ts_date": {"value": 1}}, "duplicate_column"),
        ({"a b": {"value": 1}}, "bad_column"),
        ({"a`;": {"value": 1}}, "bad_column"),
        ({"1a": {"value": 1}}, "bad_column"),
        ({"": {"value": 1}}, "bad_column"),
    ]
    found = data_of(spark, [json.dumps(record(fields)) for fields, _ in cases])
    assert [row.reason for row in found] == [reason for _, reason in cases]


def test_list_fields_align_by_name(spark):
    same = [record({"a": {"value": 1}, "b": {"value": 2}}), record({"b": {"value": 3}, "a": {"value": 4}})]
    folded = [record({"A": {"value": 1}, "b": {"value": 2}}), record({"a": {"value": 3}, "B": {"value": 4}})]
    lacking = [record({"a": {"value": 1}, "b": {"value": 2}}), record({"a": {"value": 4}})]
    found = data_of(spark, [json.dumps(x) for x in (same, folded, lacking)])
    assert [row.reason for row in found] == [None, None, "field_set_mismatch"]
    wide = flatten.wide(
        flatten.rows(parse(raw_of(spark, [json.dumps(same)])).where("target = 'data'")),
        {"a": "DOUBLE", "b": "DOUBLE"}, Options(), "pos",
    )
    assert [(row.a, row.b) for row in wide.orderBy("pos").collect()] == [(1.0, 2.0), (4.0, 3.0)]


def test_header_of_the_first_element_or_of_each(spark):
    batch = [record(), record(timestamp="2024-02-02 00:00:00", deviceid="e")]
    late_null = [record(), record(timestamp=None)]
    payloads = [json.dumps(batch), json.dumps(late_null)]
    first = data_of(spark, payloads)
    assert [(str(r.ts), r.id) for r in first[0].rows] == [("2024-01-02 03:04:05", "d")] * 2
    assert first[1].reason is None
    own = data_of(spark, payloads, Options(header="record"))
    assert [(str(r.ts), r.id) for r in own[0].rows][1] == ("2024-02-02 00:00:00", "e")
    assert own[1].reason == "null_timestamp"


CELLS = [
    # field, storage of the column, fits, number, text
    ({"value": 65.70, "type": "float"}, "DOUBLE", True, 65.7, None),
    ({"value": 5, "type": "int"}, "DOUBLE", True, 5.0, None),
    ({"value": 5.5, "type": "int"}, "DOUBLE", True, 5.5, None),
    ({"value": "12.5", "type": "float"}, "DOUBLE", True, 12.5, None),
    ({"value": " 12.5 ", "type": "float"}, "DOUBLE", True, 12.5, None),
    ({"value": "65.7d", "type": "float"}, "DOUBLE", False, None, None),
    ({"value": "1e400", "type": "float"}, "DOUBLE", False, None, None),
    ({"value": "-Infinity", "type": "float"}, "DOUBLE", True, float("-inf"), None),
    ({"value": "abc", "type": "float"}, "DOUBLE", False, None, None),
    ({"value": "", "type": "float"}, "DOUBLE", False, None, None),
    ({"value": True, "type": "float"}, "DOUBLE", False, None, None),
    ({"value": [1], "type": "float"}, "DOUBLE", False, None, None),
    ({"value": None, "type": "float"}, "DOUBLE", True, None, None),
    ({"type": "float"}, "DOUBLE", True, None, None),
    ({"value": "x", "type": "str"}, "STRING", True, None, "x"),
    ({"value": 7, "type": "str"}, "STRING", True, None, "7"),
    ({"value": 7.0, "type": "str"}, "STRING", True, None, "7.0"),
    ({"value": 10.0}, "STRING", True, None, "10.0"),
    ({"value": 65.7, "type": "INT"}, "STRING", True, None, "65.7"),
    ({"value": True}, "STRING", True, None, "true"),
    ({"value": {"a": 1}}, "STRING", False, None, '{"a":1}'),
    ({"value": "{a}"}, "STRING", True, None, "{a}"),
    ({"value": None}, "STRING", True, None, None),
    ({}, "STRING", True, None, None),
    ({"value": {"b": [1, None]}, "type": "json"}, "JSON", True, None, '{"b":[1,null]}'),
    ({"value": "s", "type": "json"}, "JSON", True, None, '"s"'),
    ({"value": None, "type": "json"}, "JSON", True, None, "null"),
    ({"type": "json"}, "JSON", True, None, "null"),
    ({"value": '{"a":1}', "type": "str"}, "JSON", True, None, '{"a":1}'),
    ({"value": "{a", "type": "str"}, "JSON", False, None, "{a"),
    ({"value": 5, "type": "int"}, "JSON", False, None, "5"),
    ({"value": 5, "type": "json"}, "DOUBLE", True, 5.0, None),
    ({"value": "5", "type": "json"}, "DOUBLE", False, None, None),
    ({"value": {"a": 1}, "type": "json"}, "STRING", True, None, '{"a":1}'),
]


def test_cells(spark):
    payloads = [json.dumps(record({"x": field})) for field, *_ in CELLS]
    outcomes = parse(raw_of(spark, payloads))
    types = spark.createDataFrame(
        [(number, case[1]) for number, case in enumerate(CELLS)], "seq BIGINT, storage STRING"
    )
    cell = {name: F.col(name) for name in ("column", "tag", "value")}
    found = (
        flatten.cells(flatten.rows(outcomes))
        .join(types, "seq")
        .select(
            "seq",
            cell_rules.fits(cell, F.col("storage")).alias("fits"),
            F.when(F.col("storage") == "DOUBLE", cell_rules.number(F.col("value"))).alias("number"),
            F.when(F.col("storage") != "DOUBLE", F.col("text")).alias("text"),
        )
        .orderBy("seq")
        .collect()
    )
    for case, row in zip(CELLS, found):
        assert (row.fits, row.number, row.text) == case[2:], case
    # The check of an append, with the table's types as literals, decides the same.
    for storage in ("DOUBLE", "STRING", "JSON"):
        fault = coerce.row_fault(F.col("rows"), {"x": storage})
        faults = {row.seq: row.fault for row in outcomes.select("seq", fault.alias("fault")).collect()}
        for number, case in enumerate(CELLS):
            if case[1] == storage:
                assert (faults[number] is None) == case[2], case


def test_repeated_key_keeps_the_last_value(spark):
    outcomes = parse(raw_of(spark, ['{"fields":{"x":{"value":1},"x":{"value":2}}}']))
    assert [row.text for row in flatten.cells(flatten.rows(outcomes)).collect()] == ["2"]


def test_first_writer_sets_the_type(spark):
    payloads = [
        record({"a": {"value": "1", "type": "str"}, "b": {"value": 1, "type": "float"}}),
        record({"A": {"value": 2, "type": "int"}, "b": {"value": "x", "type": "str"}, "c": {"type": "json"}}),
    ]
    outcomes = parse(raw_of(spark, [json.dumps(x) for x in payloads]))
    found = {row.column: row.storage for row in column_dictionary(outcomes).collect()}
    assert found == {"a": "STRING", "b": "DOUBLE", "c": "JSON"}


@pytest.mark.parametrize("sign", ["", "-"])
@pytest.mark.parametrize(
    "number, text",
    [
        ("5.0", "5.0"), ("5", "5"), ("123456789012345678.0", "123456789012345678.0"),
        ("1234567890123456789.0", "1234567890123456789.0"), ("9223372036854775807.0", "9223372036854775807.0"),
        ("123456789012345678", "123456789012345678"), ("9223372036854775809", "9223372036854775809"),
    ],
)
def test_long_numbers_keep_their_text(spark, sign, number, text):
    outcomes = parse(raw_of(spark, [f'{{"fields":{{"x":{{"value":{sign}{number}}}}}}}']))
    assert [row.text for row in flatten.cells(flatten.rows(outcomes)).collect()] == [sign + text]


@pytest.mark.parametrize(
    "spelling, stamp",
    [
        ("2024/01/15 10:00:00", "2024-01-15 10:00:00"), ("20240115 100000", "2024-01-15 10:00:00"),
        ("Jan 15 2024 10:00:00", "2024-01-15 10:00:00"), ("January 5, 2024", "2024-01-05 00:00:00"),
        ("20240115T100000.25", "2024-01-15 10:00:00.25"), ("2024-1-5", "2024-01-05 00:00:00"),
        ("2024", None), ("Foo 15 2024", None), ("2024/13/01", None), ("20241301", None),
    ],
)
def test_spellings_of_timestamps(spark, spelling, stamp):
    row = parse(raw_of(spark, [json.dumps(record(timestamp=spelling))])).first()
    assert row.reason == (None if stamp else "bad_timestamp")
    if stamp:
        assert str(row.rows[0].ts) == str(datetime.datetime.fromisoformat(stamp))


def test_routes_that_cannot_be_stored(spark):
    routes = [("global_temp", "t"), ("s", "t" * 256), ("s" * 253, "t"), ("quarantine", "rejects"), ("s", "t" * 255)]
    rows = parse(raw_of(spark, [json.dumps(record(schema=x, table=y)) for x, y in routes])).orderBy("seq").collect()
    assert [row.reason for row in rows] == ["bad_route"] * 4 + [None]


def test_messages(spark):
    fields = {"message": {"type": "str"}, "level": {"value": None, "type": "int"}, "x": {"value": 1}}
    payload = json.dumps([record(fields), record(fields, timestamp=None), record(fields, deviceid="last")])
    outcomes = parse(raw_of(spark, [payload])).where("target = 'message'").orderBy("pos").collect()
    assert [(row.pos, row.reason) for row in outcomes] == [(0, None), (1, "null_timestamp"), (2, None)]
    cells = {cell.column for cell in outcomes[0].rows[0].cells}
    assert cells == {"message", "level"}
    last = parse(raw_of(spark, [payload]), Options(message_keep="last")).where("target = 'message'")
    assert [row.pos for row in last.collect()] == [2]
    wide = flatten.wide(flatten.rows(last), {"message": "STRING", "level": "DOUBLE"}, Options()).first()
    assert (wide.message, wide.level, wide.deviceid) == ("", None, "last")
    assert parse(raw_of(spark, [payload]), Options(message_switch=False)).count() == 1


def test_a_bad_route_does_not_stop_the_message(spark):
    payload = json.dumps(record({"message": {"value": "m"}}, table=None))
    found = parse(raw_of(spark, [payload])).orderBy("target").collect()
    assert [(row.target, row.reason) for row in found] == [("data", "bad_route"), ("message", None)]


@pytest.mark.parametrize(
    "topic_filter, matching, other",
    [
        ("plant/#", ["plant", "plant/a", "plant/a/b"], ["plants", "x/plant"]),
        ("plant/error/+", ["plant/error/1", "plant/error/"], ["plant/error", "plant/error/1/2"]),
        ("+/0", ["a/0", "/0"], ["a/b/0", "$sys/0"]),
        ("#", ["a", "a/b"], ["$SYS/x"]),
        ("a.b", ["a.b"], ["axb"]),
    ],
)
def test_topic_filters(spark, topic_filter, matching, other):
    topics = spark.createDataFrame([(t,) for t in matching + other], "topic STRING")
    found = topics.where(F.col("topic").rlike(topic_regex(topic_filter))).collect()
    assert sorted(row.topic for row in found) == sorted(matching)


def test_malformed_topic_filter():
    for wrong in ("a/#/b", "a#", "a/b+"):
        with pytest.raises(ValueError):
            topic_regex(wrong)
