"""JSON messages to rows: every shape a message can have."""

from __future__ import annotations

import datetime

import pytest

from blotter.functions.messages import decode_value, flatten, rejects, to_json_value, valid_records
from blotter.plans.ingest import unique_records
from blotter.schemas import schema_of

RECORD = schema_of("id string\nn int\nd double\nt timestamp")
EVENT = schema_of("id int\nname string")


def flat(spark, texts, schema=RECORD):
    rows = [(0, i, t) for i, t in enumerate(texts)]
    return flatten(spark.createDataFrame(rows, "part int, off bigint, raw string"), schema, "id")


@pytest.mark.parametrize(
    ("text", "ids", "reasons"),
    [
        ('{"id":"A1","n":1}', ["A1"], []),
        ('[{"id":"A1"},{"id":"A2"}]', ["A1", "A2"], []),
        (' \n [{"id":"A1"}, 5]', ["A1"], ["element_not_object"]),
        ('[{"id":"A1"},"s",null,[1]]', ["A1"], ["element_not_object"] * 3),
        ("7", [], ["unsupported_top_level"]),
        ('"s"', [], ["unsupported_top_level"]),
        ("null", [], ["unsupported_top_level"]),
        ("{bad", [], ["parse_error"]),
        ("", [], ["parse_error"]),
        (None, [], ["parse_error"]),
        ('{"id":"a","id":"b"}', [], ["parse_error"]),
        ('{"id":NaN}', [], ["parse_error"]),
        ("[]", [], []),
        ('{"n":1}', [], ["missing_key"]),
        ('[{"id":""},{"id":0},{"id":0.0},{"id":false},{"id":null}]', [], ["missing_key"] * 5),
        ('[{"id":"0"},{"id":true},{"id":7}]', ["0", "true", "7"], []),
        ('[{"id":{"a":1}},{"id":[1]},{"id":"B"}]', ["B"], ["bad_key"] * 2),
    ],
)
def test_shapes(spark, text, ids, reasons):
    made = flat(spark, [text])
    assert [r.id for r in valid_records(made).orderBy("pos").collect()] == ids
    assert [r.reason for r in rejects(made).orderBy("pos").collect()] == reasons


def test_integer_key(spark):
    made = flat(spark, ['[{"id":5},{"id":"6"},{"id":"7.0"},{"id":"x"},{"id":0}]'], EVENT)
    assert [r.id for r in valid_records(made).orderBy("pos").collect()] == [5, 6, 7]
    assert [r.reason for r in rejects(made).orderBy("pos").collect()] == ["bad_key", "missing_key"]


def test_fields_are_typed_or_null(spark):
    row = valid_records(
        flat(spark, ['{"id":"A","n":12.7,"d":"3.5","t":"2024-01-01T10:00:00.000","other":1}'])
    ).first()
    assert (row.n, row.d, row.t) == (12, 3.5, datetime.datetime(2024, 1, 1, 10))
    row = valid_records(flat(spark, ['{"id":"A","n":"x","d":{"a":1},"t":"soon"}'])).first()
    assert (row.n, row.d, row.t) == (None, None, None)


def test_reject_keeps_its_own_text(spark):
    made = rejects(flat(spark, ["{bad", '[{"n":1},{"id":"ok"}]']))
    assert [r.raw for r in made.orderBy("off").collect()] == ["{bad", '{"n":1}']


def test_last_arrival_wins(spark):
    texts = ['{"id":"A","n":1}', '[{"id":"A","n":2},{"id":"A","n":3}]', '{"id":"B","n":4}']
    rows = unique_records(flat(spark, texts), RECORD, "id").orderBy("id").collect()
    assert [(r.id, r.n) for r in rows] == [("A", 3), ("B", 4)]
    assert rows[0].__fields__ == RECORD.names


def test_bytes_round_trip(spark):
    df = spark.createDataFrame([(1, None, "é")], "a int, b string, c string")
    value = to_json_value(df)
    assert value.first().value == '{"a":1,"c":"é"}'
    raw = decode_value(value.selectExpr("cast(value as binary) as value"))
    assert raw.first().raw == '{"a":1,"c":"é"}'
