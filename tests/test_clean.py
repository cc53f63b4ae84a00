from __future__ import annotations

import datetime

import pytest

from skyledger.operators.clean import clean_messages, parse_messages

LINES = [
    '{"StationId":"EZE00100082","Date":19870101,"Variable":"TMAX","Value":12}',
    '{"StationId":"EZE00100082","Date":19870101,"Variable":"TMAX","Value":13,"Q_Flag":"X"}',
    "garbage",
    "",
    '{"StationId":"EZE00100082","Date":20010230,"Variable":"TMIN","Value":-5}',
    '{"StationId":"EZE00100082","Date":1987011,"Variable":"TMIN","Value":-6}',
    '{"StationId":"EZE00100082","Date":19870102,"Variable":"PRCP","Value":null}',
    '{"StationId":"EZE00100082","Date":19870103,"Variable":"WSF2","Value":4,"M_Flag":"T","ObsTime":"0700"}',
    '{"Date":19870103,"Variable":"TMAX","Value":4}',
    '{"StationId":"EZE00100082","Date":19870103,"Value":4}',
    '{"StationId":"EZE0010',
]


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_edge_rows(spark, kind):
    messages = spark.createDataFrame([(line,) for line in LINES], "value string")
    messages = messages.withColumn("value", messages.value.cast(kind))
    rows = {tuple(r) for r in clean_messages(messages).collect()}
    day = datetime.date
    assert rows == {
        ("EZE00100082", day(1987, 1, 1), "TMAX", 12),
        ("EZE00100082", None, "TMIN", -5),
        ("EZE00100082", None, "TMIN", -6),
        ("EZE00100082", day(1987, 1, 2), "PRCP", None),
        ("EZE00100082", day(1987, 1, 3), "WSF2", 4),
    }


def test_parse_keeps_all_fields(spark):
    messages = spark.createDataFrame([(LINES[7],)], "value string")
    row = parse_messages(messages).first()
    assert row.asDict() == {
        "StationId": "EZE00100082", "Date": 19870103, "Variable": "WSF2", "Value": 4,
        "M_Flag": "T", "Q_Flag": None, "S_Flag": None, "ObsTime": "0700",
    }
