"""Edge values of the scalar functions."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrail.functions import dates, numbers, text


def apply(spark, make, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    dtype = df.schema["v"].dataType
    rows = df.select("i", make(F.col("v"), dtype).alias("r")).collect()
    return [r["r"] for r in sorted(rows)]


def test_nullish(spark):
    values = [None, "", "  ", "\t\n", " ", "null", " NULL ", "NaT", "nan", "none", "0"]
    assert apply(spark, text.is_nullish, values) == [True] * 8 + [False] * 3


def test_blank_keeps_the_words(spark):
    assert apply(spark, text.is_blank, [None, "\t ", "null"]) == [True, True, False]


KEYS = ["12", "12.0", "12.000", "1,234", " 12 ", "1.0.5", "12.50", "", "null", "\t7.\n", ".0", None]


def test_staged_key(spark):
    expected = ["12", "12", "12", "1234", "12", "1", "12.50", None, "null", "7", None, None]
    assert apply(spark, text.staged_key, KEYS) == expected


def test_hold_key(spark):
    expected = ["12", "12", "12", "1234", "12", "1.0.5", "12.50", None, None, "7", None, None]
    assert apply(spark, text.hold_key, KEYS) == expected


@pytest.mark.parametrize("make", [text.staged_key, text.hold_key, text.key_text])
def test_numeric_keys_have_no_exponent(spark, make):
    big = apply(spark, make, [123456789.0, None], "double")
    assert big[1] is None
    assert big[0] == "123456789"
    if make is not text.key_text:
        assert apply(spark, make, [Decimal(12)], "decimal(38,18)") == ["12"]
    assert apply(spark, make, [1234567890123456789], "bigint") == ["1234567890123456789"]


def test_number_text(spark):
    assert apply(spark, text.number_text, [12.0, 12.5, -3.25, 0.0, 1e15], "double") == [
        "12", "12.5", "-3.25", "0", "1000000000000000"
    ]


def test_doubles_out_of_reach_do_not_fail(spark):
    values = [1e300, float("nan"), float("inf"), None]
    for make in (text.number_text, text.attribute_text, text.hold_key, numbers.to_number, numbers.whole_number_text):
        assert len(apply(spark, make, values, "double")) == len(values)


def test_attribute_text(spark):
    assert apply(spark, text.attribute_text, [12.0, 0.5], "double") == ["12.0", "0.5"]
    assert apply(spark, text.attribute_text, [True, False, None], "boolean") == ["True", "False", None]
    stamps = [datetime(2020, 1, 1, 5, 0, 7), datetime(2020, 1, 1, 5, 0, 7, 500000)]
    assert apply(spark, text.attribute_text, stamps, "timestamp_ntz") == [
        "2020-01-01 05:00:07", "2020-01-01 05:00:07.500000"
    ]


def test_numbers(spark):
    got = apply(spark, numbers.to_number, ["1,234", " 5 ", "1e3", "12d", "x", "", None])
    assert got == [Decimal(1234), Decimal(5), Decimal(1000), None, None, None, None]
    assert apply(spark, lambda c, _: numbers.to_bigint(c), [" 12 ", "12.0", "x", "", None]) == [12, None, None, None, None]


def test_record_ids(spark):
    values = ["007", "12.9", "-3.7", "1e3", "AB1", None, "1234567890123456789", " 5 ", "-0.5", "nan"]
    expected = ["7", "12", "-3", "1000", None, None, "1234567890123456789", "5", "0", None]
    assert apply(spark, numbers.whole_number_text, values) == expected
    assert apply(spark, numbers.whole_number_text, [Decimal(12)], "decimal(38,18)") == ["12"]


def test_truncated(spark):
    got = apply(spark, lambda c, _: numbers.truncated(c, "int"), [1.9, -1.9, 5e12, None], "double")
    assert got == [1, -1, None, None]


def test_sentinel_dates(spark):
    values = [datetime(1900, 1, 1), datetime(1900, 1, 1, 10), datetime(1582, 10, 14), datetime(1899, 12, 31), None]
    got = apply(spark, dates.clean_sentinel, values, "timestamp_ntz")
    assert got == [None, datetime(1900, 1, 1, 10), None, datetime(1899, 12, 31), None]
    assert apply(spark, dates.clean_sentinel, [date(1900, 1, 1), date(1900, 1, 2)], "date") == [None, date(1900, 1, 2)]


def test_time_only(spark):
    values = ["10:30", "10:30, 5", "2020-01-01 10:30", "T10:30", "10/30:1", "abc"]
    assert apply(spark, lambda c, _: dates.is_time_only(c), values) == [True, False, False, False, False, False]


TIMES = [
    "2020-01-01", "2020-13-45", "2020-01-01 05:00:00.999", "2020-01-01T05:00:00-08:00", "2020-01-01T05:00:00Z",
    "2020-01-01Z", "2020-01-01T05", "1899-12-31", "1899-12-31T05:00:00", "05:00:00", "T05:00", "2020", "2020-1-1",
    "2020-01-01T05:00:60", "2020-02-30T01:00:00", " 2020-01-01 ", "null", "", None, "2020-01-01T25:00:00", "soon",
    "1900-01-01T00:00:00+08:00",
]


def test_event_datetime(spark):
    day = "2020-01-01T"
    expected = [
        day + "00:00:00Z", "2020-13-45T00:00:00Z", day + "05:00:00Z", day + "13:00:00Z", day + "05:00:00Z",
        day + "00:00:00Z", day + "05:00:00Z", None, None, None, None, None, None, None, None, day + "00:00:00Z",
        None, None, None, None, None, "1899-12-31T16:00:00Z",
    ]
    assert apply(spark, dates.event_datetime, TIMES) == expected


def test_event_date(spark):
    expected = [
        "2020-01-01", None, "2020-01-01", "2020-01-01", "2020-01-01", "2020-01-01", "2020-01-01", None, None, None,
        None, None, None, "2020-01-01", None, "2020-01-01", None, None, None, "2020-01-01", None, "1900-01-01",
    ]
    assert apply(spark, dates.event_date, TIMES) == expected


def test_event_times_of_timestamps(spark):
    stamps = [datetime(2020, 1, 1, 5, 0, 0, 999999), datetime(1899, 12, 31, 23), None]
    assert apply(spark, dates.event_datetime, stamps, "timestamp") == ["2020-01-01T05:00:00Z", None, None]
    assert apply(spark, dates.event_date, [date(2020, 1, 1), None], "date") == ["2020-01-01", None]
    assert apply(spark, dates.event_datetime, [date(2020, 1, 1)], "date") == ["2020-01-01T00:00:00Z"]


def test_to_second_rounds(spark):
    got = apply(spark, dates.to_second, ["2020-01-01 05:00:00.500", "05:00", "2020", None])
    assert got == [datetime(2020, 1, 1, 5, 0, 1), None, None, None]


def test_first_present(spark):
    df = spark.createDataFrame([(" ", None, "c"), (" a ", "b", "c")], "x string, y string, z string")
    got = df.select(text.first_present([F.col("x"), F.col("y"), F.col("z")]).alias("r")).collect()
    assert [r["r"] for r in got] == ["c", "a"]


def test_display_name():
    assert text.display_name("A-B_DON'T_3RD") == "A-B Don'T 3Rd"


def test_status_guard(spark):
    assert apply(spark, text.status_guard, [None, "  ", " CA "]) == ["OK", "OK", " CA "]


def test_numeric_types_are_known():
    assert dates.is_instant(T.TimestampNTZType())
