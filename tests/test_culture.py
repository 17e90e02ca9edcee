"""Date text in the forms of the source systems."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrail.functions import dates
from casetrail.functions.culture import FORMS, written_instant
from casetrail.operators.shape import convert_types

DAY = datetime(2020, 1, 5)
READ = {
    "2020-01-05": DAY, "2020/1/5": DAY, "2020.01.05": DAY, "20200105": DAY, "1/5/2020": DAY, "01-05-20": DAY,
    "1.5.2020": DAY, "Jan 5 2020": DAY, "Jan  5 2020 12:00AM": DAY, "January 5, 2020": DAY, "JAN. 5,2020": DAY,
    "5 Jan 2020": DAY, "5-JAN-20": DAY, "5th January, 2020": DAY, "2020 Jan 5": DAY, "2020-jan-05": DAY,
    "Sunday, January 5, 2020": DAY, "Sun 5 Jan 2020": DAY, "January 2020": datetime(2020, 1, 1),
    "Sept 9, 1999": datetime(1999, 9, 9), "9-sep-50": datetime(1950, 9, 9), "9-sep-49": datetime(2049, 9, 9),
    "may 1 2021": datetime(2021, 5, 1), "12/31/2020": datetime(2020, 12, 31), "29 feb 2020": datetime(2020, 2, 29),
    "Jan 5 2020 3:04PM": datetime(2020, 1, 5, 15, 4), "1/5/2020 3:04:05 p.m.": datetime(2020, 1, 5, 15, 4, 5),
    "1/5/2020 12:04 am": datetime(2020, 1, 5, 0, 4), "1/5/2020 12 PM": datetime(2020, 1, 5, 12),
    "1/5/2020, 4am": datetime(2020, 1, 5, 4), "20200105 14:30": datetime(2020, 1, 5, 14, 30),
    "2020/1/5T4:05:06.7": datetime(2020, 1, 5, 4, 5, 6, 700000),
    "Jan 5 2020 01:02:03:045PM": datetime(2020, 1, 5, 13, 2, 3, 45000),
    "2020-01-05T06:07:08Z": datetime(2020, 1, 5, 6, 7, 8), " 2020-01-05 06:07 ": datetime(2020, 1, 5, 6, 7),
    "2020-01-05T06:07:08-08:00": datetime(2020, 1, 5, 14, 7, 8),
}
UNREAD = [None, "", " ", "soon", "2020", "2020-01", "10:30", "4 pm", "5", "2020-13-45", "30 feb 2020", "29 feb 2021",
          "13/5/2020", "1/5", "1-5/2020", "1/5/2020 25:00", "1/5/2020 13:00 pm", "1/5/2020 0 am", "1/5/2020 4", "5 jam 2020",
          "1/5/202", "12345678901", "2020|1|5", "jan 5 2020 1:2", "1/5/2020 10:61", "20oct|12|05", "~", "1/5/2020~"]


def read(spark, values, **options):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["t"] for r in rows.orderBy("i").select(dates.read_instant(F.col("v"), **options).alias("t")).collect()]


def test_forms(spark):
    assert dict(zip(READ, read(spark, READ), strict=True)) == READ
    assert [v for v, t in zip(UNREAD, read(spark, UNREAD), strict=True) if t is not None] == []


def test_which_number_is_the_month(spark):
    given = ["3/4/2020", "25/12/2020", "12/25/2020", "2020/3/4", "March 4 2020"]
    march, april = datetime(2020, 3, 4), datetime(2020, 4, 3)
    assert read(spark, given) == [march, None, datetime(2020, 12, 25), march, march]
    assert read(spark, given, day_first=True) == [april, datetime(2020, 12, 25), None, march, march]


@pytest.mark.parametrize("form", range(len(FORMS)))
def test_no_form_reads_what_another_has_read(form):
    """Replacements follow one another, so none may match a day that is already in parts."""
    import re

    for parts in ("2020|1|5~", "20|1|05~", "2020|jan|5~10:30", "20|12|31~"):
        assert not re.search(FORMS[form].pattern(), parts)


def test_staging_conversions_read_them(spark):
    rows = spark.createDataFrame([("Jan 5 2020 3:04:05.600 PM",), ("10:30",), ("5-jan-2020",)], "d string")
    rounded = [r[0] for r in rows.select(dates.to_second(F.col("d"))).collect()]
    assert rounded == [datetime(2020, 1, 5, 15, 4, 6), None, DAY]
    typed = convert_types(rows, {"d": "timestamp_ntz"})
    assert isinstance(typed.schema["d"].dataType, T.TimestampNTZType)
    assert [r["d"] for r in typed.collect()] == [datetime(2020, 1, 5, 15, 4, 5, 600000), None, DAY]


def test_one_expression_without_a_shuffle_or_python(spark):
    plan = spark.range(3).select(written_instant(F.col("id").cast("string")))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "*(1)" in plan
