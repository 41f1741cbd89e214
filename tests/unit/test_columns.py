import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions import columns as C
from eventloom.functions import times


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_strip_zeros(spark):
    assert column(spark, ["01", "1.0", "1.5", "x", None, "000", "-07", "inf", ""], C.strip_zeros) == ["1", "1", None, None, None, "0", "-7", None, None]


def test_to_number_takes_only_numbers(spark):
    got = column(spark, ["1", " 2.5 ", "1e3", "1.0f", "5d", "<25", ".5", "-3.", None, "inf", "0x1"], C.to_number)
    assert got == [1.0, 2.5, 1000.0, None, None, None, 0.5, -3.0, None, float("inf"), None]


def test_value_map_pad_prefix(spark):
    assert column(spark, ["a", "z", None], lambda c: C.from_value_map(c, {"a": "b"})) == ["b", None, None]
    assert column(spark, ["a"], lambda c: C.from_value_map(c, {})) == [None]
    assert column(spark, ["2020-01-02", "2020-01-02T10:00:00", None], lambda c: C.pad_suffix(c, "T00:00:00", ":")) == ["2020-01-02T00:00:00", "2020-01-02T10:00:00", None]
    assert column(spark, ["ab", "b"], lambda c: C.pad_suffix(c, "a")) == ["ab", "ba"]
    assert column(spark, ["x", None], lambda c: C.prefixed(c, "D/")) == ["D/x", None]
    assert column(spark, ["x", None], lambda c: C.prefixed(c, "D/", "nan")) == ["D/x", "D/nan"]


def test_fills(spark):
    df = spark.createDataFrame([(None, "ab12"), ("k", "ab12"), (None, "none")], "a string, b string")
    assert [r[0] for r in df.select(C.fill_from_regex(F.col("a"), F.col("b"), r"(\d+)")).collect()] == ["12", "k", None]


@pytest.mark.parametrize(
    ("form", "text", "expected"),
    [
        ("%Y-%m-%d", "2020-02-29", dt.datetime(2020, 2, 29)),
        ("%Y-%m-%d", "2021-02-29", None),
        ("%d%b%Y", "03mar2021", dt.datetime(2021, 3, 3)),
        ("%d%b%Y", "03xyz2021", None),
        ("%d/%m/%Y %H:%M", "1/2/2020 23:59", dt.datetime(2020, 2, 1, 23, 59)),
        ("%Y-%m-%d %H:%M:%S.%f", "2020-01-01 00:00:00.5", dt.datetime(2020, 1, 1, 0, 0, 0, 500000)),
        ("%Y-%m-%d %H:%M:%S", "2020-03-29 02:30:00", dt.datetime(2020, 3, 29, 2, 30)),
        ("%d%m%Y", "01022020", dt.datetime(2020, 2, 1)),
        ("%Y-%m-%d", None, None),
    ],
)
def test_parse_time(spark, form, text, expected):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Copenhagen")
    try:
        assert column(spark, [text], lambda c: times.parse_time(c, [form])) == [expected]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_unknown_directive():
    with pytest.raises(ValueError, match="%q"):
        times.time_pattern("%q")


def test_combine(spark):
    df = spark.createDataFrame([("2020-01-02", "10:11:12"), ("2020-01-02", None), (None, "10:11:12"), ("2020-01-02", "soon")], "d string, t string")
    assert [r[0] for r in df.select(times.combine_date_time(F.col("d"), F.col("t"))).collect()] == [dt.datetime(2020, 1, 2, 10, 11, 12), None, None, None]
    parts = spark.createDataFrame([("9.7", "5"), (None, None), ("24", "0"), ("-1", "0"), ("100", "0")], "h string, m string")
    day = F.lit("2020-01-02")
    assert [r[0] for r in parts.select(times.combine_parts(day, F.col("h"), F.col("m"))).collect()] == [dt.datetime(2020, 1, 2, 9, 5), dt.datetime(2020, 1, 2), None, None, None]
    stamp = spark.createDataFrame([(dt.datetime(2020, 1, 2, 8, 0), "09:00:00")], "d timestamp_ntz, t string")
    assert stamp.select(times.combine_date_time(F.col("d"), F.col("t"), kind=T.TimestampNTZType())).first()[0] == dt.datetime(2020, 1, 2, 9)


def test_align(spark):
    assert column(spark, ["2020-01-01 00:00:00.5", "2020-01-01", "x"], times.align_time) == ["2020-01-01 00:00:00.500000", "2020-01-01 00:00:00.000000", None]


def test_weeks_and_gestation(spark):
    assert column(spark, ["2001", "2053", "2054", "abcd", None], C.week_start) == [dt.date(2019, 12, 30), dt.date(2020, 12, 28), None, None, None]
    assert column(spark, ["39 4/7", "39 7/7", "x", None], C.gestation_days) == [277, None, None, None]


def test_formats_and_hours(spark):
    data = ["2021-01-02 03:04:05.5", "2021-1-2 3:4:5", "2021-01-02T03:04:05", "2021-01-02", " 2021-01-02 ", "02/01/2021 03.04.05", "2-Jan-2021", "2-jan-2021 23:59", "31-Feb-2021", "2021-13-01", "2021-01-02 24:00:00", "2021", "x", "", None, "03:04", "2021-03-28 02:30:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(data)], "i int, t string")
    formats = [*times.ISO, "%d/%m/%Y %H.%M.%S", "%d-%b-%Y", "%d-%b-%Y %H:%M", "%H:%M"]
    for zone in ("UTC", "Europe/Copenhagen"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = [r.x and r.x[:21] for r in df.select("i", times.align_time(F.col("t"), formats).alias("x")).orderBy("i").collect()]
        assert got == [
            "2021-01-02 03:04:05.5", "2021-01-02 03:04:05.0", "2021-01-02 03:04:05.0", "2021-01-02 00:00:00.0", "2021-01-02 00:00:00.0", "2021-01-02 03:04:05.0", "2021-01-02 00:00:00.0", "2021-01-02 23:59:00.0",
            None, None, None, None, None, None, None, "1900-01-01 03:04:00.0", "2021-03-28 02:30:00.0",
        ]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    hours = spark.createDataFrame([("5d",), ("1.0f",), ("9.7",), (None,), ("7",), ("-1",)], "h string")
    assert [r.x for r in hours.select(times.clock_part(F.col("h")).alias("x")).collect()] == ["00", "00", "09", "00", "07", "-1"]
