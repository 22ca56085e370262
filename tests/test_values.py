"""Scalar rules on edge values."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lodestone.functions import values as V
from lodestone.functions.source import error_class, region_from_host
from pyspark.sql import functions as F


def one(frame, kind, value, rule):
    df = frame(f"x {kind}", (value,))
    return df.select(rule(df).alias("y")).first().y


@pytest.mark.parametrize(
    ("kind", "value", "expected"),
    [
        ("string", None, None),
        ("bigint", 1_525_400_000_123, 1_525_400_000_123),
        ("double", 12.9, 12),
        ("double", float("nan"), None),
        ("string", "2018-05-04T00:00:00Z", 1_525_392_000_000),
        ("string", "2018-05-04 00:00:00", 1_525_392_000_000),
        ("string", "some day", None),
        ("timestamp_ntz", dt.datetime(2018, 5, 4), 1_525_392_000_000),
        ("date", dt.date(2018, 5, 4), 1_525_392_000_000),
        ("array<int>", [1, 2], None),
    ],
)
def test_epoch_ms(frame, kind, value, expected):
    assert one(frame, kind, value, lambda df: V.epoch_ms(df, "x")) == expected


TEXTS = {
    "20180504": 1_525_392_000_000, "4 May 2018": 1_525_392_000_000, "05/04/2018": 1_525_392_000_000, "May 4, 2018 06:30": 1_525_415_400_000,
    "2018-05-04T06:30:15.25": 1_525_415_415_250, "2018-05-04 06:30:15+02:00": 1_525_408_215_000, "2018-05-04 06:30:15 Asia/Tokyo": 1_525_383_015_000,
    "1969-12-31 23:59:59.5": -500, "2018-13-45": None, "": None, "123456789012": None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epochs_do_not_depend_on_the_session(spark, conf, frame, zone):
    conf(spark__sql__session__timeZone=zone)
    df = frame("x string", *((t,) for t in TEXTS))
    assert {r.x: r.y for r in df.select("x", V.epoch_ms(df, "x").alias("y")).collect()} == TEXTS
    # At 02:30 clocks went forward in New York that day.
    assert one(frame, "timestamp_ntz", dt.datetime(2021, 3, 14, 2, 30), lambda df: V.epoch_ms(df, "x")) == 1_615_689_000_000
    assert one(frame, "date", dt.date(2018, 5, 4), lambda df: V.epoch_ms(df, "x")) == 1_525_392_000_000


def test_epoch_zero_is_unset(frame):
    assert one(frame, "bigint", 0, lambda df: V.when_set(V.epoch_ms(df, "x"))) is None


@pytest.mark.parametrize(
    ("kind", "value", "expected"),
    [
        ("double", 4194304.0, "4194304"),
        ("double", 2.5, "2.5"),
        ("double", 1e20, "100000000000000000000"),
        ("double", -(2.0**70), "-1180591620717411303424"),
        ("double", float("nan"), ""),
        ("double", float("-inf"), ""),
        ("double", None, ""),
        ("bigint", 7, "7"),
        ("string", "a", "a"),
        ("string", None, ""),
    ],
)
def test_safe_str(frame, kind, value, expected):
    assert one(frame, kind, value, lambda df: V.safe_str(df, "x")) == expected


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(numbers=st.lists(st.floats(allow_nan=True, allow_infinity=True), min_size=200, max_size=300))
def test_no_float_survives_as_nan_or_infinity(spark, numbers):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    rows = df.select("i", V.finite_or_null(df, "x").alias("f"), V.coerce_numeric(df, "x").alias("c"), V.safe_str(df, "x").alias("s"))
    for row in rows.collect():
        x = numbers[row.i]
        finite = x == x and abs(x) != float("inf")
        assert row.f == (x if finite else None) and row.c == (x if finite else 0)
        assert (row.s == "") == (not finite)
        if finite and x.is_integer() and abs(x) < 2**115:
            assert row.s == str(int(x))


def test_absent_column_is_not_null_column(frame):
    df = frame("a string", (None,))
    assert df.select(V.col_or(df, ("b", "a"), "d").alias("y")).first().y is None
    assert df.select(V.col_or(df, "b", "d").alias("y")).first().y == "d"


@pytest.mark.parametrize(
    ("host", "region"),
    [
        ("pier7.k9x2.eu-north-1.rds.amazonaws.com", "eu-north-1"),
        ("localhost", None),
        (None, None),
        ("", None),
    ],
)
def test_region(frame, host, region):
    assert one(frame, "string", host, lambda df: region_from_host(F.col("x"))) == region


@pytest.mark.parametrize(
    ("errno", "expected"),
    [(1040, "connection_limit"), (1203, "connection_limit"), (1226, "connection_limit"), (1053, "server_restart"),
     (2006, "server_restart"), (2013, "server_restart"), (1045, "definitive"), (None, "definitive")],
)
def test_error_class(frame, errno, expected):
    assert one(frame, "int", errno, lambda df: error_class(F.col("x"))) == expected


DAYS = ("20180504", "4 May 2018", "14 Sep 2018", "4 September 2018", "04 Sept 2018", "May 4, 2018", "Sep 04, 2018", "September 4, 2018", "JUNE 4, 2018",
        "5/4/2018", "05/04/2018", "13/4/2018", "2018/5/4", "2018/05/04", "12018/5/4", "201/5/4", "2018", "2018-05", "2018-5-4", "+2018-05-04", "12345",
        "123456789", "0020180504", "Mai 4, 2018", "4 5 2018", "4. May 2018", "day", "")
CLOCKS = ("", " 06:30", " 06:30:15", " 6:30", "T06:30:15", " 06:30:15.25", " 25:00", " 06:30:15Z", " 06:30:15+02:00", " 06:30 UTC", "\t06:30", ":")


def test_each_text_is_parsed_as_the_first_form_that_fits(frame):
    """One parse a text, chosen by how it begins, gives what trying every form gives."""
    texts = [f"{space}{day}{clock}{space}" for day in DAYS for clock in CLOCKS for space in ("", " ")]
    c = F.col("x")
    every = [
        F.unix_micros(F.try_to_timestamp(F.concat(F.trim(c), F.lit(" +00:00")), F.lit(f"{date}{time} XXX")))
        for date in ("yyyyMMdd", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "M/d/yyyy", "yyyy/M/d")
        for time in ("", " HH:mm", " HH:mm:ss")
    ]
    zoned = F.when(F.rlike(c, F.lit(V.ZONED)), F.unix_micros(c.try_cast("timestamp")))
    standard = F.when(~F.rlike(c, F.lit(r"^\s*\d{5,}\s*$")), V._naive_micros(c.try_cast("timestamp_ntz")))
    tried = F.call_function("div", F.coalesce(zoned, standard, *every), F.lit(1000))
    df = frame("x string", *((t,) for t in texts))
    rows = df.select("x", V.epoch_ms(df, "x").alias("found"), tried.alias("tried")).collect()
    assert {r.x: r.found for r in rows} == {r.x: r.tried for r in rows}
    assert sum(r.found is not None for r in rows) > 100
