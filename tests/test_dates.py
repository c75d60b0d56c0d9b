import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsloom.functions.dates import parse_date, translate_layout

CASES = [
    ("2 January 2006", "{DAY_NUM} {MONTH_LONG} {YEAR_LONG}", "2006-01-02"),
    ("01/02/2006", "{MONTH_NUM}/{DAY_NUM}/{YEAR_LONG}", "2006-01-02"),
    ("2 JANUARY 2006", "{DAY_NUM} {MONTH_LONG} {YEAR_LONG}", "2006-01-02"),
    (
        "Mon, 02 jan 06 15:04:05.123 +2300",
        "{DAY_SHORT}, {DAY_NUM} {MONTH_SHORT} {YEAR_SHORT} {HOURS}:{MINUTES}:{SECONDS} {ZONE_OFFSET}",
        "2006-01-02",
    ),
    ("2006-01-02T23:59:59-1100", "{YEAR_LONG}-{MONTH_NUM}-{DAY_NUM}T{HOURS}:{MINUTES}:{SECONDS}{ZONE_OFFSET}", "2006-01-02"),
    ("31 February 2006", "{DAY_NUM} {MONTH_LONG} {YEAR_LONG}", None),
    ("29 February 2024", "{DAY_NUM} {MONTH_LONG} {YEAR_LONG}", "2024-02-29"),
    ("2 May 99 CEST", "{DAY_NUM} {MONTH_LONG} {YEAR_SHORT} {ZONE_ABBREV}", "1999-05-02"),
    ("2 May 69", "{DAY_NUM} {MONTH_LONG} {YEAR_SHORT}", "1969-05-02"),
    ("2 May 68", "{DAY_NUM} {MONTH_LONG} {YEAR_SHORT}", "2068-05-02"),
    ("2006", "{YEAR_LONG}", "2006-01-01"),
    ("hello", "{YEAR_LONG}", None),
    ("", "{YEAR_LONG}", None),
    ("2 Jan 2006 24:00", "{DAY_NUM} {MONTH_SHORT} {YEAR_LONG} {HOURS}:{MINUTES}", None),
    ("2 Jan 2006 9:05", "{DAY_NUM} {MONTH_SHORT} {YEAR_LONG} {HOURS}:{MINUTES}", "2006-01-02"),
    ("2 Jan 2006 9:5", "{DAY_NUM} {MONTH_SHORT} {YEAR_LONG} {HOURS}:{MINUTES}", None),
    ("2 Jan 2006 3:60", "{DAY_NUM} {MONTH_SHORT} {YEAR_LONG} {HOURS}:{MINUTES}", None),
    ("2 Jan 2006 3:10:60", "{DAY_NUM} {MONTH_SHORT} {YEAR_LONG} {HOURS}:{MINUTES}:{SECONDS}", None),
    ("2 Jan 2006\r", "{DAY_NUM} {MONTH_SHORT} {YEAR_LONG}", None),
    ("Jan   2 2006", "{MONTH_SHORT} {DAY_NUM} {YEAR_LONG}", "2006-01-02"),
    ("0 Jan 2006", "{DAY_NUM} {MONTH_SHORT} {YEAR_LONG}", None),
    ("111 2006", "{DAY_NUM}{MONTH_NUM} {YEAR_LONG}", "2006-01-11"),
    ("1.2.2006 $1 (x)", "{DAY_NUM}.{MONTH_NUM}.{YEAR_LONG} $1 (x)", "2006-02-01"),
    ("1a2a2006", "{DAY_NUM}.{MONTH_NUM}.{YEAR_LONG}", None),
    ("3 Jan 2 Jan 2006", "{DAY_NUM} {MONTH_SHORT} {DAY_NUM} {MONTH_SHORT} {YEAR_LONG}", "2006-01-02"),
    ("{NOT_ONE} 2006", "{NOT_ONE} {YEAR_LONG}", "2006-01-01"),
]


def parse(spark, cases):
    rows = []
    for text, layout in cases:
        known = translate_layout(layout)
        rows.append((text, layout, known.pattern, known.rewrite))
    frame = spark.createDataFrame(rows, "text string, layout string, p string, r string")
    parsed = frame.select("text", "layout", parse_date(F.col("text"), F.col("p"), F.col("r")).alias("d"))
    return {(r.text, r.layout): r.d for r in parsed.collect()}


def test_layouts(spark):
    got = parse(spark, [(text, layout) for text, layout, _ in CASES])
    for text, layout, expected in CASES:
        day = expected and datetime.date.fromisoformat(expected)
        assert got[text, layout] == day, (text, layout)


def test_layout_without_year_needs_a_default():
    layout = "{DAY_LONG} {DAY_NUM} {MONTH_LONG} at {HOURS}:{MINUTES}"
    with pytest.raises(ValueError):
        translate_layout(layout)
    assert translate_layout(layout, default_year=2006)


def test_default_year_is_used(spark):
    known = translate_layout("{DAY_LONG} {DAY_NUM} {MONTH_LONG} at {HOURS}:{MINUTES}", 2006)
    frame = spark.createDataFrame([("Monday 2 January at 15:04",)], "t string")
    got = frame.select(parse_date(F.col("t"), F.lit(known.pattern), F.lit(known.rewrite))).first()[0]
    assert got == datetime.date(2006, 1, 2)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dates(datetime.date(1000, 1, 1), datetime.date(9999, 12, 31)), min_size=30, max_size=60))
def test_printed_dates_come_back(spark, days):
    long = "{DAY_LONG}, {DAY_NUM} {MONTH_LONG} {YEAR_LONG}"
    iso = "{YEAR_LONG}-{MONTH_NUM}-{DAY_NUM}"
    cases = [(d.strftime("%A, ") + f"{d.day} " + d.strftime("%B ") + f"{d.year:04d}", long) for d in days]
    cases += [(d.isoformat(), iso) for d in days]
    got = parse(spark, cases)
    for day, key in zip(days + days, cases):
        assert got[key] == day
