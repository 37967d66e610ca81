import pytest
from pyspark.sql import functions as F

from rollcall.operators.timestamps import Rules, normalise_times

CASES = [
    ("2019-05-27 04:15:00+01:00", "UTC", "2019-05-27T03:15:00.000000Z"),
    ("20200903T141500Z", "America/Chicago", "2020-09-03T14:15:00.000000Z"),
    ("Fri, 07 Dec 2012 23:30:00 -0800", "UTC", "2012-12-08T07:30:00.000000Z"),
    ("1677632400", "America/Chicago", "2023-03-01T01:00:00.000000Z"),
    ("1421175600177", "UTC", "2015-01-13T19:00:00.177000Z"),
    ("2023-06-03 13:45 CDT", "America/Denver", "2023-06-03T18:45:00.000000Z"),
    ("2019-05-05 13:15 America/Phoenix", "UTC", "2019-05-05T20:15:00.000000Z"),
    ("3/4/2019", "America/New_York", "2019-03-04T05:00:00.000000Z"),
    ("4/20/20 06:00 PM", "America/New_York", "2020-04-20T22:00:00.000000Z"),
    ("Thursday, November 28, 2013 - 03:00 PM", "America/Chicago", "2013-11-28T21:00:00.000000Z"),
    ("19 de julio de 2011 14:15", "America/Puerto_Rico", "2011-07-19T18:15:00.000000Z"),
    ("09/21/2020 2 p.m.", "America/Chicago", "2020-09-21T19:00:00.000000Z"),
    ("November 03, 2024, 12:00 AM", "America/Chicago", "2024-11-03T05:00:00.000000Z"),
    ("2011-04-08T17:00:00.7Z", "UTC", "2011-04-08T17:00:00.700000Z"),
    ("11/06/2022 01:30 AM", "America/Chicago", "2022-11-06T06:30:00.000000Z"),   # occurs twice: the earlier
    ("2022-03-13 02:30", "America/Chicago", "2022-03-13T08:30:00.000000Z"),      # skipped: moves on by an hour
    ("  2017-10-11   16:45 ", "UTC", "2017-10-11T16:45:00.000000Z"),
    ("25/12/2019", "UTC", "2019-12-25T00:00:00.000000Z"),
    ("TBD", "UTC", None), ("", "UTC", None), (None, "UTC", None), ("0000-00-00 00:00:00", "UTC", None), ("2019-02-30", "UTC", None), ("15 minutes after recess", "UTC", None),
    ("2019-05-05 13:15 Nowhere/Atall", "UTC", None), ("2019-05-05", None, None), ("13:99 2019", "UTC", None), ("x" * 5000, "UTC", None),
]


@pytest.fixture(scope="module")
def normal(spark):
    df = spark.createDataFrame([(i, v, z, "extra") for i, (v, z, _) in enumerate(CASES)], "i int, v string, z string, time_zone string")
    return {r.i: r for r in normalise_times(df, "v", ["z"], F.col("z"), Rules(century=20)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(normal, i):
    assert normal[i].time_utc == CASES[i][2], CASES[i]


def test_status(normal):
    status = {CASES[i][0]: r.time_status for i, r in normal.items()}
    assert status["TBD"] == "unreadable" and status[""] == status[None] == "missing" and status["2019-05-05"] == "no_zone" and status["3/4/2019"] == "resolved"


@pytest.mark.parametrize("value,want", [("1950", "1950"), ("April 1934", "1934-04"), ("1990-02", "1990-02"), ("07-JUL-1967", "1967-07-07"), ("8/27/99", "1999-08-27"), ("19760407", "1976-04-07"),
                                        ("1936-02-10T00:00:00.000+00:00", "1936-02-10"), ("1978.07.04", "1978-07-04"), ("unknown", None), ("?", None)])
def test_fuzzy_dates(spark, value, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert normalise_times(df, "v", [], None, Rules(century=19)).first().fuzzy_date == want


def test_ambiguity_is_marked_and_learnt(spark):
    even = Rules(century=20, prior={"dmy": 1.0})
    df = spark.createDataFrame([("a", "3/4/2019"), ("a", "5/6/2019")] + [("b", "25/12/2019")] * 30 + [("b", "3/4/2019")], "s string, v string")
    out = {(r.s, r.v): r for r in normalise_times(df, "v", ["s"], F.lit("UTC"), even).collect()}
    assert out["a", "3/4/2019"].time_status == "ambiguous"
    assert out["b", "3/4/2019"].time_utc == "2019-04-03T00:00:00.000000Z" and out["b", "3/4/2019"].time_status == "resolved"


def test_empty(spark):
    assert normalise_times(spark.createDataFrame([], "v string, z string"), "v", ["z"], F.col("z"), Rules(century=20)).collect() == []
