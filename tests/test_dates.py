import pandas as pd
import pytest
from dateutil import parser as free_form
from pyspark.sql import functions as F

from tickerloom.functions import dates as D

VALUES = [
    "2021-02-03", "03-02-2021", "13/02/2021", "02/13/2021", "May 26, 2020, Tuesday",
    "2020-05-26T10:30:00+05:30", "20200526", "foo", "26 May 2020",
    "Tue, 26 May 2020 22:30:00 GMT", "May 26, 2020 10:30 PM", "2020-05-26 10:30:15.123456",
    "2020-05-26T10:30:00Z", "26th May, 2020", "2020/05/26", "26.05.2020", "5/6/2020 3:04 PM",
    "May 2020", "2020-05", "2021-02-30", "31/04/2021", "2020-05-26 10:30 IST", "26-MAY-2020 01:02:03",
    "1,000", "hello 2020", "2020-5-6", "20200526T101112", "", "Mar 5 10:30:00 2020",
    "2020-05-26 25:00", "13-13-2020", "2021-13-02", "Sept 5, 2019", "2020-05-26 10:30:00-0400",
    "May 26, 2020 at 10:30 AM", "2020-05-26 12:00 AM", "26 May, 2020, 07:12 PM IST",
]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(list(enumerate(VALUES)), "i int, v string")


def iso(df, column="p"):
    return [r.s for r in df.select("i", D.to_iso_utc(F.col(column)).alias("s")).orderBy("i").collect()]


def text(stamp):
    return None if pd.isna(stamp) else stamp.strftime("%Y-%m-%d %H:%M:%S")


@pytest.mark.filterwarnings("ignore")
@pytest.mark.parametrize("day_first", [False, True])
def test_mixed_reads_what_pandas_reads(frame, day_first):
    expected = [text(pd.to_datetime(pd.Series([v]), format="mixed", dayfirst=day_first,
                                    errors="coerce", utc=True)[0]) for v in VALUES]
    assert iso(D.parse_mixed(frame, "v", "p", day_first=day_first)) == expected


@pytest.mark.filterwarnings("ignore")
def test_complex_reads_what_dateutil_reads(frame):
    def one(value):
        try:
            return text(pd.to_datetime(free_form.parse(value, dayfirst=True), utc=True))
        except (ValueError, OverflowError):
            return None

    def day_given(value):  # others take today's day
        return value not in ("May 2020", "2020-05", "")

    got = iso(D.parse_complex(frame, "v", "p"))
    assert [(v, g) for v, g in zip(VALUES, got) if day_given(v)] == [
        (v, one(v)) for v in VALUES if day_given(v)]


@pytest.mark.filterwarnings("ignore")
def test_event_date_keeps_the_shown_day(frame):
    def one(value):
        try:
            stamp = pd.Timestamp(value)
            return None if pd.isna(stamp) else stamp.date()
        except ValueError:
            return None

    got = [r.p for r in D.to_event_date(frame, "v", "p").orderBy("i").collect()]
    assert list(zip(VALUES, got)) == [(v, one(v)) for v in VALUES]


def test_time_alone_is_null_and_gap_fill_is_optional(spark):
    df = spark.createDataFrame([(0, "10:30"), (1, "20200526.0"), (2, None)], "i int, v string")
    assert iso(D.parse_mixed(df, "v", "p")) == [None, "2020-05-26 00:00:00", None]
    assert iso(D.parse_mixed(df, "v", "p", gap_fill=True)) == [None, "2020-05-26 00:00:00", None]


def test_clocks_with_bars_and_other_text_are_null(spark):
    df = spark.createDataFrame(list(enumerate([
        "2020-05-26 12|30|15|||", "2020-05-26 |", "2020-05-26 12:30 pm|", "2020-05-26 noon",
        "2020-05-26 12:30:15.25 PM +05:30", "2020-05-26 7"])), "i int, v string")
    assert iso(D.parse_mixed(df, "v", "p")) == [
        None, None, None, None, "2020-05-26 07:00:15", "2020-05-26 07:00:00"]


def test_exact(spark):
    df = spark.createDataFrame([(0, "20200526"), (1, "2020-05-26"), (2, "20200526.0"),
                                (3, "20201301"), (4, None)], "i int, v string")
    got = iso(df.withColumn("p", D.parse_exact(F.col("v"))))
    assert got == ["2020-05-26 00:00:00", None, "2020-05-26 00:00:00", None, None]


def test_two_digit_years(spark):
    texts = {"12/05/21": ("2021-12-05", "2021-05-12"), "26-May-20": ("2020-05-26",) * 2,
             "May 26, 20": ("2020-05-26",) * 2, "13.05.98": ("1998-05-13",) * 2,
             "05/13/69": ("2069-05-13",) * 2, "26 May 10:30": (None, None)}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for place, day_first in enumerate((False, True)):
        rows = D.parse_mixed(df, "t", "ts", day_first=day_first).collect()
        assert {r.t: r.ts and str(r.ts.date()) for r in rows} == {
            t: both[place] for t, both in texts.items()}
