"""Text fields, expected values worked out by hand."""

import datetime

import pytest

from tarmac.functions import parsing as p
from tarmac.functions.text import search_tokens


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").selectExpr(function("v")).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("15.00", 15), ("15.9", 15), ("-15.9", -15), (" 7 ", 7), ("1e3", 1000), ("+4", 4),
        ("", None), ("junk", None), (None, None), ("NaN", None), ("inf", None),
        ("1e20", None), ("12d", None), ("12F", None), ("0x1p3", None), ("1,000", None),
    ],
)
def test_whole_numbers(spark, text, expected):
    assert apply(spark, lambda c: p.whole(p.to_number(c)), [text]) == [expected]


def test_several_numbers_are_read_like_one(spark):
    texts = ["15.9", "12d", "inf", "NaN", None, "0x1p3", "", " 7 ", "1e3", "junk", "ﬀ", "1D"]
    df = spark.createDataFrame([(i, a, b) for i, a in enumerate(texts) for b in texts], "i int, a string, b string")
    got = df.selectExpr(f"{p.to_numbers(['a', 'b'])} AS n", f"array({p.to_number('a')}, {p.to_number('b')}) AS m").collect()
    assert [str(r["n"]) for r in got] == [str(r["m"]) for r in got] and len(got) == len(texts) ** 2


def test_floats_drop_nan(spark):
    got = apply(spark, lambda c: p.known(p.to_number(c)), ["1.5", "NaN", "x", None])
    assert got == [1.5, None, None, None]


def test_clock(spark):
    cases = {
        "830": "08:30:00", "830.0": "08:30:00", "5": "00:05:00", "2359": "23:59:00",
        "2400": "00:00:00", "0": "00:00:00", "1299": None, "2530": "01:30:00",
        "-30": None, "-41": "23:59:00", "junk": None, None: None,
    }
    assert apply(spark, lambda c: p.clock(p.to_number(c)), list(cases)) == list(cases.values())


def test_flags(spark):
    got = apply(spark, lambda c: p.flag(p.to_number(c)), ["1.00", "1", "0.00", "1.5", "yes", "NaN", None])
    assert got == [True, True, False, False, False, False, False]


def test_days(spark):
    day = datetime.date
    cases = {
        "2023-01-05": day(2023, 1, 5), "2023-1-5": day(2023, 1, 5), " 2023-01-05 ": day(2023, 1, 5),
        "1/5/2023": day(2023, 1, 5), "01/05/2023": day(2023, 1, 5),
        "1/5/2023 12:00:00 AM": day(2023, 1, 5), "2023-13-01": None, "2/30/2023": None,
        "2/29/2024": day(2024, 2, 29), "2023-01-05 00:00": None, "20230105": None, "junk": None,
        "": None, None: None,
    }
    assert apply(spark, p.to_day, list(cases)) == list(cases.values())


def test_days_are_read_like_by_their_pattern(spark):
    texts = [
        "2023-1-5", "2023-01-05", "02023-01-05", "+2023-1-5", "2023", "2023-1", "2023-1-5 x", "2023-1-5T", "2023-1-5T00:00",
        "2023-1-0", "2023-0-1", "2023-00-05", "2023-1-00", "2024-2-29", "2023-2-29", "2023-1-5-0", "2023--1-5", "0000-01-01",
        "0999-12-31", "1000-1-1", "1582-10-10", "9999-12-31", "2023-001-05", "2023-1-5\x01", "today", " 2023-1-05\t",
    ]
    pattern = lambda c: f"try_to_date({p.strip(c)}, 'yyyy-M-d')"
    before = spark.conf.get("spark.sql.legacy.timeParserPolicy")
    spark.conf.set("spark.sql.legacy.timeParserPolicy", "CORRECTED")
    try:
        read, wanted = (apply(spark, lambda c: f"CAST({day(c)} AS STRING)", texts) for day in (p.to_day, pattern))
        assert read == wanted
    finally:
        spark.conf.set("spark.sql.legacy.timeParserPolicy", before)


def test_missing_marks_are_exact(spark):
    got = apply(spark, p.missing_to_null, ["NA", "n/a", "None", "", " NA", "Nan", "JFK", None])
    assert got == [None, None, None, None, " NA", "Nan", "JFK", None]


def test_codes(spark):
    assert apply(spark, p.code, [" jfk\t", "AA", None]) == ["JFK", "AA", None]


def test_search_tokens(spark):
    df = spark.createDataFrame([("The Port of O'Hare", None, "ORD")], "a string, b string, c string")
    got = df.selectExpr(search_tokens("a", "b", "c")).first()[0]
    assert got == ["hare", "o", "ord", "port"]
