from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerlift import functions as L
from ledgerlift.functions import fixed_values as fixed


def evaluate(spark, build, *inputs):
    """Value of a column function for each input text, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "dialect, expected",
    [
        ("application", [None, None, None, None, "x", None]),
        ("general", [None, None, "papprefno", None, "x", None]),
        ("user", [None, "None", "papprefno", None, "x", None]),
    ],
)
def test_null_markers(spark, dialect, expected):
    inputs = (" NaN ", "None", "papprefno", " \t\n", " x ", None)
    assert evaluate(spark, lambda c: L.clean(c, dialect), *inputs) == expected


def test_blank_to_null(spark):
    assert evaluate(spark, L.blank_to_null, " a ", "  ", "\\N", None) == ["a", None, None, None]


def test_integer_text(spark):
    inputs = ("1554087241462.0", "1.554087241462e+12", "abc", "12.9", " 7 ", "")
    assert evaluate(spark, lambda c: L.int_text(c, "keep"), *inputs) == ["1554087241462", "1554087241462", "abc", "12.9", "7", ""]
    assert evaluate(spark, lambda c: L.int_text(c, "null"), *inputs) == ["1554087241462", "1554087241462", None, "12", "7", None]
    assert evaluate(spark, lambda c: L.int_text(c, "truncate"), *inputs)[2:4] == ["abc", "12"]


def test_guarded_cast(spark):
    months = lambda c: L.cast_or(c, "bigint", "36", fixed.DECIMAL)
    assert evaluate(spark, months, "36.0", "", "x", "12", None) == [36, 36, 36, 12, 36]


def test_dates_day_first_and_serial(spark):
    inputs = (
        "2022-11-30 00:00:00",
        "30/11/2022",
        "5/1/2020",
        "43979.0",
        "12",
        "junk",
        "03/04/2020",
        "12/31/2020",
        "2020-02-30",
        "2022-11-30T10:11:12Z",
        "2022-11-30 10:11:12.123456",
        "31-01-2021",
        "2021/1/9",
        "2020",
        None,
    )
    expected = [
        date(2022, 11, 30),
        date(2022, 11, 30),
        date(2020, 1, 5),
        date(2020, 5, 28),
        None,
        None,
        date(2020, 4, 3),
        date(2020, 12, 31),
        None,
        date(2022, 11, 30),
        date(2022, 11, 30),
        date(2021, 1, 31),
        date(2021, 1, 9),
        date(1905, 7, 12),
        None,
    ]
    assert evaluate(spark, L.parse_date, *inputs) == expected


def test_dates_of_the_experience_feed(spark):
    parse = lambda c: L.parse_date(c, fixed.DATES_EXPERIENCE, serial=False)
    inputs = ("1/2/2020 10:30", "2020/3/4 1:2:3", "43979", "2020-01-01T00:00:00", "13/13/2020")
    assert evaluate(spark, parse, *inputs) == [date(2020, 2, 1), date(2020, 3, 4), None, None, None]


def test_enums(spark):
    assert evaluate(spark, L.application_type, "Renewal", "EXTENSION", "changes", "odd", " ") == [
        "RENEW",
        "EXTEND",
        "CHANGE_OF_NAME",
        "ODD",
        None,
    ]
    assert evaluate(spark, L.water_application_type, "odd", "new licence", "upgrade") == [None, "NEW", "UPGRADE"]
    assert evaluate(spark, L.installation_type, "nan", "renewal", "odd") == ["NEW", "RENEW", "ODD"]
    assert evaluate(spark, L.nationality, "Tanzanian", "Non Tanzanian", "Kenya") == ["TANZANIAN", "NON_TANZANIAN", None]
    assert evaluate(spark, L.parse_bool, "yes", "0", None) == [True, False, False]
    assert evaluate(spark, L.capacity_unit, "kv", "kg") == ["kV", None]
    assert evaluate(spark, lambda c: L.voltage_level(c, "ELECTRICITY"), "mv", "?") == ["MV", "HV"]
    assert evaluate(spark, L.experience_type, "Self-Employed", "", "fresh from college") == [
        "SELF_EMPLOYED",
        "EMPLOYED",
        "FRESH_FROM_COLLEGE",
    ]
    assert evaluate(spark, L.experience_key, "self-employed", "Self Employed") == ["SELF_EMPLOYED"] * 2


def test_names_and_contacts(spark):
    split = lambda c: F.array(*L.split_name(c))
    assert evaluate(spark, split, "A", "A B", " A  B C D ", "") == [
        ["A", None, None],
        ["A", None, "B"],
        ["A", "B C", "D"],
        [None, None, None],
    ]
    text = "JANE DOE,FITTER,0712 345 678,j@x.org"
    assert evaluate(spark, L.bare_name, text, "A | b, c", " plain ") == ["JANE DOE", "A", "plain"]
    assert evaluate(spark, L.phone_in, text, "+255 715 67 67 70", "none") == ["0712345678", "+255715676770", None]
    assert evaluate(spark, L.email_in, text, "none") == ["j@x.org", None]


def test_labels_and_classes(spark):
    assert evaluate(spark, L.class_code, "class  a", "A", " Class s1") == ["A", "A", "S1"]
    assert evaluate(spark, L.label_key, "PrivateLimited_Company.", "sole-proprietor") == ["private limited company", "sole proprietor"]
    assert evaluate(spark, L.sector_of, "LPG supply", "compressed natural gas", "Bulk Water", "x") == [
        "petroleum",
        "natural_gas",
        "water_supply",
        None,
    ]


def test_reminder_clamps_to_month_end(spark):
    assert evaluate(spark, lambda c: L.reminder_date(c.cast("date")), "2024-08-31") == [date(2024, 2, 29)]


def test_stable_key_counts_null_as_empty(spark):
    key = lambda c: L.stable_key(F.lit("a"), c, F.lit("b"))
    first, second, third = evaluate(spark, key, None, "", "x")
    assert first == second != third
    assert [len(p) for p in first.split("-")] == [8, 4, 4, 4, 12]
