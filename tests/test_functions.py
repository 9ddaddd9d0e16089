from datetime import date

import pytest
from pyspark.sql import functions as F

from entityfold import functions as fn


@pytest.fixture
def values(spark):
    """The values of one column expression over a list of texts."""

    def run(texts, expression, kind="string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
        return [r["v"] for r in df.orderBy("i").select(expression(F.col("x")).alias("v")).collect()]

    return run


def test_trim_means_spaces_or_all_white_space(values):
    texts = ["  a ", "\ta\n", " ", " ﻿b　", None]
    assert values(texts, fn.trimmed) == ["a", "\ta\n", None, " ﻿b　", None]
    assert values(texts, fn.stripped) == ["a", "a", None, "b", None]


@pytest.mark.parametrize(
    ("label", "name"),
    [
        ("Company Name", "company_name"),
        ("﻿REGISTER_NAME", "register_name"),
        ("Promoting__mutual_respect\r", "promoting_mutual_respect"),
        ("LGBTIQA+", "lgbtiqa"),
        ("2024", "_2024"),
        ("---", "_"),
    ],
)
def test_safe_name(values, label, name):
    assert fn.safe_name(label) == name
    assert values([label], fn.safe_name_column) == [name]


def test_checksum(values):
    from tests.landing import abn

    good = [abn(n) for n in (1, 22, 404040404)]
    bad = ["51824753557", "5182475355", "5182475355x", "", None, " " + good[0], good[0] + "\n"]
    assert values(["51824753556", *good], fn.abn_valid) == [True] * 4
    assert values(bad, fn.abn_valid) == [False] * len(bad)
    # any single wrong digit is found
    flipped = [good[1][:i] + str((int(good[1][i]) + 1) % 10) + good[1][i + 1 :] for i in range(11)]
    assert values(flipped, fn.abn_valid) == [False] * 11


def test_routing(values):
    texts = ["51 824 753 556", "004 080 199", "4080199", "12345", "", None]
    pair = lambda f: lambda x: F.struct(*f(x))
    assert [tuple(r) for r in values(texts, pair(fn.routed))] == [
        ("51824753556", None),
        (None, "004080199"),
        (None, None),
        (None, None),
        (None, None),
        (None, None),
    ]
    assert [tuple(r) for r in values(texts, pair(fn.routed_padded))][2:4] == [
        (None, "004080199"),
        (None, None),
    ]


def test_guarded_dates(values):
    texts = ["01/02/2020", " 01/02/2020 ", "1/2/2020", "Permanent banning", "", None, "01/02/2020\n"]
    d = date(2020, 2, 1)
    assert values(texts, fn.guarded_date) == [d, d, None, None, None, None, None]
    assert values(texts[:3] + ["", None], fn.strict_date) == [d, d, d, None, None]
    assert values(["20200201", " 20200201", "2020", None], fn.compact_date) == [d, d, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("function", "text"),
    [
        (fn.guarded_date, "31/02/2020"),
        (fn.strict_date, "31/02/2020"),
        (fn.strict_date, "Permanent banning"),
        (fn.compact_date, "20209999"),
    ],
)
def test_bad_dates_fail_the_job(spark, values, function, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a date"):
            values([text], function)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_compact_iso_does_not_check_the_calendar(values):
    assert values([20269999, 20260601, 999, None], fn.compact_iso, "int") == [
        "2026-99-99",
        "2026-06-01",
        None,
        None,
    ]


def test_sheet_dates(values):
    texts = ["46176", "46176.5", "3-Jun-2026", "3 June 2026", "6/3/2026", "2026-06-03T10:00", "x", None]
    d = date(2026, 6, 3)
    assert values(texts, fn.sheet_date) == [d, d, d, d, d, d, None, None]


@pytest.mark.parametrize(
    ("start", "as_of", "years"),
    [
        (date(2025, 1, 1), date(2026, 1, 1), 1),
        (date(2024, 2, 29), date(2025, 2, 28), 0),
        (date(2024, 2, 29), date(2025, 3, 1), 1),
        (date(1999, 3, 1), date(2026, 6, 28), 27),
        (date(2030, 1, 1), date(2026, 6, 28), 0),
        (None, date(2026, 6, 28), None),
    ],
)
def test_age(values, start, as_of, years):
    assert values([start], lambda x: fn.age_years(x, as_of), "date") == [years]


def test_numbers(values):
    texts = ["1", " -2.50 ", "1e3", "1,000", ".5", "", None, "5\n"]
    got = values(texts, lambda x: fn.guarded_number(x).cast("double"))
    assert got == [1.0, -2.5, None, None, None, None, None, None]
    assert values(texts, fn.guarded_integer) == [1, None, None, None, None, None, None, None]
    cells = ["$1,234.50", "1e3", "n/a", " ", "$", None, "Infinity", "1d", "1e999"]
    assert values(cells, fn.clean_number) == [
        1234.5,
        1000.0,
        None,
        None,
        0.0,
        None,
        None,
        None,
        None,
    ]


def test_cents_round_halves_up(values):
    cents = values([0.125, -0.125, 1000.5, -0.025, None], fn.to_cents, "double")
    assert cents == [13, -12, 100050, -2, None]
    money = values([150050, -1, 0, 9007199254740993], fn.cents_to_money, "bigint")
    assert [str(m) for m in money] == ["1500.50", "-0.01", "0.00", "90071992547409.93"]


def test_labels(values):
    expand = lambda x: fn.expand_code(x, {"REGD": "Registered"})
    assert values([" regd", "EXAD", " ", None], expand) == ["Registered", "EXAD", None, None]
    assert values(["NSW", " aat ", "", "\t", None], fn.bucket_key) == [
        "nsw",
        "aat",
        "other",
        "other",
        "other",
    ]
