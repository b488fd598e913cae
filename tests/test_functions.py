import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillflow.functions.dates import parse_multi_format_date, week_label, weekday_mon0
from tillflow.functions.location import parse_location
from tillflow.functions.money import (div_round, format_brl, format_int_br, mean_money_out,
                                      parse_currency, percent_out, revenue)
from tillflow.functions.text import strip, title_case


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text,expected", [
    ("JAQUETA CORTA-VENTO 5kg", "Jaqueta Corta-Vento 5Kg"),
    ("aspirador de pó", "Aspirador De Pó"),
    ("SÃO PAULO", "São Paulo"),
    ("5-LOW", "5-Low"),
    ("中abc", "中Abc"),
    ("1ªvez", "1ªvez"),
    ("", ""),
    (None, None),
])
def test_title_case_matches_python_title(spark, text, expected):
    assert one(spark, title_case, text) == expected
    if text is not None:
        assert text.title() == expected


def test_strip_removes_tabs_and_unicode_spaces(spark):
    assert one(spark, strip, "\t  Pix  \t") == "Pix"


@pytest.mark.parametrize("text,expected", [
    ("2025-02-01", dt.date(2025, 2, 1)),
    ("1/2/2025", dt.date(2025, 2, 1)),
    ("01/02/2025", dt.date(2025, 2, 1)),
    ("02-01-2025", dt.date(2025, 2, 1)),
    ("2025-2-1", dt.date(2025, 2, 1)),
    ("2025-02-30", None),
    ("sem data", None),
    ("2025-02-01 10:00", None),
    (None, None),
])
def test_multi_format_dates(spark, text, expected):
    assert one(spark, parse_multi_format_date, text) == expected


def test_week_label_is_sunday_and_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1),), (dt.date(2025, 1, 5),), (dt.date(2025, 1, 6),)],
                               "d date")
    out = df.select(week_label("d").alias("w"), weekday_mon0("d").alias("k")).collect()
    assert [r["w"] for r in out] == [dt.date(2025, 1, 5), dt.date(2025, 1, 5), dt.date(2025, 1, 12)]
    assert [r["k"] for r in out] == [2, 6, 0]


@pytest.mark.parametrize("text,expected", [
    ("R$ 1.234.567,50", Decimal("1234567.50")),
    ("R$ 1.234,56", Decimal("1234.56")),
    ("12.5", Decimal("12.50")),
    (" 1234.56 ", Decimal("1234.56")),
    ("1.234,56", None),
    ("abc", None),
    (None, None),
])
def test_currency(spark, text, expected):
    got = one(spark, parse_currency, text)
    assert (got is None and expected is None) or got == expected


def test_revenue_rounds_half_up_on_exact_product(spark):
    df = spark.createDataFrame([("12.345", 1), ("0.125", 1), ("1.005", 1), ("33.333333", 3)], "p string, q int")
    out = df.select(revenue(F.col("p").cast("decimal(18,6)"), F.col("q")).alias("r")).collect()
    assert [r["r"] for r in out] == [Decimal("12.35"), Decimal("0.13"), Decimal("1.01"), Decimal("100.00")]


def test_exact_ratio_rounding(spark):
    df = spark.createDataFrame([(1001, 2), (-1001, 2), (7, 3), (1, 0), (-5, -2)], "n long, d long")
    got = [r[0] for r in df.select(div_round(F.col("n"), F.col("d"), 0)).collect()]
    assert got == [Decimal(501), Decimal(-501), Decimal(2), None, Decimal(3)]
    money = spark.createDataFrame([(Decimal("10.01"), 2)], "t decimal(18,2), n long")
    assert money.select(mean_money_out("t", "n")).first()[0] == 5.01
    assert money.select(percent_out(F.lit(1), F.lit(3))).first()[0] == 33.33


def test_display_formats(spark):
    df = spark.createDataFrame([(1234567.5, 1234)], "v double, n long")
    r = df.select(format_brl("v"), format_int_br("n")).first()
    assert tuple(r) == ("R$ 1.234.567,50", "1.234")


@pytest.mark.parametrize("text,expected", [
    ("SÃO PAULO - sp", ("São Paulo", "SP", "Brasil")),
    ("Recife", ("Recife", None, "Brasil")),
    ("recife/pe/brasil", ("Recife", "PE", "Brasil")),
    ("Natal/RN", ("Natal", "RN", "Brasil")),
    ("CORTA-VENTO - SP", ("Corta", "VENTO", "Brasil")),  # hyphenated city: second piece is the state
    (None, (None, None, None)),
])
def test_location(spark, text, expected):
    row = one(spark, parse_location, text)
    assert (tuple(row) if row is not None else (None, None, None)) == expected


def test_strip_is_python_strip_on_every_whitespace_character(spark):
    from tillflow.functions.text import PY_WHITESPACE
    texts = [ch + "a b" + ch for ch in PY_WHITESPACE] + ["\x1c x \x1f", "　y "]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r[0] for r in df.select(strip("x")).collect()] == [t.strip() for t in texts]
