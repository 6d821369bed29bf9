"""Scalar functions: the semantic rules N6, N7, N15, N16, N18, N19 and the parser table."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fieldbook.functions.calendar import calendar_columns
from fieldbook.functions.field_number import field_number_any, field_number_plain, field_number_prefixed
from fieldbook.functions.labels import color_label, variety_label
from fieldbook.functions.normalize import lenient_decimal, norm_guid, norm_text, strict_decimal
from fieldbook.functions.parsers import parse_item_name, parse_party_name
from fieldbook.functions.ratios import norm_completion_pct, ratio_of_sums_pct, yield_t_ha

PARSER_CASES = [
    ("318, КаГалаРС2ПУч.6 2025 г.", "318", None, "318"),
    ("Поле 318", "Поле 318", "318", "318"),
    ("ПОЛЕ   318", "ПОЛЕ   318", "318", "318"),
    ("Поле 318, уч.6", "Поле 318", "318, уч.6", "318, уч.6"),
    ("Поле", "Поле", None, "Поле"),
    ("Поле ", "Поле", None, "Поле"),
    (", x", None, None, None),
    ("", None, None, None),
    (None, None, None, None),
    ("318, Пар 2026 г.", "318", None, "318"),
]


def test_field_number_parsers(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(PARSER_CASES)], "i int, t string")
    out = {r.i: (r.plain, r.prefixed, r.any) for r in df.select(
        "i", field_number_plain("t").alias("plain"), field_number_prefixed("t").alias("prefixed"),
        field_number_any("t").alias("any")).collect()}
    for i, (_, plain, prefixed, anyf) in enumerate(PARSER_CASES):
        assert out[i] == (plain, prefixed, anyf), PARSER_CASES[i]


def test_norm_text_and_guid(spark):
    df = spark.createDataFrame([("",), ("null",), (" ",), ("x",), (None,),
                                ("00000000-0000-0000-0000-000000000000",), ("AB-Cd",)], "t string")
    got = [(r.n, r.g) for r in df.select(norm_text("t").alias("n"), norm_guid("t").alias("g")).collect()]
    assert got == [(None, None), (None, None), (" ", " "), ("x", "x"), (None, None),
                   ("00000000-0000-0000-0000-000000000000", None), ("AB-Cd", "ab-cd")]


def test_strict_and_lenient_numbers(spark):
    df = spark.createDataFrame([("1.23456",), ("abc",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(lenient_decimal("t")).collect()] == [Decimal("1.235"), None, None, None]
    good = df.where(~F.col("t").eqNullSafe("abc"))
    assert [r[0] for r in good.select(strict_decimal("t")).collect()] == [Decimal("1.235"), None, None]
    with pytest.raises(PySparkException):
        df.select(strict_decimal("t")).collect()


def test_calendar_iso_week_and_season(spark):
    df = spark.createDataFrame([(date(2021, 1, 1),), (date(2021, 1, 3),), (date(2024, 12, 30),),
                                (date(2024, 6, 30),), (date(2024, 7, 1),)], "date_day date")
    r = df.select(*calendar_columns()).collect()
    assert [(x.week, x.day_of_week) for x in r[:3]] == [(53, 5), (53, 7), (1, 1)]
    assert [x.season for x in r[3:]] == [2023, 2024]
    assert r[4].season_label == "2024-2025" and r[4].agro_phase == "вегетация"
    assert r[0].month_name_ru == "Январь" and r[1].is_weekend and r[1].day_name_ru == "Воскресенье"


def test_labels(spark):
    df = spark.createDataFrame([(None, "Гала", "Урожай КРАСНЫЙ", "x белый")], "crop string, sort string, a string, b string")
    r = df.select(variety_label("crop", "sort").alias("v"), color_label("a", "b").alias("c")).first()
    assert r.v == "Гала" and r.c == "Белый"   # NULL crop skipped; white is checked first


def test_ratios(spark):
    df = spark.createDataFrame([(Decimal("5"), Decimal("10")), (Decimal("30"), Decimal("20")),
                                (Decimal("1"), Decimal("0"))], "w decimal(12,4), n decimal(10,3)")
    assert [float(r[0]) if r[0] is not None else None for r in df.select(norm_completion_pct("w", "n")).collect()] \
        == [50.0, 150.0, None]
    tot = df.where("n > 0").agg(ratio_of_sums_pct(F.sum("w"), F.sum("n"))).first()[0]
    assert float(tot) == 116.7    # ratio of sums (35/30), not the mean of 50 and 150
    y = spark.createDataFrame([(Decimal("5000"), None), (Decimal("5000"), Decimal("0")), (Decimal("5000"), Decimal("2"))],
                              "kg decimal(18,3), ha decimal(12,4)")
    assert [r[0] for r in y.select(yield_t_ha("kg", "ha")).collect()] == [None, None, Decimal("2.50")]


def test_party_and_item_parsers(spark):
    df = spark.createDataFrame([("318, КаГалаРС2ПУч.6 2025 г. (не исп. с 31.10.2025)",),
                                ("868, Заросли 2026 г.",)], "t string")
    a, b = [r.p for r in df.select(parse_party_name("t").alias("p")).collect()]
    assert (a.field, a.crop_code, a.reproduction, a.method, a.plot, a.year) == ("318", "КаГала", "РС2", "П", 6, 2025)
    assert a.unused_since == date(2025, 10, 31) and a.state is None
    assert (b.field, b.state, b.plot, b.year) == ("868", "Заросли", None, 2026)
    it = spark.createDataFrame([("Урожай 2025 ГалаРС3 Белый с поливом., поле 318, уч.6",)], "t string")
    p = it.select(parse_item_name("t").alias("p")).first().p
    assert (p.year, p.sort, p.reproduction, p.irrigation, p.field, p.plot) == (2025, "Гала", "РС3", "С поливом", "318", 6)


def test_passthrough_decimal(spark):
    from fieldbook.functions.normalize import passthrough_decimal
    df = spark.createDataFrame([("12.5",), ("null",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(passthrough_decimal("v", 12, 4)).collect()] == [Decimal("12.5000"), None, None, None]
